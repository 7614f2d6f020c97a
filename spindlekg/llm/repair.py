"""Conversation structure repair: a generalised LR parse of a conversation's roles with weighted repairs.

The role grammar is `(s?(ua)+)?` over the roles' initials, written left-linear; its LR automaton is built from the
productions. Stacks are linked cells that share their lower parts, and at each turn all live stacks go on together:
a turn is kept (0), given the role user or assistant (3) or deleted (4), an empty user or assistant turn may be inserted
anywhere (3), and equal stacks merge to the one of least (cost, audit). The audit is the initials of the edits; edits of
one cost never have audits of which one begins with the other (letters but I stand for one turn each, and each I costs),
so merging early gives the least audit of the whole too. Blank turns (nothing but ASCII white space) and duplicates (role
and text were there before) must go; a truncated turn (the last character that is no white space is not `.`, `!` or `?`)
that stays costs 3 more.

Conversations are parsed in chunks of CHUNK turns, which lie in several tasks where a conversation is long: rows are
dealt by ranges of (conversation, turn, role, text), equal rows counted first. A chunk that may not begin its conversation
is parsed from each stack that the grammar has (there are four). `choose` folds the chunks' costs and audits, without
their texts, and says from which stack and by which edits each chunk is repaired; `repaired` applies that to the turns, in
as many tasks as there are chunks. Only `reports` reads a conversation in one task, as a stream, because its digest needs
all turns in order; there and in `choose` no more than a conversation's audits are held.

Edges, all tested: null roles and texts are one space, a role without a legal initial is given one or deleted; null turns
come first; rows of one turn are ordered by role, then text; repeated rows are duplicates; rows with a null conversation
form one; an empty table returns no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import heavy_keys, materialize, shuffle_partitions, spread_join

CHUNK = 512
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
#: A dialogue is nothing, or ends with an answer; an answer follows an open turn, which a dialogue or a system turn precedes.
GRAMMAR = (("dialogue", ()), ("dialogue", ("answered",)), ("answered", ("open", "a")), ("open", ("answered", "u")), ("open", ("system", "u")), ("open", ("u",)), ("system", ("s",)))

Item = tuple[int, int]  # a production and how much of it has been read
Stack = tuple[int, object]  # a state and the stack below it
Weight = tuple[int, str]  # cost and audit
Turn = tuple[str, str, str, int]  # role, text, fault, copies


def automaton(grammar: tuple) -> tuple[dict[tuple[int, str], int], dict[int, tuple[str, int]], set[int]]:
    """LR(0) tables: where a state goes on a symbol, what it reduces, and which states accept. The first production's
    symbol is the start; its productions are accepted at the end instead of being reduced."""
    start = grammar[0][0]

    def closed(items: Iterable[Item]) -> frozenset[Item]:
        found = set(items)
        while more := {(q, 0) for p, dot in found if dot < len(grammar[p][1]) for q, (left, _) in enumerate(grammar) if left == grammar[p][1][dot]} - found:
            found |= more
        return frozenset(found)

    states = [closed((p, 0) for p, (left, _) in enumerate(grammar) if left == start)]
    goto: dict[tuple[int, str], int] = {}
    reduces: dict[int, tuple[str, int]] = {}
    accepts: set[int] = set()
    for n, items in enumerate(states):
        for p, dot in items:
            left, right = grammar[p]
            if dot < len(right):
                to = closed((q, d + 1) for q, d in items if d < len(grammar[q][1]) and grammar[q][1][d] == right[dot])
                if to not in states:
                    states.append(to)  # the loop goes on to it
                goto[n, right[dot]] = states.index(to)
            elif left == start:
                accepts.add(n)
            else:
                reduces[n] = (left, len(right))
    return goto, reduces, accepts


GOTO, REDUCES, ACCEPTS = automaton(GRAMMAR)
BOTTOM: Stack = (0, None)


@lru_cache(maxsize=1024)
def advance(stack: Stack, symbol: str) -> Stack | None:
    """The stack after a symbol and all reductions, or None if the grammar does not allow it there."""
    if (stack[0], symbol) not in GOTO:
        return None
    stack = (GOTO[stack[0], symbol], stack)
    while stack[0] in REDUCES:
        left, size = REDUCES[stack[0]]
        for _ in range(size):
            stack = stack[1]
        stack = (GOTO[stack[0], left], stack)
    return stack


def reachable() -> list[Stack]:
    found = [BOTTOM]
    for stack in found:
        found += [to for symbol in "sua" if (to := advance(stack, symbol)) is not None and to not in found]
    return found


STACKS = reachable()


def inserted(tops: dict[Stack, Weight]) -> dict[Stack, Weight]:
    """The tops, and those that insertions lead to."""
    todo = list(tops)
    while todo:
        stack = todo.pop()
        cost, audit = tops[stack]
        for symbol in ROLES:
            to, weight = advance(stack, symbol), (cost + INSERT, audit + "I")
            if to is not None and (to not in tops or weight < tops[to]):
                tops[to] = weight
                todo.append(to)
    return tops


def parse(turns: Iterable[Turn], start: Stack) -> dict[Stack, Weight]:
    """The least (cost, audit) that leads from one stack over the turns to each other."""
    tops = inserted({start: (0, "")})
    for role, _, fault, copies in turns:
        initial, gone = role[:1], copies - (fault in ("", "truncated"))
        reached: dict[Stack, Weight] = {}

        def offer(to: Stack | None, weight: Weight) -> None:
            if to is not None and (to not in reached or weight < reached[to]):
                reached[to] = weight

        for stack, (cost, audit) in tops.items():
            if gone < copies:
                more = TRUNCATED * (fault == "truncated")
                offer(stack, (cost + DELETE, audit + "D"))
                offer(advance(stack, initial) if initial else None, (cost + more, audit + "K"))
                for symbol in ROLES:
                    offer(advance(stack, symbol), (cost + REROLE + more, audit + "R"))
            else:
                offer(stack, (cost, audit))
        tops = inserted(reached)
        if gone:
            tops = inserted({stack: (cost + DELETE * gone, audit + "D" * gone) for stack, (cost, audit) in tops.items()})
    return tops


def mend(start: int, letters: str, turns: Iterable[Turn]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of each turn of a chunk and of those put in, from its stack and its edits."""
    stack, each = STACKS[start], (t for t in turns for _ in range(t[3]))
    for letter in letters:
        role, text = ("", "") if letter == "I" else next(each)[:2]
        if letter in "RI":
            role = ROLES[next(s for s in ROLES if advance(stack, s) is not None)]
        if letter != "D":
            stack = advance(stack, role[:1])
        yield letter, role, text


def damage(rows: DataFrame) -> DataFrame:
    """Rows conv_id, turn, role, text with faults put in by a checksum of conversation and turn."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(case == 1, F.lit("")).when(case == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    kept = rows.where(case != 0)
    return kept.select("conv_id", "turn", F.when(case == 4, F.lit("user")).otherwise(blank("role")).alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(case == 3, 2).otherwise(1))).alias("__copy")).drop("__copy")


def faulted(rows: DataFrame) -> DataFrame:
    """Rows conv_id, turn, role, text: equal ones as one with `copies`, and `fault` of its first copy: blank, duplicate,
    truncated or empty."""
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    said = F.sha2(F.to_json(F.struct("conv_id", "role", "text"), {"ignoreNullFields": "false"}), 256)
    # a min of structs puts nulls first, as the order of turns does
    seen = rows.select(said.alias("said"), F.struct("turn").alias("at")).groupBy("said").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count("*").alias("weight"))
    again = materialize(seen.where("first <> last").select("said", F.col("first.turn").alias("first"), "weight"))
    merged = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies")).withColumn("said", said)
    joined = spread_join(merged, again, "said", heavy_keys(again, "said", "weight"), "left")
    new = F.col("weight").isNull() | F.col("turn").eqNullSafe(F.col("first"))
    whole = F.regexp_replace("text", r"[\x20\x09-\x0D]+$", "")
    fault = F.when(whole == "", "blank").when(~new, "duplicate").when(~whole.rlike(r"[.!?]\z"), "truncated").otherwise("")
    return joined.select("conv_id", "turn", "role", "text", fault.alias("fault"), "copies")


TURN = "struct<role: string, text: string, fault: string, copies: long>"
CHUNK_FIELDS = f"""part long, chunk long, known boolean, blank long, duplicate long, truncated long, illegal long, turns_seen long, first_turn TURN_TYPE, last_turn TURN_TYPE,
first_role string, last_role string, paths array<struct<start: int, stop: int, cost: long, audit: string>>, turns array<{TURN}>"""


def _batched(rows: Iterable[dict], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _mapped(df: DataFrame, make: Callable[[Iterator[dict]], Iterable[dict]], schema: T.StructType, size: int = 64) -> DataFrame:
    """mapInArrow over a partition's rows as dictionaries."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for i in range(0, batch.num_rows, 256) for row in batch.slice(i, 256).to_pylist())
        return _batched(make(rows), arrow, size)

    return df.mapInArrow(run, schema)


def _chunk(rows: list[dict], known: bool) -> dict:
    turns = [(r["role"], r["text"], r["fault"], r["copies"]) for r in rows]
    every = [fault if i == 0 or fault == "blank" else "duplicate" for _, _, fault, copies in turns for i in range(min(copies, 2))]
    extra = sum(c - 2 for _, _, _, c in turns if c > 2)
    more_blank = sum(c - 2 for _, _, fault, c in turns if c > 2 and fault == "blank")
    illegal = sum(a[:1] + b[:1] not in LEGAL for (a, *_), (b, *_) in zip(turns, turns[1:])) + sum(c - 1 for *_, c in turns)
    paths = [{"start": i, "stop": STACKS.index(stop), "cost": w[0], "audit": w[1]} for i in range(1 if known else len(STACKS)) for stop, w in parse(turns, STACKS[i]).items()]
    found = {"known": known, "blank": every.count("blank") + more_blank, "duplicate": every.count("duplicate") + extra - more_blank, "truncated": every.count("truncated"), "illegal": illegal}
    places = [r["turn"] for r in rows if r["turn"] is not None]
    found |= {"turns_seen": len(set(places)), "first_turn": places[0] if places else None, "last_turn": places[-1] if places else None}
    return found | {"first_role": turns[0][0], "last_role": turns[-1][0], "paths": paths, "turns": [dict(zip(("role", "text", "fault", "copies"), t)) for t in turns]}


def _same_task(turn_chars: int, size: int):
    def run(rows: Iterator[dict]) -> Iterator[dict]:
        part = TaskContext.get().partitionId()
        held, chars, chunk, begun = [], 0, 0, False
        head = part == 0  # whether the conversation that is read is known to begin here
        conv = None

        def cut() -> dict:
            nonlocal held, chars, chunk
            made = {"conv_id": conv, "part": part, "chunk": chunk} | _chunk(held, head and chunk == 0)
            held, chars, chunk = [], 0, chunk + 1
            return made

        for row in rows:
            if begun and (row["conv_id"] != conv or len(held) >= size or chars >= turn_chars):
                if held:
                    yield cut()
                if row["conv_id"] != conv:
                    chunk, head = 0, True
            conv, begun = row["conv_id"], True
            held.append(row)
            chars += len(row["text"])
        if held:
            yield cut()

    return run


def _fields(rows: DataFrame, kind: str) -> T.StructType:
    ddl = CHUNK_FIELDS.replace("TURN_TYPE", kind)
    return T.StructType([rows.schema["conv_id"], *T.StructType.fromDDL(ddl).fields])


def chunked(rows: DataFrame, size: int = CHUNK, chars: int = 1 << 20) -> DataFrame:
    """Faulted rows to chunks of up to `size` rows, or about `chars` characters, in the order of their conversations, each
    with the least weights between stacks. Written as a table, as two readers need it."""
    order = ["conv_id", "turn", "role", "text"]
    dealt = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    return materialize(_mapped(dealt, _same_task(chars, size), _fields(rows, dict(rows.dtypes)["turn"])))


def _fold(rows: Iterator[dict]) -> Iterator[dict]:
    conv, live = None, {}

    def ended() -> Iterator[dict]:
        done = [(w[0], w[1], link) for i, (w, link) in live.items() if STACKS[i][0] in ACCEPTS]
        if done:
            cost, _, link = min(done, key=lambda x: x[:2])
            while link is not None:
                link, key, start, letters = link
                yield {"conv_id": conv, "part": key[0], "chunk": key[1], "start": start, "letters": letters, "cost": cost}

    for row in rows:
        if not live or row["conv_id"] != conv:
            yield from ended()
            conv, live = row["conv_id"], {0: ((0, ""), None)}
        reached: dict[int, tuple] = {}
        for path in row["paths"]:
            if path["start"] in live:
                (cost, audit), link = live[path["start"]]
                weight = (cost + path["cost"], audit + path["audit"])
                if path["stop"] not in reached or weight < reached[path["stop"]][0]:
                    reached[path["stop"]] = (weight, (link, (row["part"], row["chunk"]), path["start"], path["audit"]))
        live = reached
    yield from ended()


def choose(chunks: DataFrame) -> DataFrame:
    """conv_id, part, chunk, start (a stack), letters (the edits) and cost (the whole conversation's), a row per chunk."""
    rows = chunks.select("conv_id", "part", "chunk", "paths").repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk")
    schema = T.StructType([chunks.schema["conv_id"], *T.StructType.fromDDL("part long, chunk long, start int, letters string, cost long").fields])
    return _mapped(rows, _fold, schema)


def _together(chunks: DataFrame, chosen: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Chunks and their choices, each choice just before its chunk, dealt by the columns."""
    both = chosen.withColumn("__kind", F.lit(0)).unionByName(chunks.drop("paths").withColumn("__kind", F.lit(1)), allowMissingColumns=True)
    return both.repartition(*by).sortWithinPartitions("conv_id", "part", "chunk", "__kind")


def _turns(row: dict) -> list[Turn]:
    return [(t["role"], t["text"], t["fault"], t["copies"]) for t in row["turns"]]


def _apply(rows: Iterator[dict]) -> Iterator[dict]:
    choice = None
    for row in rows:
        if row["__kind"] == 0:
            choice = row
            continue
        for i, (edit, role, text) in enumerate(mend(choice["start"], choice["letters"], _turns(row))):
            yield {"conv_id": row["conv_id"], "part": row["part"], "chunk": row["chunk"], "seq": i, "edit": edit, "role": role, "text": text}


def repaired(chunks: DataFrame, chosen: DataFrame) -> DataFrame:
    """conv_id, part, chunk, seq (their order), edit, role, text: a row per turn and per inserted turn; those with the
    edit D are out."""
    schema = T.StructType([chunks.schema["conv_id"], *T.StructType.fromDDL("part long, chunk long, seq int, edit string, role string, text string").fields])
    return _mapped(_together(chunks, chosen, ("conv_id", "part", "chunk")), _apply, schema, 1024)


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _report(rows: Iterator[dict]) -> Iterator[dict]:
    out, choice, audit, digest, last = None, None, [], None, None
    for row in rows:
        if out is None or row["conv_id"] != out["conv_id"]:
            if out is not None:
                yield out | {"audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
            out, audit, digest, last, lines, seen = {"conv_id": row["conv_id"]} | dict.fromkeys(COUNTS, 0), [], hashlib.sha256(), None, 0, None
        if row["__kind"] == 0:
            choice = row
            out["cost"] = row["cost"]
            continue
        for name in ("blank", "duplicate", "truncated", "illegal"):
            out[name] += row[name]
        if last is not None:
            out["illegal"] += last["last_role"][:1] + row["first_role"][:1] not in LEGAL
        last = row
        if row["turns_seen"]:
            # from the last turn that was seen to the last one here, less the turns that are new
            before = row["first_turn"] - 1 if seen is None else seen
            out["gaps"] += row["last_turn"] - before - row["turns_seen"] + (row["first_turn"] == seen)
            seen = row["last_turn"]
        audit.append(choice["letters"])
        for edit, role, text in mend(choice["start"], choice["letters"], _turns(row)):
            if edit != "D":
                digest.update((("\n" if lines else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
                lines += 1
    if out is not None:
        yield out | {"audit": "".join(audit), "repaired_sha256": digest.hexdigest()}


def reports(chunks: DataFrame, chosen: DataFrame) -> DataFrame:
    """A row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    ddl = ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
    schema = T.StructType([chunks.schema["conv_id"], *T.StructType.fromDDL(ddl).fields])
    return _mapped(_together(chunks, chosen, ("conv_id",)), _report, schema)


def audited(every: DataFrame, rows: DataFrame) -> DataFrame:
    """Reports of rows (conv_id, turn, role, text), and of the conversations of `every` that have no row: zeros, an empty
    audit and the digest of nothing."""
    chunks = chunked(faulted(rows))
    found = reports(chunks, choose(chunks)).withColumnRenamed("conv_id", "__conv")
    joined = every.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("__conv")), "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in COUNTS]
    return joined.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
