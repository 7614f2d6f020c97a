import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from spindlekg.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
#: What may follow in `(s?(ua)+)?`: 0 nothing yet, 1 system, 2 user, 3 assistant.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def damaged(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        case = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        for _ in range((case != 0) + (case == 3)):
            yield conv, turn, "user" if case == 4 else role, text


def cheapest(turns, faults):
    """Cheapest edits by a best-first search over (place, state), whole audits compared."""
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if i == len(turns) and state in (0, 3):
            return cost, audit, lines
        if (i, state) in done:
            continue
        done.add((i, state))
        given = [("u", "user"), ("a", "assistant")]
        for initial, role in given:
            if (state, initial) in NEXT:
                heapq.heappush(heap, (cost + 3, audit + "I", i, NEXT[state, initial], (*lines, role + ":")))
        if i < len(turns):
            (_, own, text), more = turns[i], 3 * (faults[i] == "truncated")
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, lines))
            if faults[i] not in ("blank", "duplicate"):
                for letter, price, initial, role in [("K", 0, own[:1], own), *[("R", 3, a, b) for a, b in given]]:
                    if (state, initial) in NEXT:
                        heapq.heappush(heap, (cost + price + more, audit + letter, i + 1, NEXT[state, initial], (*lines, f"{role}:{text}")))
    raise AssertionError


def brute(rows):
    convs = {r[0]: [] for r in rows}
    for conv, *rest in damaged(rows):
        convs[conv].append(tuple(rest))
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        places, faults, seen = [t[0] for t in turns if t[0] is not None], [], set()
        for _, role, text in turns:
            kept = text.rstrip(WHITE)
            faults.append("blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else "")
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit, lines = cheapest(turns, faults)
        gaps = max(places) - min(places) + 1 - len(set(places)) if places else 0
        yield (conv, gaps, *[faults.count(x) for x in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def odd(n, seed=3):
    rnd = random.Random(seed)
    texts = ["a.", "b!", "c", "", None, " \t", "Hello?  ", "d.", "e. ", "u\n\x0b", "q..!"]
    roles = ["user", "assistant", "system", None, "tool", "", "unknown", "user", "assistant", "assistant"]
    return [(rnd.choice([1, 1, 1, 1, 2, 3, None]), rnd.choice([None, *range(40)]), rnd.choice(roles), rnd.choice([*texts, f"x{rnd.random()}."])) for _ in range(n)]


def test_automaton_takes_the_grammar_alone():
    pattern = re.compile(r"(s?(ua)+)?")
    for n in range(7):
        for k in range(3**n):
            word = "".join("sua"[k // 3**i % 3] for i in range(n))
            stack = repair.BOTTOM
            for symbol in word:
                stack = stack and repair.advance(stack, symbol)
            assert bool(stack is not None and stack[0] in repair.ACCEPTS) == bool(pattern.fullmatch(word))


def test_parse_equals_a_search_for_the_cheapest():
    rnd = random.Random(9)
    for _ in range(300):
        turns = [(rnd.choice(["user", "assistant", "system", "tool", ""]), f"t{i}", rnd.choice(["", "", "truncated", "blank", "duplicate"]), 1) for i in range(rnd.randint(0, 9))]
        found = min(w for s, w in repair.parse(turns, repair.BOTTOM).items() if s[0] in repair.ACCEPTS)
        cost, audit, lines = cheapest([(0, r, t) for r, t, *_ in turns], [t[2] for t in turns])
        assert found == (cost, audit)
        assert [f"{r}:{t}" for e, r, t in repair.mend(0, audit, turns) if e != "D"] == list(lines)


def test_query(spark):
    data = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in queries.table(spark, data, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = [tuple(r) for r in queries.op13_conversation_repair(spark, data).select(*COLUMNS).collect()]
    assert ordered(got) == ordered(brute(rows))


@pytest.mark.parametrize("size", [1, 7, 512])
def test_odd_rows_in_chunks_of_any_size(spark, size):
    rows = odd(1500)
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA + ", fault string, __kind int")
    chunks = repair.chunked(repair.faulted(repair.damage(df)), size)
    got = [tuple(r) for r in repair.reports(chunks, repair.choose(chunks)).select(*COLUMNS).collect()]
    assert ordered(got) == ordered(brute(rows))


def test_repaired_turns_follow_the_grammar(spark):
    df = spark.createDataFrame(odd(800, 4), SCHEMA)
    chunks = repair.chunked(repair.faulted(df), 16)
    rows = repair.repaired(chunks, repair.choose(chunks)).orderBy("conv_id", "part", "chunk", "seq").collect()
    convs = {}
    for r in rows:
        if r.edit != "D":
            convs.setdefault(r.conv_id, []).append(r.role[:1])
    assert convs and all(re.fullmatch(r"(s?(ua)+)?", "".join(x)) for x in convs.values())
    assert sum(r.edit != "I" for r in rows) == 800


def test_edges(spark):
    rows = [(1, 0, "user", "x."), (1, 0, "user", "x.")] * 40 + [(2, None, None, None), (None, 5, "user", "y."), (None, 9, "assistant", "long. " * 100_000), (7, 3, "user", "Same."), (7, 4, "user", "Same.")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in repair.audited(df, repair.damage(df)).select(*COLUMNS).collect()]
    assert ordered(got) == ordered(brute(rows))
    assert repair.audited(df.limit(0), repair.damage(df.limit(0))).count() == 0
    gone = repair.audited(df, df.limit(0)).select(*COLUMNS).collect()
    assert {tuple(r)[1:] for r in gone} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())} and len(gone) == 4


def test_a_conversation_that_holds_nearly_all_rows_is_dealt_out(spark):
    rows = [(1, i % 5, ("user", "assistant")[i % 2], f"turn {i}.") for i in range(4000)] + [(2, 0, "user", "x.")]
    faulted = repair.faulted(spark.createDataFrame(rows, SCHEMA))
    parts = repair.chunked(faulted, 64).where("conv_id = 1").groupBy("part").agg(F.sum(F.size("turns")).alias("n")).collect()
    assert len(parts) > 1 and max(r.n for r in parts) < 2500
