"""Chat formatting from an event log, in DataFrame functions alone.

A log holds events of messages: `message` (whole text), `delta` (text to append), `edit` (text to put in place),
`regenerate` (start again, with this text) and `delete`. Events are grouped by conversation and message, sorted by
sequence and folded: a message's text is that of its last event that is no delta and of the deltas after it.
Messages are then rendered in blocks of neighbouring positions, so that a conversation of any length is rendered in
many tasks and no rendered string grows with it.

A turn is rendered as `<s>role [INST] text [/INST]`, or `<s>role [ANSWER] text </s>` for the roles that are learned
from, and a line break. Control strings within roles and texts get a caret in front, besides the carets that are there,
which is undone by taking one away; a control string without a caret is the template's.

`streamed` makes such a log of whole messages: every text arrives in deltas, in three cases of four after a draft that is
edited away, or regenerated, or deleted and regenerated.

Edges, all tested: a null text is empty and a null role is the empty role; rows with a null conversation form one; null
positions come first; ties are ordered by role, then text, and repeated rows are turns of their own in op3, where every
row becomes a message; a message with only deltas is their text; an empty table returns no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROL = r"</?s>|\[/?INST\]|\[ANSWER\]"
BLOCK_TURNS = 64
LEARNED_ROLES = ("assistant",)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(\^*(?:{CONTROL}))", "^$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"\^(\^*(?:{CONTROL}))", "$1")


DELTAS = 4


def streamed(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text to events, of which the sequence is (turn, step): repeated rows are messages of their own.

    What happens to a message depends on a hash of it, so the log is the same whenever it is made. Its first event alone
    has the role.
    """
    counted = rows.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n"))
    each = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    each = each.withColumn("message", F.concat_ws(":", F.md5(F.concat_ws("\x1f", F.coalesce(F.col("turn").cast("string"), F.lit("-")), F.coalesce("role", F.lit("")), "text")), "copy"))
    size = F.greatest(F.lit(1), F.ceil(F.length("text") / DELTAS).cast("int"))
    part = lambda i: F.substring(F.col("text"), size * i + 1, size)
    event = lambda step, kind, text: F.struct(F.lit(step).alias("step"), F.lit(kind).alias("kind"), text.alias("text"))
    draft = event(0, "message", F.concat(F.lit("a first draft of "), part(1)))
    more = event(1, "delta", F.lit(" with more to come"))
    case = F.pmod(F.xxhash64("conv_id", "message"), F.lit(4))
    starts = F.when(case == 0, F.array(event(0, "message", part(0)))).when(case == 1, F.array(event(2, "edit", part(0)), more, draft))
    starts = starts.when(case == 2, F.array(event(2, "regenerate", part(0)), more, draft)).otherwise(F.array(event(2, "regenerate", part(0)), event(1, "delete", F.lit(None).cast("string")), draft))
    deltas = F.array(*[event(2 + i, "delta", part(i)) for i in reversed(range(1, DELTAS))])
    log = each.select("conv_id", "turn", "message", "role", F.explode(F.concat(deltas, starts)).alias("e"))
    return log.select("conv_id", "message", F.struct("turn", "e.step").alias("seq"), "e.kind", F.when(F.col("e.step") == 0, F.col("role")).alias("role"), "e.text")


def reconstruct(events: DataFrame) -> DataFrame:
    """events: conv_id, message, seq, kind, role, text. Returns conv_id, position, role, text, a row per message that is
    not deleted: position is its first seq, role its last role that is not null."""
    folded = events.groupBy("conv_id", "message").agg(
        F.min("seq").alias("position"),
        F.max_by("role", F.when(F.col("role").isNotNull(), F.struct("seq", "role"))).alias("role"),
        F.array_sort(F.collect_list(F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text")))).alias("events"),
    )
    resets = F.transform("events", lambda e, i: F.when(e["kind"] != "delta", i + 1).otherwise(0))
    start = F.greatest(F.array_max(resets), F.lit(1))
    live = F.slice("events", start, F.size("events"))
    text = F.array_join(F.transform(live, lambda e: e["text"]), "")
    return folded.where(F.element_at(live, 1)["kind"] != "delete").select("conv_id", "position", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))


def render(messages: DataFrame, learned: tuple[str, ...] = LEARNED_ROLES) -> DataFrame:
    """Rows conv_id, block, n_turns, formatted, loss (spans of formatted, as start from 1 and length, in code points).

    A conversation's formatted text is that of its blocks in order.
    """
    block = F.coalesce(F.floor(F.col("position") / BLOCK_TURNS), F.lit(-(1 << 62)))
    rows = messages.select("conv_id", block.alias("block"), "position", "role", "text")
    blocks = rows.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(F.struct("position", "role", "text"))).alias("turns"))

    def turn(t: Column) -> Column:
        learn = t["role"].isin(*learned)
        head = F.concat(F.lit("<s>"), escape(t["role"]), F.when(learn, " [ANSWER] ").otherwise(" [INST] "))
        return F.struct(head.alias("head"), escape(t["text"]).alias("body"), F.when(learn, " </s>\n").otherwise(" [/INST]\n").alias("tail"), learn.alias("learn"))

    made = blocks.select("conv_id", "block", F.transform("turns", turn).alias("turns"))
    made = made.withColumn("sizes", F.transform("turns", lambda t: F.length(t["head"]) + F.length(t["body"]) + F.length(t["tail"])))
    spans = F.transform("turns", lambda t, i: F.struct(t["learn"].alias("learn"), (F.aggregate(F.slice("sizes", 1, i), F.lit(1), lambda a, x: a + x) + F.length(t["head"])).alias("start"), F.length(t["body"]).alias("length")))
    loss = F.transform(F.filter(spans, lambda s: s["learn"]), lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")))
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], t["tail"])), "")
    return made.select("conv_id", "block", F.size("turns").cast("long").alias("n_turns"), formatted.alias("formatted"), loss.alias("loss"))


def read_back(blocks: DataFrame) -> DataFrame:
    """From formatted texts and loss spans alone: conv_id, block, turns (role and text), learned (texts under the mask)."""
    parts = F.slice(F.split("formatted", r"(?<!\^)<s>"), 2, 1 << 30)
    shape = r"(?s)^(.*?) (?<!\^)\[(?:INST|ANSWER)\] (.*) (?:\[/INST\]|</s>)\n$"
    turns = F.transform(parts, lambda p: F.struct(unescape(F.regexp_extract(p, shape, 1)).alias("role"), unescape(F.regexp_extract(p, shape, 2)).alias("text")))
    learned = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"], s["length"])))
    return blocks.select("conv_id", "block", turns.alias("turns"), learned.alias("learned"), F.length("formatted").cast("long").alias("formatted_chars"))


def digests(read: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Strings are joined within blocks first; only these meet per conversation, as its digest needs them in order.
    """
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    rows = read.select("conv_id", "block", F.size("turns").cast("long").alias("n"), said.alias("said"), F.array_join("learned", "").alias("loss"), "formatted_chars")
    whole = rows.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.array_sort(F.collect_list(F.struct("block", "said", "loss"))).alias("b"), F.sum("formatted_chars").alias("formatted_chars"))
    joined = whole.select("conv_id", "n_turns", F.array_join(F.transform("b", lambda x: x["said"]), "").alias("said"), F.array_join(F.transform("b", lambda x: x["loss"]), "").alias("loss"), "formatted_chars")
    return joined.select("conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def oracle() -> str:
    """The digests of the conversations table, straight from its rows, in DuckDB."""
    shown = lambda c: rf"regexp_replace({c}, '(\^*(?:{CONTROL}))', '^\1', 'g')"
    return f"""WITH every AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT conv_id, turn, role, text, length({shown("role")}) + length({shown("text")}) + CASE WHEN role = 'assistant' THEN 19 ELSE 20 END AS size FROM every)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
CAST(sum(size) AS BIGINT) AS formatted_chars FROM t GROUP BY conv_id"""
