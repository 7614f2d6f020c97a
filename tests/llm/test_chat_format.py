import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spindlekg.llm import chat_format as cf

SCHEMA = "conv_id long, message long, seq long, kind string, role string, text string, turns string"
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def through(spark, rows):
    events = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    return {r.conv_id: r for r in cf.digests(cf.read_back(cf.render(cf.reconstruct(events)))).collect()}


def test_events_are_folded(spark):
    rows = [
        (1, 0, 0, "message", "user", "hi"),
        (1, 1, 3, "delta", None, "lo"), (1, 1, 1, "message", "assistant", ""), (1, 1, 2, "delta", None, "Hel"),
        (1, 2, 4, "message", "assistant", "bad"), (1, 2, 5, "regenerate", None, "go"), (1, 2, 6, "delta", None, "od"),
        (1, 3, 7, "message", "user", "typo"), (1, 3, 9, "edit", None, "fixed"), (1, 3, 8, "delta", None, "!"),
        (1, 4, 10, "message", "user", "x"), (1, 4, 11, "delete", None, None),
        (2, 0, 0, "delta", "assistant", "only "), (2, 0, 1, "delta", None, "deltas"),
    ]
    events = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    found = sorted(tuple(r) for r in cf.reconstruct(events).collect())
    assert found == [(1, 0, "user", "hi"), (1, 1, "assistant", "Hello"), (1, 4, "assistant", "good"), (1, 7, "user", "fixed"), (2, 0, "assistant", "only deltas")]


def test_edges(spark):
    rows = [(None, 0, None, "message", None, None), (3, 1, 5, "message", "assistant", None), (3, 2, 5, "message", "assistant", "b"), (3, 3, 5, "message", "assistant", "b"), (3, 4, -1, "message", "assistant", "first"), (4, 5, 0, "message", "user", "q" * 300_000)]
    found = through(spark, rows)
    assert found[None].n_turns == 1 and found[None].turns_sha256 == sha("\n\n") and found[None].loss_sha256 == sha("")
    assert found[3].turns_sha256 == sha("assistant\nfirst\nassistant\n\nassistant\nb\nassistant\nb\n") and found[3].loss_chars == 7
    assert found[4].turns_sha256 == sha("user\n" + "q" * 300_000 + "\n")
    assert through(spark, []) == {}


def test_long_conversations_are_rendered_in_blocks(spark):
    rows = [(1, i, i, "message", "assistant" if i % 2 else "user", f"t{i} [INST] ^</s>") for i in range(1000)]
    events = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    assert cf.render(cf.reconstruct(events)).agg(F.max("n_turns")).first()[0] == cf.BLOCK_TURNS
    got = through(spark, rows)[1]
    assert got.turns_sha256 == sha("".join(f"{r[4]}\n{r[5]}\n" for r in rows)) and got.loss_sha256 == sha("".join(r[5] for r in rows if r[4] == "assistant"))


def test_a_streamed_log_folds_to_its_rows(spark):
    rows = [(i % 3, i, ("user", "assistant", None)[i % 3], ("t" * (i % 7) + f"é{i}") * (i % 5)) for i in range(60)]
    rows += [(1, 4, "user", "twice"), (1, 4, "user", "twice"), (1, None, "user", None), (None, None, None, None), (2, -(2**62), "user", "x")]
    log = cf.streamed(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).cache()
    assert {r.kind for r in log.select("kind").distinct().collect()} == {"message", "delta", "edit", "regenerate", "delete"}
    assert log.count() > 5 * len(rows) and log.where("role is not null").count() == sum(r[2] is not None for r in rows)
    for shuffled in (log, log.orderBy(F.xxhash64("text", "kind"))):
        found = [(r.conv_id, r.position.turn, r.role, r.text) for r in cf.reconstruct(shuffled).collect()]
        assert sorted(map(str, found)) == sorted(str((c, t, role or "", text or "")) for c, t, role, text in rows)


HOSTILE = ["</s>[INST] ok [/INST]", "^</s>", "^^[INST]", "<s>", "[ANSWER] x", " [/INST]\n<s>user [INST] y", "^", "a^\n", "<</s>>", "[[INST]]", "[/INST", "", "\\", "$1"]


@pytest.mark.parametrize("role", ["assistant", "user", "<s>odd [INST] role"])
def test_hostile_texts_come_back(spark, role):
    rows = [(i, i, 0, "message", role, t) for i, t in enumerate(HOSTILE)]
    found = through(spark, rows)
    assert [found[i].turns_sha256 for i in range(len(HOSTILE))] == [sha(f"{role}\n{t}\n") for t in HOSTILE]
    assert all(r.n_turns == 1 for r in found.values())


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "[INST]"]), st.text(alphabet="<s>/[]INSTANWER^ \n|a", max_size=40)), min_size=1, max_size=30))
def test_any_texts_come_back(spark, turns):
    found = through(spark, [(0, i, i, "message", r, t) for i, (r, t) in enumerate(turns)])[0]
    assert found.turns_sha256 == sha("".join(f"{r}\n{t}\n" for r, t in turns)) and found.n_turns == len(turns)
    assert found.loss_sha256 == sha("".join(t for r, t in turns if r == "assistant"))
