import datetime
import random
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spindlekg.llm import pii

MAKE, UNDO = pii.Pseudonyms(b"key"), pii.Pseudonyms(b"key", -1)
TEXTS = {
    "card": "4111 1111 1111 1111",
    "phone": "+1 (017) 555-7713",
    "ip": "97.51.17.173",
    "iso": "2024-02-29",
    "day": "25/12/1999",
    "ssn": "078-05-1120",
    "iban": "GB82 WEST 1234 5698 7654 32",
    "mail": "ou.34@mail7.example.com",
    "secret": 'token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce"',
}


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000])
def test_permutation_without_fixed_points(size):
    p = pii.Permutation(b"key", "kind", size)
    moved = [p.move(x) for x in range(size)]
    assert sorted(moved) == list(range(size)) and [p.move(x, -1) for x in moved] == list(range(size))
    assert size == 1 or all(a != b for a, b in enumerate(moved))


@pytest.mark.parametrize("kind", TEXTS)
def test_format_is_kept_and_the_key_undoes_it(kind):
    text = f"before {TEXTS[kind]} after, {TEXTS[kind]}."
    made, counts = MAKE.apply(text)
    assert counts == {kind: 2} and TEXTS[kind].split('"')[-2 if kind == "secret" else 0] not in made
    one, two = made.removeprefix("before ").removesuffix(".").split(" after, ")
    assert one == two
    if kind != "ip":
        assert re.sub(r"\d", "0", re.sub("[a-f0-9]{40}", "0", made)) == re.sub(r"\d", "0", re.sub("[a-f0-9]{40}", "0", text)) or kind in ("iban", "mail")
    assert UNDO.apply(made)[0] == text
    assert pii.Pseudonyms(b"other").apply(text)[0] != made


def test_made_values_are_valid():
    digits = re.sub(r"\D", "", MAKE.apply("4111 1111 1111 1111")[0])
    assert pii.luhn_digit(digits[:-1]) == digits[-1]
    assert 1900 <= datetime.date.fromisoformat(MAKE.apply("on 2024-02-29")[0][3:]).year < 2100
    iban = MAKE.apply("DE89370400440532013000")[0]
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def test_values_are_linked_whatever_their_punctuation():
    a, b = MAKE.apply("4111 1111 1111 1111")[0], MAKE.apply("4111-1111-1111-1111")[0]
    assert a.replace(" ", "") == b.replace("-", "")


@pytest.mark.parametrize("text", ["9807915762804490", "4111111111111112", "version 4.0.", "999.1.2.3", "1.2.3.4.5", "2023-02-30", "31/31/2000", "GB82 WEST 1234 5698 7654 33", "000-12-3456", "a@b", "@", "the year 2024", "token = \"\"", "1 2 3 4 5 6 7", ""])
def test_what_fails_its_check_stays(text):
    assert MAKE.apply(text) == (text, {})


@given(st.integers(0, 10**15 - 1))
def test_any_card_comes_back(n):
    payload = f"{n:015d}"
    text = payload + pii.luhn_digit(payload)
    assert UNDO.apply(MAKE.apply(text)[0])[0] == text


def test_planted_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    both = pii.pseudonymise(docs, b"key", found_col="found").join(docs.select("doc_id", F.col("text").alias("was")), "doc_id").collect()
    changed = [r for r in both if r.found]
    assert len(changed) > 10 and all(r.text == r.was for r in both if not r.found)
    private = re.compile(r"[\w.]+@[\w.]+\.com|\+1 \(\d{3}\) \d{3}-\d{4}|(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.])")
    for r in changed:
        assert not set(private.findall(r.was)) & set(private.findall(r.text))
        assert UNDO.apply(r.text)[0] == r.was


def test_edges(spark, edges, nothing):
    found = pii.pseudonymise(edges, b"key", found_col="found")
    assert found.columns == [*edges.columns, "found"]
    assert sorted(map(repr, found.drop("found").collect())) == sorted(map(repr, edges.collect()))
    assert pii.pseudonymise(nothing, b"key").count() == 0
    assert pii.pseudonymise(spark.createDataFrame([("4111111111111111",)], "text string"), b"key").columns == ["text"]
    long = "x" * 500_000 + " 4111111111111111 " + "y " * 200_000
    assert MAKE.apply(long)[1] == {"card": 1}


CARD, PHONE, IP = "4111 1111 1111 1111", "+1 (826) 555-4081", "190.137.223.204"


@pytest.mark.parametrize("before, after", [(PHONE, IP), (PHONE, "2024"), (PHONE, "2024-02-29"), (PHONE, CARD), (CARD, "12"), (CARD, "123"), (CARD, IP), (CARD, CARD), ("4111111111111111", "12"), ("+44 20 7946 0958", "2024"), (IP, PHONE), ("12", CARD), ("1234", CARD), ("2023-02-30", CARD), ("999.1.2.3", PHONE)])
def test_adjacent_numbers_are_as_alone(before, after):
    one, two = MAKE.apply(before), MAKE.apply(after)
    made, counts = MAKE.apply(f"call {before} {after} now")
    assert made == f"call {one[0]} {two[0]} now"
    assert sum(counts.values()) == sum(one[1].values()) + sum(two[1].values())


@pytest.mark.parametrize("before, value, after, kind", [
    ("AWS_SECRET_ACCESS_KEY=", "wJalrXUtnFEMI1K7MDENG", "\n", "secret"), ("export db-password-prod: '", "hunter2hunter2", "'", "secret"), ("password=", "hunterhunter", "&x", "secret"), ("my_token_2 = ", "a1b2c3d4e5", " end", "secret"),
    ("at ", "2024-01-15", "T10:00:00Z", "iso"), ("file", "gb82west12345698765432", " ok", None), ("iban ", "gb82west12345698765432", ", ok", "iban"), ("iban ", "gb82 west 1234 5698 7654 32", ".", "iban"),
    ("tel ", "06 12 34 56 78", "", "phone"), ("tel ", "06.12.34.56.78", " x", "phone"), ("x", "06 12 34 56 78", "", None), ("password: ", "required", " field", None), ("passwords=", "hunterhunter", "", None), ("token=", "identifier", ";", None), ("2024-01-15", "Table", "", None),
])
def test_values_in_odd_places(before, value, after, kind):
    made, counts = MAKE.apply(before + value + after)
    assert counts == ({kind: 1} if kind else {})
    if kind:
        new = made.removeprefix(before).removesuffix(after) if after else made.removeprefix(before)
        assert new != value and len(new) == len(value) and [c.isalnum() for c in new] == [c.isalnum() for c in value] and new.islower() == value.islower()
        assert UNDO.apply(made)[0] == before + value + after
    else:
        assert made == before + value + after


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def planted(rng):
    """A value of each kind with its check, made without the operator."""
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    while not luhn(card := "4" + digits(15)) or len(set(card)) < 3:
        pass
    bank = digits(18)
    check = next(c for c in (f"{x:02d}" for x in range(2, 99)) if int(bank + "1314" + c) % 97 == 1)
    ip = ".".join(str(rng.randrange(256)) for _ in range(4))
    return {
        "card": card, "iban": f"DE{check}{bank}", "ip": ip, "ssn": f"{rng.randrange(1, 600):03d}-{rng.randrange(1, 99):02d}-{rng.randrange(1, 9999):04d}".replace("666-", "667-"),
        "iso": datetime.date.fromordinal(rng.randrange(700_000, 760_000)).isoformat(), "phone": f"+1 ({rng.randrange(200, 999)}) 555-{digits(4)}", "mail": f"{rng.choice('abc')}{digits(3)}.x@mail.example.org", "secret": f"api_key={digits(4)}a{digits(5)}",
    }


def test_planted_values_are_all_replaced_and_nothing_else(spark):
    """Independent of what the operator finds: known values between known words, each value in several documents."""
    rng = random.Random(7)
    words, rows, truth = ["alpha", "b2", "c-3", "(d)", "e.", "1,234", "12%", "v1.2"], [], {}
    values = [v for _ in range(12) for v in planted(rng).items()]
    for i in range(200):
        parts, marks = [], []
        for kind, value in rng.sample(values, rng.randrange(4)):
            parts += [rng.choice(words) + " x", value]
            marks.append((kind, value))
        truth[i] = (parts, marks)
        rows.append((i, " | ".join([*parts, "end"])))
    linked = {}
    for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), b"key").collect():
        parts, marks = truth[r.doc_id]
        got = r.text.split(" | ")
        assert got[-1] == "end" and got[:-1:2] == parts[::2]
        for (kind, value), new in zip(marks, got[1::2], strict=True):
            assert new != value and linked.setdefault((kind, value), new) == new
            assert kind not in ("card", "iso", "ip") or (luhn(new) and len(new) == 16 if kind == "card" else datetime.date.fromisoformat(new) if kind == "iso" else all(0 <= int(x) < 256 for x in new.split(".")))
    assert len(set(linked.values())) == len(linked)
