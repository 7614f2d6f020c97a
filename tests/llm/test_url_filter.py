import pytest
from pyspark.sql import functions as F

from spindlekg.llm import url_filter as uf

CASES = {
    "http://a.org/x": ("a.org", "/x", "org/", "allow"),
    "HTTP://A.ORG": ("a.org", "", None, "allow"),
    "http://example.org/es/1?x": ("example.org", "/es/1", "example.org/es/", "block"),
    "http://b.example.org/en/12#f": ("b.example.org", "/en/12", "example.org/en/1", "block"),
    "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
    "http://x.com/fr/casino": ("x.com", "/fr/casino", "com/fr/", "allow"),
    "http://x.com/de/": ("x.com", "/de/", "com/de/", "block"),
    "http://casino-win.net/": ("casino-win.net", "/", None, "block"),
    "http://casinoz.net/": ("casinoz.net", "/", None, "allow"),
    "http://free.net/free/FREE": ("free.net", "/free/FREE", None, "allow"),
    "http://free.net/cheap": ("free.net", "/cheap", None, "block"),
    "no scheme": ("", "", None, "allow"),
    "casino": ("", "", None, "block"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
    "a://b://c/": ("b:", "//c/", None, "allow"),
    "http://É.com/ñ\nx": ("É.com", "/ñ\nx", None, "allow"),
}


def test_cases(spark):
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate([*CASES, None])], "page_id int, url string, host string")
    found = uf.judge(df, F.col("page_id"), F.col("url")).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in found] == [*CASES.values(), CASES[None]]
    assert uf.judge(df.limit(0), F.col("page_id"), F.col("url")).count() == 0


@pytest.mark.parametrize("text, found", [("xxx", (1, 0, 6)), ("axxx", (0, 0, 0)), ("xxx1", (0, 0, 0)), ("-xxx-xxx.", (1, 0, 6)), ("bet bets betting", (0, 3, 9)), ("éxxxé", (1, 0, 6)), ("deals-deals/offer", (0, 2, 4)), ("deals-offer.discount", (0, 3, 6))])
def test_terms_stand_alone(text, found):
    assert uf.term_counter(uf.TERMS)(text) == found


@pytest.mark.parametrize("order", [1, -1])
def test_of_rules_of_equal_length_the_first_wins(spark, order):
    rules = [uf.Rule("org", "/abc", "allow"), uf.Rule("a.org", "/a", "block")][::order]
    assert len({len(r.name) for r in rules}) == 1
    got = uf.judge(spark.createDataFrame([("http://a.org/abc",)], "url string"), F.lit(1), F.col("url"), rules).first()
    assert (got.rule, got.verdict) == (rules[0].name, rules[0].verdict)


def test_terms_from_a_table(spark, monkeypatch):
    table = spark.createDataFrame([("Bad", 9), ("bad", 2), ("iffy", 5), ("dull", 1), (None, 9), ("", 9), ("nil", None)], "term string, weight int")
    terms = uf.vocabulary(table)
    assert terms == {"bad": 9, "iffy": 5, "dull": 1}
    urls = spark.createDataFrame([(i, u) for i, u in enumerate(["http://x/bad", "http://x/iffy", "http://iffy/dull", "http://x/casino"])], "i int, url string")
    got = uf.judge(urls, F.col("i"), F.col("url"), (), terms).orderBy("page_id").collect()
    assert [(r.verdict, r.weight) for r in got] == [("block", 9), ("allow", 5), ("block", 6), ("allow", 0)]
    assert {r.verdict for r in uf.judge(urls, F.col("i"), F.col("url"), (), {}).collect()} == {"allow"}
    monkeypatch.setattr(uf, "MOST_TERMS", 2)
    with pytest.raises(ValueError):
        uf.vocabulary(table)
