"""URL filtering: host and path rules first, then a weighted vocabulary found by Aho-Corasick.

A term counts once per URL, and only where the characters on both sides are not ASCII letters or digits. Every term has a
weight; a strict one weighs as much as the threshold, a soft one less, so one strict or several distinct soft terms
reject. The terms are a mapping, which `vocabulary` reads from a table.

Edges, all tested: a null url, or one without `://`, has empty host and path, fits no rule and is judged by its terms
(a null has none and is allowed); repeated rows each return a row; an empty table returns no rows; of rules of equal
length that both fit, the one listed first wins. Extra columns are not read and not returned.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST_PATH = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """Fits the host and its subdomains where the url's path starts with path."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("org", "/", "allow"), Rule("example.org", "/es/", "block"), Rule("example.org", "/en/1", "block"), Rule("com", "/fr/", "allow"), Rule("com", "/de/", "block"))
#: Terms by weight. A url is rejected when the weights of its different terms reach REJECT_AT: by one strict term, two
#: soft ones of weight 3, or three of weight 2.
REJECT_AT = 6
STRICT = (
    "adultcam", "bestiality", "blackjack", "blowjob", "botnet", "camgirl", "camgirls", "carding", "casino", "casinos", "cialis", "cumshot", "deepfake", "escort", "escorts", "exploitkit", "fleshlight", "fullz", "gangbang", "hentai", "hookup", "hookups", "incest", "keylogger",
    "levitra", "livesex", "malware", "milf", "nsfw", "onlyfans", "phishing", "porn", "porno", "pornhub", "ransomware", "rootkit", "sexcam", "sexcams", "sextoy", "spyware", "striptease", "swingers", "trojan", "upskirt", "viagra", "warez", "webcamsex", "xanax", "xxx",
)
SOFT_3 = (
    "ads", "adserver", "banner", "bet", "bets", "betting", "bonus", "cheap", "clicks", "coupon", "crack", "cracked", "farm", "free", "jackpot", "keygen", "lingerie", "loans", "lottery", "naked", "nude", "nudes", "payday", "pills", "poker", "popup", "prize", "promo", "replica",
    "roulette", "sex", "sexy", "slots", "spam", "steroids", "torrent", "torrents", "track", "tracker", "win", "winner",
)
SOFT_2 = (
    "adult", "affiliate", "airdrop", "babes", "clickbait", "credit", "dating", "debt", "deal", "deals", "diet", "discount", "erotic", "forex", "giveaway", "hacks", "hot", "investor", "miracle", "nulled", "offer", "offers", "outlet", "parked", "pharmacy", "proxy", "referral", "rich",
    "sponsor", "sweepstakes", "traffic", "voucher", "weightloss", "wholesale",
)
TERMS = {term: weight for weight, terms in ((REJECT_AT, STRICT), (3, SOFT_3), (2, SOFT_2)) for term in terms}
#: Terms that a vocabulary may have: each Python worker holds them all.
MOST_TERMS = 1_000_000


def vocabulary(table: DataFrame) -> dict[str, int]:
    """Terms from a table (term, weight), lower-cased, of repeated ones the largest weight; null and empty ones are left
    out. Refuses a table of over MOST_TERMS terms."""
    lowered = F.translate(F.col("term").cast("string"), UPPER, LOWER)
    terms = table.select(lowered.alias("term"), F.col("weight").cast("long").alias("weight")).where("term <> '' and weight > 0")
    found = terms.groupBy("term").agg(F.max("weight").alias("weight")).limit(MOST_TERMS + 1).collect()
    if len(found) > MOST_TERMS:
        raise ValueError(f"over {MOST_TERMS} terms")
    return {r["term"]: r["weight"] for r in found}


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url.cast("string"), F.lit(""))
    return F.translate(F.regexp_extract(url, HOST_PATH, 1), UPPER, LOWER), F.regexp_extract(url, HOST_PATH, 2)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in reversed(sorted(rules, key=lambda r: -len(r.name))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, verdict = F.when(fits, F.lit(rule.name)).otherwise(name), F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def term_counter(terms: Mapping[str, int], reject_at: int = REJECT_AT):
    """A function of one lower-cased text: how many different strict and soft terms stand in it alone, and their weight."""
    machine = ahocorasick.Automaton()
    for term in terms:
        machine.add_word(term, term)
    machine.make_automaton()
    part_of_word = set(LOWER + UPPER + "0123456789")

    def count(text: str) -> tuple[int, int, int]:
        found = set()
        for end, term in machine.iter(text) if terms else ():
            start = end - len(term)
            if (start < 0 or text[start] not in part_of_word) and (end + 1 == len(text) or text[end + 1] not in part_of_word):
                found.add(term)
        weights = [terms[t] for t in found]
        strict = sum(w >= reject_at for w in weights)
        return strict, len(weights) - strict, sum(weights)

    return count


def judge(pages: DataFrame, page_id: Column, url: Column, rules: Sequence[Rule] = RULES, terms: Mapping[str, int] = TERMS, reject_at: int = REJECT_AT) -> DataFrame:
    """page_id, host, path, rule, verdict, n_strict, n_soft, weight: a row per input row, without a shuffle."""

    @F.pandas_udf("n_strict long, n_soft long, weight long")
    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        count = term_counter(terms, reject_at)
        for batch in batches:
            yield pd.DataFrame([count(u) for u in batch], columns=["n_strict", "n_soft", "weight"])

    host, path = host_and_path(url)
    lowered = F.translate(F.coalesce(url.cast("string"), F.lit("")), UPPER, LOWER)
    rows = pages.select(page_id.alias("page_id"), host.alias("host"), path.alias("path"), counts(lowered).alias("t"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    by_terms = F.when(F.col("t.weight") >= reject_at, F.lit("block")).otherwise(F.lit("allow"))
    return rows.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_terms).alias("verdict"), "t.n_strict", "t.n_soft", "t.weight")


def oracle() -> str:
    """The same in DuckDB, with a regular expression per term."""
    listed = "[" + ", ".join(f"{{'t': '{t}', 'w': {w}}}" for t, w in TERMS.items()) + "]"
    ordered = sorted(RULES, key=lambda r: -len(r.name))
    fits = lambda r: f"(host = '{r.host}' OR suffix(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
    name = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r.name}'" for r in ordered) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r.verdict}'" for r in ordered) + f" WHEN weight >= {REJECT_AT} THEN 'block' ELSE 'allow' END"
    return f"""WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{HOST_PATH}', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(coalesce(url, ''), '{HOST_PATH}', 2) AS path, translate(coalesce(url, ''), '{UPPER}', '{LOWER}') AS lowered FROM pages),
h AS (SELECT page_id, host, path, list_filter({listed}, lambda t: regexp_matches(lowered, '(^|[^a-z0-9])' || t.t || '($|[^a-z0-9])')) AS hits FROM u),
c AS (SELECT page_id, host, path, CAST(len(list_filter(hits, lambda t: t.w >= {REJECT_AT})) AS BIGINT) AS n_strict, CAST(len(list_filter(hits, lambda t: t.w < {REJECT_AT})) AS BIGINT) AS n_soft, CAST(coalesce(list_sum(list_transform(hits, lambda t: t.w)), 0) AS BIGINT) AS weight FROM h)
SELECT page_id, host, path, {name} AS rule, {verdict} AS verdict, n_strict, n_soft, weight FROM c"""
