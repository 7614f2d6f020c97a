"""Helpers on whole rows: names that clash with none, first rows of keys, joins that split heavy keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores behind those that df has (in any case), so that no column of its own is lost."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def quoted(*names: str) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key, by an aggregation that combines before it shuffles, so a hot key costs little. Without
    keys, the first row of all."""
    rest = [c for c in df.columns if c not in keys]
    (row,) = fresh(df, "__row")
    found = df.groupBy(*quoted(*keys)).agg(F.min_by(F.struct(*quoted(*rest)), F.struct(*order)).alias(row))
    return found.select(*[F.col(f"`{c}`") if c in keys else F.col(f"{row}.`{c}`").alias(c) for c in df.columns])


def heavy_keys(few: DataFrame, key: str, weight: str, shares: int = 256, least: int = 1_000, known: tuple[int, int] | None = None) -> DataFrame | None:
    """key and parts of the keys that have over 1/shares of all rows (and over `least`), or None if none has. few: a
    table with a row per key, and how many rows have it. Fewer than `shares` keys can be heavy. known: the sum and the
    largest of the weights, where they are known."""
    every, most = known or few.agg(F.sum(weight), F.max(weight)).first()
    bound = max(least, (every or 0) / shares)
    return few.where(F.col(weight) > bound).select(key, F.ceil(F.col(weight) / bound).cast("int").alias("parts")) if (most or 0) > bound else None


def spread_join(many: DataFrame, few: DataFrame, key: str, heavy: DataFrame | None, how: str = "inner") -> DataFrame:
    """many joined (inner or left) to few, which has one row per key. Rows of a heavy key are dealt to several tasks, by a
    hash of their other columns, and that key's row of few goes to each. The heavy keys are few (see heavy_keys), so
    they are sent to every executor."""
    if heavy is None:
        return many.join(few, key, how)
    part, parts = fresh(many.join(few.limit(0), key), "__part", "__parts")
    heavy = heavy.select(key, F.col("parts").alias(parts))
    others = quoted(*[c for c, kind in many.dtypes if c != key and "map<" not in kind and kind != "void"])
    place = F.coalesce(F.pmod(F.xxhash64(*others), F.col(parts)).cast("int"), F.lit(0)) if others else F.lit(0)
    dealt = many.join(F.broadcast(heavy), key, "left").withColumn(part, place).drop(parts)
    sent = few.join(F.broadcast(heavy), key, "left").withColumn(part, F.explode(F.sequence(F.lit(0), F.coalesce(parts, F.lit(1)) - 1))).drop(parts)
    return dealt.join(sent, [key, part], how).drop(part)


#: How many numbers of a sequence make a stretch, where nothing in the data does.
STRETCH = 4096


def place_of(keys: Sequence[str], stretch: str) -> Column:
    """Where running_sum sorts a row: its keys and stretch, as a struct, which is never null, so that joins keep null keys."""
    return F.struct(*quoted(*keys, stretch))


def running_sum(df: DataFrame, keys: Sequence[str], stretch: str, order: Sequence[str], value: Column, name: str, place: str | None = None) -> DataFrame:
    """df with `name`: the sum of value over the rows of the keys so far, in the order of stretch and then of `order`.

    Sums run within each stretch, and what stretches add up to runs over them, so rows of one key are sorted in as many
    tasks as it has stretches, and only a row per stretch meets in one. Null keys are keys like others. place: a column of
    df that has place_of them, and stays, so that several steps share one shuffle."""
    own, before = fresh(df, "__place", "__before")
    at = place or own
    inner = Window.partitionBy(at).orderBy(*order)
    placed = df if place else df.withColumn(at, place_of(keys, stretch))
    within = placed.withColumn(name, F.sum(value).over(inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    ends = within.groupBy(at).agg(F.sum(value).alias(before))
    earlier = Window.partitionBy(*[F.col(f"{at}.`{k}`") for k in keys]).orderBy(F.col(f"{at}.`{stretch}`"))
    offsets = ends.select(at, F.coalesce(F.sum(before).over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(before))
    found = within.join(offsets, at).withColumn(name, F.col(name) + F.col(before)).drop(before)
    return found if place else found.drop(at)


def before(df: DataFrame, keys: Sequence[str], stretch: str, order: Sequence[str], value: Column, name: str) -> DataFrame:
    """df with `name`: the value of the row before in the order of stretch and then of `order`, null at a key's first row.
    The first row of a stretch gets it from the last of the stretch before; see running_sum."""
    place, last = fresh(df, "__place", "__last")
    inner = Window.partitionBy(place).orderBy(*order)
    within = df.withColumn(place, F.struct(*quoted(*keys, stretch))).withColumn(name, F.lag(F.struct(value.alias("v"))).over(inner))
    ends = within.groupBy(place).agg(F.max_by(F.struct(value.alias("v")), F.struct(*order)).alias(last))
    earlier = Window.partitionBy(*[F.col(f"{place}.`{k}`") for k in keys]).orderBy(F.col(f"{place}.`{stretch}`"))
    carried = ends.select(place, F.lag(last).over(earlier).alias(last))
    return within.join(carried, place).withColumn(name, F.coalesce(name, last)["v"]).drop(place, last)
