"""Shared helpers: hash shares, connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rows import fresh, heavy_keys, spread_join
from ..sources.scratch import materialize

__all__ = ["connected_components", "fresh", "hash_share", "heavy_keys", "keeps", "materialize", "shuffle_partitions", "spread_join", "trimmed"]


_malloc_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
#: What frees the tables that a Python worker keeps for its next tasks, by the operator that they are of.
_free: dict[str, Callable[[], None]] = {}


def keeps(operator: str, free: Callable[[], None]) -> None:
    """Say how to free what workers keep for tasks of an operator."""
    _free[operator] = free


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    if _malloc_trim is not None:
        _malloc_trim(0)


def trimmed(batches: Iterator, operator: str = "") -> Iterator:
    """The batches of a task of the operator. Workers live on for other tasks: what they keep for other operators is freed
    first, and between batches and at the end what is free goes back to the system."""
    for other, free in _free.items():
        if other != operator:
            free()
    _give_back()
    for batch in batches:
        yield batch
        del batch
        _give_back()


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def hash_share(key: Column, seed: int) -> Column:
    """A number in [0, 1) that only depends on the key."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Components of an undirected graph by alternating large-star and small-star steps.

    edges: columns a, b (any orderable type, nulls and loops are ignored). Returns node, root: root is the smallest
    node of the component; every node of an edge appears once. Each step only joins and takes minima by key, so a hub
    never has its neighbours gathered, and the edges of a heavy one are dealt to several tasks; each round is cut by a
    table in the shared folder. It ends when all but the smallest node of each component have one neighbour.
    """
    now = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = materialize(now)
    for _ in range(rounds):
        both = now.union(now.select("b", "a"))
        low = materialize(both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("weight")).select("a", F.least("a", "m").alias("m"), "weight"))
        every, most, tangled = low.agg(F.sum("weight"), F.max("weight"), F.max(F.when(F.col("m") < F.col("a"), F.col("weight")))).first()
        if (tangled or 0) <= 1:
            return low.select(F.col("a").alias("node"), F.col("m").alias("root"))
        hubs = heavy_keys(low, "a", "weight", known=(every, most))  # in the small-star step no node has more neighbours
        large = spread_join(both.where("b > a"), low.drop("weight"), "a", hubs).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        joined = spread_join(large, floor := large.groupBy("a").agg(F.min("b").alias("m")), "a", hubs)
        small = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(floor.select("a", F.col("m").alias("b")))
        now = materialize(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    raise RuntimeError(f"components did not settle in {rounds} rounds")
