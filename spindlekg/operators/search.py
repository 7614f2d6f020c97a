"""Keyword search over nodes and neighbourhoods of a given number of hops. nodes: id, label, text and other names;
edges: src, dst, rel_type."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import DEFAULT_COLOUR, LABEL_COLOURS
from ..functions.text import lookup
from ..sources.scratch import materialize, shared_dir

SEARCH_FIELDS = ("text", "name_zh", "name_en", "description_zh")


def search_nodes(nodes: DataFrame, keyword: str, fields: Sequence[str] = SEARCH_FIELDS) -> DataFrame:
    """Nodes of which a field holds the keyword, whatever the case; fields that nodes lack are passed over."""
    hit = F.lit(False)
    for field in fields:
        if field in nodes.columns:
            hit = hit | F.coalesce(F.contains(F.lower(field), F.lit(keyword.lower())), F.lit(False))
    return nodes.where(hit).dropDuplicates(["id"])


#: A frontier of so many nodes at most is sent to every executor, and only the folders of its shards are read.
FEW = 10_000


@dataclass(frozen=True)
class Adjacency:
    """Both directions of edges by node: rows id, next, shard, of which shard is a hash of id and a folder."""

    rows: DataFrame
    shards: int

    def next_to(self, last: DataFrame, n: int) -> DataFrame:
        """The neighbours, as `id`, of a frontier of n nodes; of few nodes, from their shards alone."""
        rows, last = self.rows, last.select("id")
        if n <= FEW:
            held = [r[0] for r in last.select(_shard(self.shards)).distinct().collect()]
            rows, last = rows.where(F.col("shard").isin(held)), F.broadcast(last)
        return rows.join(last, "id").select(F.col("next").alias("id")).distinct()


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard")


def adjacency(edges: DataFrame, path: str | None = None, shards: int | None = None) -> Adjacency:
    """Write the edges' adjacency, each pair once and without loops, for any number of searches. path: a folder that keeps
    it (see read_adjacency), or the scratch folder. A shard that a hub makes large is written by several tasks."""
    spark = edges.sparkSession
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = path or f"{shared_dir(spark)}/spindlekg/near-{uuid.uuid4().hex}"
    way = lambda a, b: edges.select(F.col(a).alias("id"), F.col(b).alias("next"))
    both = way("src", "dst").union(way("dst", "src")).where("id <> next").distinct().select("id", "next", _shard(n))
    both.hint("rebalance", "shard").sortWithinPartitions("shard", "id").write.partitionBy("shard").parquet(f"{path}/shards={n}")
    return read_adjacency(edges, path)


def read_adjacency(edges: DataFrame, path: str) -> Adjacency:
    """What adjacency wrote for the edges under path."""
    kind = dict(edges.dtypes)["src"]
    rows = edges.sparkSession.read.schema(f"id {kind}, next {kind}, shards int, shard int").parquet(path)
    found = rows.select("shards").first()
    return Adjacency(rows.drop("shards"), found[0] if found else 1)


def _reach(seeds: DataFrame, near: Adjacency, hops: int) -> tuple[DataFrame, int]:
    """(id and dist of the nodes within hops, how many they are)."""
    seen = last = materialize(seeds.select("id").where("id is not null").distinct().withColumn("dist", F.lit(0)))
    n = every = last.count()
    for hop in range(1, hops + 1):
        if not n:
            break
        last = materialize(near.next_to(last, n).join(seen, "id", "left_anti").withColumn("dist", F.lit(hop)))
        n = last.count()
        every, seen = every + n, seen.union(last)
    return seen, every


def distances(edges: DataFrame, seeds: DataFrame, hops: int, near: Adjacency | None = None) -> DataFrame:
    """id, dist: how many edges, of either direction, each node within `hops` is from the nearest seed.

    Breadth first: each round only joins the nodes found last, to the adjacency table, and cuts the lineage with a table.
    near: what adjacency made of the edges, where it is at hand.
    """
    return _reach(seeds, adjacency(edges) if near is None else near, hops)[0]


def expand_khop(nodes: DataFrame, edges: DataFrame, seeds: DataFrame, hops: int, near: Adjacency | None = None) -> tuple[DataFrame, DataFrame]:
    """(nodes within hops, with `dist`; edges on the way: those with an end within hops - 1)."""
    reach, n = _reach(seeds, adjacency(edges) if near is None else near, hops)
    few = F.broadcast if n <= FEW else lambda df: df
    inner = reach.where(F.col("dist") < hops).select("id")
    at = [edges.join(few(inner.withColumnRenamed("id", end)), end, "left_semi").select(*edges.columns) for end in ("src", "dst")]
    touched = at[0].union(at[1])
    return nodes.join(few(reach), "id"), touched.dropDuplicates(["src", "dst", "rel_type"])


def extract_subgraph(nodes: DataFrame, edges: DataFrame, seeds: DataFrame, hops: int, near: Adjacency | None = None) -> tuple[DataFrame, DataFrame]:
    """Different nodes and edges of the neighbourhood; edges with an end outside are dropped."""
    within, between = expand_khop(nodes, edges, seeds, hops, near)
    within = within.dropDuplicates(["id"])
    ids = within.select("id")
    for end in ("src", "dst"):
        between = between.join(ids.withColumnRenamed("id", end), end, "left_semi")
    return within, between.select(*edges.columns)


def cut(text: Column, size: int) -> Column:
    return F.when(F.length(text) > size, F.concat(F.substring(text, 1, size), F.lit("..."))).otherwise(text)


def display_table(nodes: DataFrame, colours: dict[str, str] | None = None) -> DataFrame:
    """id, caption, main_label, colour, and shown_props if nodes have props.

    nodes: id, labels (an array) or label, text, name_zh if present.
    """
    names = [F.nullif(c, F.lit("")) for c in ("name_zh", "text") if c in nodes.columns]
    caption = cut(F.replace(F.coalesce(*names, F.col("id").cast("string")), F.lit("\n"), F.lit(" ")), 50)
    labels = F.col("labels") if "labels" in nodes.columns else F.array("label")
    main = F.coalesce(F.get(F.filter(labels, lambda x: x != "Entity"), 0), F.get(labels, 0))
    known = LABEL_COLOURS if colours is None else colours
    colour = F.when(main.isin(*known), lookup(known, main)).otherwise(DEFAULT_COLOUR)
    nested = lambda v: v.rlike(r"^\s*[\[{]")
    props = [F.transform_values("props", lambda k, v: F.when(nested(v), cut(v, 500)).otherwise(cut(v, 100))).alias("shown_props")] if "props" in nodes.columns else []
    return nodes.select("id", caption.alias("caption"), main.alias("main_label"), colour.alias("colour"), *props)
