"""What the operators of this subpackage share: tables, written intermediate results, ranks, components."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from axisforge.sources.scratch import discard, written

ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Lets Python workers on this machine import the package (on a cluster it is installed or sent with --py-files)."""
    env = spark.sparkContext.environment
    have = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in have:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *have])


def partitions(spark: SparkSession, size: int = 0, each: int = 1) -> int:
    """Shuffle partitions: as many as the session asks for, and no fewer than it takes for `size` at `each`."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // each))


def text_bytes(docs: DataFrame, text: str) -> int:
    return docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0


def row_key(doc_id: Column, text: Column) -> Column:
    """What tells rows apart where ids are missing or shared: 64 bits of hash of id and text."""
    return F.xxhash64(doc_id, text)


def without(df: DataFrame, *names: str) -> DataFrame:
    """df less the columns whose names clash (ignoring case) with those an operator adds."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def ranked(df: DataFrame, keys: list[str], bucket: Column, order: list[Column], name: str) -> DataFrame:
    """Adds `name`, a gapless rank from 0 within keys, ordered by (bucket, *order).

    A key may hold any share of the rows: rows are ranked within (keys, bucket), and only
    the counts of the buckets meet per key. df is read twice and must be deterministic.
    """
    b, n, off = "_af_bucket", "_af_n", "_af_off"
    df = df.withColumn(b, bucket)
    before = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy(*keys, b).agg(F.count(F.lit(1)).alias(n))
    offsets = counts.select(*keys, b, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(off))
    inner = Window.partitionBy(*keys, b).orderBy(*order)
    return (
        df.withColumn(name, F.row_number().over(inner) - 1)
        .join(offsets, [*keys, b])
        .withColumn(name, F.col(name).cast("long") + F.col(off))
        .drop(b, off)
    )


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df with `name`, a gapless rank from 0 in `order`: ranges are sorted apart, and only their counts meet."""
    at, part, n, off = "_af_at", "_af_part", "_af_n", "_af_off"
    sorted_ = written(df.orderBy(*order).withColumn(at, F.monotonically_increasing_id()), "ranked")
    sorted_ = sorted_.withColumn(part, F.call_function("shiftright", F.col(at), F.lit(33)))
    counts = sorted_.groupBy(part).agg(F.count(F.lit(1)).alias(n))  # a row for each range
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(part, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(off))
    return sorted_.join(counts, part).withColumn(name, F.col(at).bitwiseAND(F.lit((1 << 33) - 1)) + F.col(off)).drop(at, part, off)


def _contracted(edges: DataFrame, name: str) -> DataFrame:
    """Stars (a, b) with the components of edges (a > b), b the smallest node: large-star and small-star steps by turns."""
    while True:
        many, n = edges.groupBy("a").count().agg(F.count_if(F.col("count") > 1), F.count(F.lit(1))).first()
        if not n or (not many and edges.join(edges.select(F.col("b").alias("n")), F.col("a") == F.col("n"), "left_semi").isEmpty()):
            return edges
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        met = large.join(low, "a")
        small = met.select("a", F.col("m").alias("b")).unionByName(met.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        last, edges = edges, written(small, name)
        discard(last)


#: Edges up to this number are contracted as they are: it takes fewer steps than to set leaves aside.
FEW_EDGES = 1_000_000


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of edges (a, b): rows (node, component), component the smallest node.

    Of many edges, each node first points at its smallest neighbour; its other neighbours are joined to that
    one. What nothing points at is a leaf, which only learns its component at the end. The
    rest, often a small part, is contracted by large-star and small-star steps (Kiveris et
    al., 2014) in about log(n) rounds. Minima are grouped aggregates, so that a node of any
    degree never gathers in one task, and each round's edges are a written table. Loops and
    edges with a null end are left out; nodes without any other edge don't appear.
    """
    edges = edges.select("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(edges.distinct(), name)
    if edges.count() <= FEW_EDGES:
        stars = _contracted(edges, name)
        return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
    tree = written(edges.groupBy("a").agg(F.min("b").alias("m")), name)
    core = written(edges.join(tree, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), name)
    discard(edges)
    hubs = tree.select(F.col("m").alias("n")).unionByName(core.select(F.col("a").alias("n"))).distinct()
    hubs = written(hubs, name)
    graph = written(core.unionByName(tree.join(hubs, tree.a == hubs.n, "left_semi").withColumnRenamed("m", "b")).distinct(), name)
    discard(core)
    stars = _contracted(graph, name).select(F.col("a").alias("_s"), F.col("b").alias("_to"))
    nodes = tree.select(F.col("a").alias("node"), F.col("m").alias("up")).unionByName(hubs.select(F.col("n").alias("node"), F.col("n").alias("up")))
    return nodes.join(stars, F.col("up") == F.col("_s"), "left").select("node", F.coalesce("_to", "up").alias("component")).distinct()
