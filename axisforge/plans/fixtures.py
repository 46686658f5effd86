"""The test tables as events with jets, slices, files and datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from axisforge.operators.weights import with_weight

#: Cross sections of the slices.
CROSS_SECTIONS = {"1-URGENT": 2.4, "2-HIGH": 1.6, "3-MEDIUM": 1.0, "4-NOT SPECIFIED": 0.8, "5-LOW": 0.3}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ev, jets): an event for each order, a jet for each line item, by falling price."""
    li = table(spark, sf_dir, "lineitem")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    part, supp = F.col("l_partkey").cast("long"), F.col("l_suppkey").cast("long")
    share = lambda a, b, c, m: F.pmod(part * a + supp * b + cents * c, F.lit(m)).cast("double") / float(m)
    jet = F.struct(
        (-F.col("l_extendedprice")).alias("a"), part.alias("b"), supp.alias("c"), F.col("l_linenumber").alias("d"),
        (F.col("l_extendedprice") / 1000.0).alias("pt"), (share(15485863, 6700417, 127, 1000033) * 5.0 - 2.5).alias("eta"),
        (share(7919, 104729, 31, 1000003) * 2.0 * F.pi() - F.pi()).alias("phi"), (F.col("l_quantity") / 5.0).alias("m"),
    )
    rows = li.groupBy(F.col("l_orderkey").cast("long").alias("ev")).agg(F.array_sort(F.collect_list(jet)).alias("j"))
    return rows.select("ev", F.transform("j", lambda x: F.struct(x.pt.alias("pt"), x.eta.alias("eta"), x.phi.alias("phi"), x.m.alias("m"))).alias("jets"))


def jets(events: DataFrame) -> DataFrame:
    """(ev, j, pt, eta, phi, m), j from 1."""
    return events.select("ev", F.posexplode("jets").alias("i", "x")).select("ev", (F.col("i") + 1).cast("long").alias("j"), "x.*")


def slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dataset, n_original, xs_pb, xs_weight) of the slices, at a luminosity of a fifth of all orders."""
    orders = table(spark, sf_dir, "orders")
    counts = orders.groupBy(F.col("o_orderpriority").alias("dataset")).agg(F.count(F.lit(1)).alias("n_original"))
    counts = counts.crossJoin(F.broadcast(counts.agg((F.sum("n_original") / 5.0).alias("lumi"))))
    xs = spark.createDataFrame(list(CROSS_SECTIONS.items()), "dataset string, xs_pb double")
    return with_weight(counts, xs, F.col("lumi"))


def weighted(events: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with w, the weight of their slice."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("long").alias("ev"), F.col("o_orderpriority").alias("dataset"))
    return events.join(orders, "ev").join(F.broadcast(slices(spark, sf_dir).select("dataset", "xs_weight")), "dataset").withColumnRenamed("xs_weight", "w").drop("dataset")


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("root://host//store/slim/"), F.col("c_mktsegment"), F.lit("/"), F.col("c_name"), F.lit(".root"))
    return table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("slice"), path.alias("path"), F.lit("events").alias("tree"))
