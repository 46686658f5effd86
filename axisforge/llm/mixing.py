"""Mixing sources to target weights by capped water-filling and seeded repetitions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from axisforge.llm.common import global_rank, table, without, written

#: One word: a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Hexadecimal digits of the seeded hash that choose a document's bin: a source has 16**BIN bins, of which one is cut.
BIN = 3


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_level(sources: DataFrame, budget: float, epochs: float) -> float:
    """The level at which the targets min(epochs * source_size, weight * level) sum to the budget; infinite if none can.

    Each round clamps the sources above their caps and shares what is left by weight among
    the others, until none is above. Rounds are aggregates: sources never come to the driver.
    """
    cap, level, clamped = F.col("source_size") * F.lit(float(epochs)), 0.0, -1
    while True:
        full = cap <= F.col("weight") * F.lit(level) if clamped >= 0 else F.lit(False)
        caps, weights, n = sources.agg(F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight").cast("double"))), F.count_if(full)).first()
        if not weights:
            return math.inf if n else 0.0
        if n == clamped:
            return level
        level, clamped = (budget - caps) / weights, n


def water_fill_mix(docs: DataFrame, weights: DataFrame, share: float, epochs: float, seed: int, size: Column, key: Column, source: str = "source") -> DataFrame:
    """The columns of docs with size, source_size, target, whole, extra and taken.

    weights: rows (source, weight > 0). Together the targets are `share` times all sizes;
    none is above `epochs` times its source's size, and the excess is shared by weight. Of a
    target of e sizes, each document is taken floor(e) times whole, and further documents
    once more (extra), in the order of md5(seed:key), up to the number of words that lies
    nearest to the rest. taken = (whole + extra) * size. A document of size 0 adds nothing to
    any target and is taken once, or never if its source's target is 0.

    A source's sums are partial aggregates by bins of the hash; only the one bin in which
    the rest ends is sorted, so that a source may hold any share of the rows. Documents meet
    a plan of one row for each source. Null sources
    are a source of their own; one without a weight gets the target 0. Null sizes count as
    0. Rows of one hash go by size and then by a hash of all columns, so that reruns agree;
    columns with the names of the results are replaced.
    """
    added = ["size", "source_size", "target", "whole", "extra", "taken"]
    names = [c for c in without(docs, *added).columns]
    cols = [F.col(f"`{c}`") for c in names]
    turn = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"))
    base = docs.select(*cols, F.coalesce(size.cast("long"), F.lit(0)).alias("size"), turn.alias("_af_turn")).withColumn("_af_bin", F.substring("_af_turn", 1, BIN))
    if "text" in names:  # texts would be read for each of the passes
        slim = base.drop("text")
    else:
        slim = base = written(base, "mix-rows")
    bins = written(slim.groupBy(F.col(f"`{source}`").alias("_af_s"), "_af_bin").agg(F.sum("size").alias("_af_sum")), "mix-bins")
    sizes = bins.groupBy("_af_s").agg(F.sum("_af_sum").alias("source_size"))
    w = weights.select(F.col("source").alias("_af_w"), "weight")
    sources = written(sizes.join(w, sizes._af_s.eqNullSafe(w._af_w), "left").select("_af_s", "source_size", F.coalesce("weight", F.lit(0)).alias("weight")), "mix-sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = water_level(sources.where("weight > 0"), share * total, epochs)
    cap = F.col("source_size") * F.lit(float(epochs))
    target = F.when(F.col("weight") <= 0, 0.0).otherwise(cap if math.isinf(level) else F.least(cap, F.col("weight") * F.lit(level)))
    plan = sources.withColumn("target", target).withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))).otherwise(0).cast("long"))
    plan = plan.withColumn("_af_rest", F.col("target") - F.col("whole") * F.col("source_size")).drop("weight")
    by_bin = Window.partitionBy("_af_s").orderBy("_af_bin").rowsBetween(Window.unboundedPreceding, -1)
    start = bins.withColumn("_af_from", F.coalesce(F.sum("_af_sum").over(by_bin), F.lit(0)))
    p = plan.withColumnRenamed("_af_s", "_af_p")
    start = start.join(p, start._af_s.eqNullSafe(p._af_p)).drop("_af_p")
    # Bins up to `last` lie wholly within the rest; the rest ends in the bin `cut`, if it ends in one at all.
    within = F.col("_af_from") + F.col("_af_sum") <= F.col("_af_rest")
    ends = ~within & (F.col("_af_from") < F.col("_af_rest"))
    cuts = F.max(F.when(within, F.col("_af_bin"))).alias("_af_last"), F.max(F.when(ends, F.col("_af_bin"))).alias("_af_cut"), F.max(F.when(ends, F.col("_af_from"))).alias("_af_from")
    plan = written(start.groupBy("_af_s", "source_size", "target", "whole", "_af_rest").agg(*cuts), "mix-plan")
    got = base.join(plan, F.col(f"`{source}`").eqNullSafe(F.col("_af_s")))
    in_cut = F.coalesce(F.col("_af_bin") == F.col("_af_cut"), F.lit(False))
    sure = got.where(~in_cut).withColumn("extra", F.coalesce((F.col("_af_bin") <= F.col("_af_last")).cast("long"), F.lit(0)))
    upto = Window.partitionBy("_af_s").orderBy("_af_turn", "size", F.xxhash64(*cols)).rowsBetween(Window.unboundedPreceding, 0)
    cut = got.where(in_cut).withColumn("_af_upto", F.col("_af_from") + F.sum("size").over(upto))
    cut = cut.withColumn("extra", (F.col("_af_upto") - F.col("size") / 2.0 <= F.col("_af_rest")).cast("long")).drop("_af_upto")
    out = sure.unionByName(cut)
    none = F.col("size") == 0
    out = out.withColumn("extra", F.when(none, 0).otherwise(F.col("extra"))).withColumn("whole", F.when(none, (F.col("target") > 0).cast("long")).otherwise(F.col("whole")))
    return out.select(*cols, "size", "source_size", "target", "whole", "extra", ((F.col("whole") + F.col("extra")) * F.col("size")).alias("taken"))


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mixed corpus: each document as many times as it was taken, with its copy number in `copy`."""
    return mixed.where("whole + extra > 0").select(*columns, F.explode(F.sequence(F.lit(1), F.col("whole") + F.col("extra"))).alias("copy"))


def cyclic_weights(docs: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """(source, weight): sources by code point, null last, get the weights in turn. One row a source, not a document."""
    ranked = global_rank(docs.select("source").distinct(), [F.col("source").asc_nulls_last()], "_af_nth")
    nth = F.pmod("_af_nth", F.lit(len(weights))).cast("int") + 1
    return ranked.select("source", F.element_at(F.array(*map(F.lit, weights)), nth).alias("weight"))


def op3_water_fill_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = written(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "mix-sizes")
    out = water_fill_mix(rows, cyclic_weights(rows, (3, 1, 2)), share=1.5, epochs=2.0, seed=17, size=F.col("size"), key=F.col("doc_id"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


OP3_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5('17:' || COALESCE(CAST(doc_id AS VARCHAR), 'null')) AS turn FROM documents),
s AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size, CAST(SUM(size) AS DOUBLE) * 2 AS cap,
    CAST([3, 1, 2][1 + (ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS w FROM d GROUP BY source),
l AS (SELECT 0 AS k, (SELECT 1.5::DOUBLE * SUM(source_size)::DOUBLE / SUM(w) FROM s) AS level
    UNION ALL SELECT k + 1, (SELECT (1.5::DOUBLE * SUM(source_size)::DOUBLE - SUM(CASE WHEN cap <= w * level THEN cap ELSE 0 END)) / SUM(CASE WHEN cap <= w * level THEN 0 ELSE w END) FROM s) FROM l WHERE k < 60),
p AS (SELECT source, source_size, LEAST(cap, w * (SELECT level FROM l WHERE k = 60)) AS target FROM s),
q AS (SELECT *, CAST(CASE WHEN source_size > 0 THEN FLOOR(target / source_size) ELSE 0 END AS BIGINT) AS whole FROM p),
c AS (SELECT d.doc_id, d.size, q.source_size, q.target, q.whole, q.target - q.whole * q.source_size AS rest,
    SUM(d.size) OVER (PARTITION BY d.source ORDER BY d.turn, d.size ROWS UNBOUNDED PRECEDING) AS upto FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target, CAST((whole + CASE WHEN upto - size / 2 <= rest THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM c
"""
