"""Exact dedup by content sort, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from axisforge.llm.common import partitions, table, without, written

#: Ranges for each shuffle partition; several, so that hashing their numbers evens them out.
RANGES = 4
#: Sampled keys for each range; keys are at most 250 bytes, so that the sample is bounded by the number of partitions.
SAMPLED = 16
#: Characters of the text that a range key starts with.
HEAD = 24


def normalised(text: Column) -> Column:
    """Each run of white space as one space; single spaces, which are most of them, needn't be replaced."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def _ranges(rows: DataFrame, doc_id: Column, text: Column) -> tuple[DataFrame, Column]:
    """rows with text_sha256, _af_id, _af_key (of the text) and _af_range; and whether a row's text lies at a splitter.

    Splitters are sampled keys (start of the text, digest, id) in a total order of (text, id)
    in which equal texts are neighbours. Only texts at a splitter lie in several ranges.
    """
    ranges = RANGES * partitions(rows.sparkSession)

    def keyed(rows: DataFrame) -> DataFrame:
        norm = normalised(text)
        rows = rows.withColumn("text_sha256", F.sha2(norm, 256)).withColumn("_af_id", doc_id)
        text_key = F.concat_ws(".", F.hex(F.substring(norm, 1, HEAD).cast("binary")), "text_sha256")
        id_key = F.coalesce(F.lpad(F.hex(F.xxhash64("_af_id")), 16, "0"), F.lit("~"))
        return rows.withColumn("_af_key", text_key).withColumn("_af_at", F.concat_ws(".", "_af_key", id_key))

    share = SAMPLED * ranges / max(1, rows.count())
    keys = sorted(keyed(rows.sample(share, seed=7) if share < 1 else rows).select("_af_at", "_af_key").collect())  # about SAMPLED * ranges
    rows = keyed(rows)
    splitters = sorted({tuple(keys[i * len(keys) // ranges]) for i in range(1, ranges)}) if keys else []
    # One constant for the plan, in sorted order; keys have no commas.
    at = F.split(F.lit(",".join(k for k, _ in splitters)), ",")
    edges = F.split(F.lit(",".join(sorted({k for _, k in splitters}))), ",")
    n = len(splitters)
    steps = [1 << k for k in reversed(range(max(n, 1).bit_length()))]
    search = lambda lo, step: F.when((lo + step <= n) & (F.get(at, lo + step - 1) <= F.col("_af_at")), lo + step).otherwise(lo)
    rows = rows.withColumn("_af_range", F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), search) if n else F.lit(0))
    return rows.drop("_af_at"), F.array_contains(edges, F.col("_af_key"))


def content_sort(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Rows of docs (the columns `carry`, by default all) with keep_id, group_size, kept and text_sha256.

    Texts are equal when the bytes of their normalised forms are. Rows are range-partitioned
    by the start of the text, its digest and the id, between splitters from a sample; sorted
    by the whole text within each range, where equal texts are neighbours that the window
    compares in full; and the row with the smallest id stays. As the id is part of the range
    key, a text of which there are very many copies spreads over several ranges; only the
    texts at a splitter can, so what joins their parts has one row for each range at most.

    Null texts count as empty. A null id comes last: it stays only if all copies have null.
    Of repeated rows one is kept. Empty tables give empty results. Columns with the names
    of the results are replaced.
    """
    added = ["keep_id", "group_size", "kept", "text_sha256"]
    names = without(docs, *added).columns if carry is None else carry
    cols = [F.col(f"`{c}`") for c in names]
    rows, edge = _ranges(docs.select(*cols, F.col(f"`{doc_id}`").alias("_af_own"), F.col(f"`{text}`").alias("_af_raw")), F.col("_af_own"), F.col("_af_raw"))
    raw = F.col(f"`{text}`") if text in names else F.col("_af_raw")  # a text isn't moved twice
    placed = (rows.drop("_af_raw") if text in names else rows).repartition("_af_range").withColumn("_af_text", normalised(raw))
    group = Window.partitionBy("_af_range", "_af_text").orderBy(F.col("_af_id").asc_nulls_last())
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sorted_ = placed.select(
        *cols, "_af_id", "_af_key", "_af_range", "text_sha256",
        F.row_number().over(group).alias("_af_nth"), F.first("_af_id").over(whole).alias("_af_first"), F.count(F.lit(1)).over(whole).alias("_af_n"),
        edge.alias("_af_edge"),
    )
    sorted_ = written(sorted_, "content-sort")
    parts = sorted_.where("_af_edge and _af_nth = 1").select(F.col("_af_key").alias("_af_k"), "_af_range", "_af_first", "_af_n")
    first = F.min_by("_af_first", F.struct(F.col("_af_first").isNull(), "_af_first"))
    joined = parts.groupBy("_af_k").agg(first.alias("_af_low"), F.sum("_af_n").alias("_af_all"), F.min_by("_af_range", F.struct(F.col("_af_first").isNull(), "_af_first", "_af_range")).alias("_af_home"))
    out = sorted_.join(F.broadcast(joined), (F.col("_af_key") == F.col("_af_k")) & F.col("_af_edge"), "left")
    split = F.col("_af_k").isNotNull()
    return out.select(
        *cols,
        F.when(split, F.col("_af_low")).otherwise(F.col("_af_first")).alias("keep_id"),
        F.when(split, F.col("_af_all")).otherwise(F.col("_af_n")).alias("group_size"),
        ((F.col("_af_nth") == 1) & (~split | (F.col("_af_range") == F.col("_af_home")))).alias("kept"),
        "text_sha256",
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """docs less the later copies of equal texts; columns as they were.

    As content_sort, but only the rows that stay come out: a sorted aggregate compares each
    text with the one before and holds one row at a time, whatever the number of copies.
    Nulls, empty texts, ties and repeated rows as there; of rows with one id and equal texts
    the one of the least hash stays.
    """
    cols = [F.col(f"`{c}`") for c in docs.columns]
    own = docs.select(*[c.alias(f"_af_own{i}") for i, c in enumerate(cols)])
    at = {c: f"_af_own{i}" for i, c in enumerate(docs.columns)}
    text = F.col(at["text"])
    rows, edge = _ranges(own, F.col(at["doc_id"]), text)
    first = F.struct(F.col("_af_id").isNull(), F.col("_af_id"), F.xxhash64(*own.columns))
    rows = rows.withColumn("_af_first", first)
    # A text at a splitter keeps the row of the range that has its smallest id: a row for each splitter at most.
    homes = rows.where(edge).groupBy("_af_key").agg(F.min_by("_af_range", F.struct("_af_first", "_af_range"))).collect()
    homes = docs.sparkSession.createDataFrame([tuple(r) for r in homes], "_af_k string, _af_home int")
    sorted_ = rows.select(*own.columns, "_af_first", "_af_key", "_af_range").repartition("_af_range")
    kept = sorted_.groupBy("_af_range", normalised(text).alias("_af_text")).agg(F.min_by(F.struct(*own.columns, "_af_key"), "_af_first").alias("_af_row"))
    kept = kept.select("_af_range", "_af_row.*").join(F.broadcast(homes), F.col("_af_key") == F.col("_af_k"), "left")
    return kept.where("_af_home is null or _af_home = _af_range").select(*[F.col(a).alias(c) for c, a in at.items()])


def op8_content_sort_dedup(spark, sf_dir):
    return content_sort(table(spark, sf_dir, "documents"), carry=["doc_id"])


OP8_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(COALESCE(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, MIN(doc_id) OVER (PARTITION BY t) AS keep_id, COUNT(*) OVER (PARTITION BY t) AS group_size,
    ROW_NUMBER() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256 FROM n
"""
