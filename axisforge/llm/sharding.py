"""Sharding by longest-processing-time scheduling of groups that must stay together."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from axisforge.llm.common import discard, ranked, without, written

#: Groups of 1/BIG of a shard's share or more are broadcast when rows meet them, as one may hold most rows: shards * BIG at most.
BIG = 1024
#: A plan of up to this many sizes is broadcast.
BROADCAST_SIZES = 200_000


class LeastLoaded:
    """A heap of shards by load; equal loads go by number."""

    def __init__(self, shards: int):
        self.heap = [(0, s) for s in range(shards)]

    def put(self, size: int) -> int:
        load, shard = self.heap[0]
        heapq.heapreplace(self.heap, (load + size, shard))
        return shard

    def put_many(self, size: int, count: int) -> dict[int, int]:
        """The shards of `count` items of one size, as count calls of put() would choose them, without as many steps."""
        got: dict[int, int] = {}
        if count > 4 * len(self.heap):
            loads = sorted(self.heap)
            total = level = 0
            for k, (load, _) in enumerate(loads, 1):
                total += load
                level = (total + size * count) // k
                if k == len(loads) or level <= loads[k][0]:
                    break
            for k, (load, shard) in enumerate(loads):
                if (n := max(0, min(count, (level - load) // size - 1))) > 0:
                    got[shard] = n
                    loads[k] = (load + n * size, shard)
                    count -= n
            self.heap = loads
            heapq.heapify(self.heap)
        for _ in range(count):
            shard = self.put(size)
            got[shard] = got.get(shard, 0) + 1
        return got


def lpt_shards(rows: DataFrame, shards: int, group: Column, size: Column, order: list[Column]) -> DataFrame:
    """All rows and columns of `rows`, with `shard` (0 to shards - 1) and `slot` (gapless from 0 in each shard).

    Rows of equal `group` stay together; the groups, by falling total size, go to the
    least-loaded shard through a heap. `size` is a positive long. Groups of one size go by a
    hash of the group: the heap says how many of them each shard gets, and their ranks which.
    So only the number of groups of each size reaches the driver: of T in all, there can be
    sqrt(2 T) different sizes at most.

    Null groups are one group. Null sizes count as 1. Repeated rows each keep a slot. An
    empty table gives an empty result. Columns named shard or slot are replaced.
    """
    spark = rows.sparkSession
    names = without(rows, "shard", "slot").columns
    cols = [F.col(f"`{n}`") for n in names]
    group_key = F.coalesce(F.md5(group.cast("string").cast("binary")), F.lit(""))
    turn = F.md5(F.concat_ws(",", *[o.cast("string") for o in order]).cast("binary"))
    base = written(
        rows.select(*cols, group_key.alias("_af_group"), F.coalesce(size.cast("long"), F.lit(1)).alias("_af_size"), F.struct(F.substring(turn, 1, 3).alias("_turn"), *order).alias("_af_order")),
        "shard-rows",
    )
    groups = written(base.groupBy("_af_group").agg(F.sum("_af_size").alias("_af_bytes")), "shard-groups")
    sizes = groups.groupBy("_af_bytes").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("_af_bytes")).toArrow()
    heap, plan, total = LeastLoaded(shards), ([], [], []), 0
    for size_, n in zip(sizes.column(0).to_pylist(), sizes.column(1).to_pylist(), strict=True):
        got = sorted(heap.put_many(size_, n).items())
        total += size_ * n
        for column, value in zip(plan, (size_, np.cumsum([k for _, k in got]).tolist(), [s for s, _ in got]), strict=True):
            column.append(value)
    fields = zip(("_af_bytes", "_af_ends", "_af_to"), plan, (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())), strict=True)
    plan = spark.createDataFrame(pa.table({name: pa.array(values, kind) for name, values, kind in fields}))
    in_size = ranked(groups, ["_af_bytes"], F.substring("_af_group", 1, 3), [F.col("_af_group")], "_af_rank")
    dealt = in_size.join(F.broadcast(plan) if len(sizes) <= BROADCAST_SIZES else plan, "_af_bytes")
    dealt = written(dealt.select("_af_group", "_af_bytes", F.expr("_af_to[size(filter(_af_ends, e -> e <= _af_rank))]").alias("shard")), "shard-dealt")
    large = total // (shards * BIG) + 1
    # Two joins, not one with a union: the few large groups may hold most rows, and their shards are broadcast.
    by_hand = dealt.where(F.col("_af_bytes") >= large).select("_af_group", F.col("shard").alias("_af_by_hand"))
    found = base.join(F.broadcast(by_hand), "_af_group", "left")
    whole = found.where("_af_by_hand is not null").withColumnRenamed("_af_by_hand", "shard")
    rest = found.where("_af_by_hand is null").drop("_af_by_hand").join(dealt.where(F.col("_af_bytes") < large).select("_af_group", "shard"), "_af_group")
    out = written(whole.unionByName(rest).drop("_af_group", "_af_size"), "shard-placed")
    discard(base, groups, dealt)
    out = ranked(out, ["shard"], F.col("_af_order._turn"), [F.col("_af_order")], "slot")
    return out.select(*cols, "shard", "slot")


def write_shards(docs: DataFrame, placed: DataFrame, key: str, path: str) -> None:
    """Writes docs as one Parquet folder for each shard, given the rows of lpt_shards that carry `key` (one row for each document)."""
    docs.join(placed.select(key, "shard"), key).write.partitionBy("shard").parquet(path)


def op1_lpt_shards(spark, sf_dir):
    from axisforge.llm.common import table

    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.sha2(text, 256).alias("digest"))
    out = lpt_shards(rows, 16, F.col("digest"), F.col("size"), [F.col("doc_id"), F.col("text_crc32")])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


OP1_SQL = r"""
WITH RECURSIVE tab AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS crc FROM range(256) r(i)),
b AS (SELECT doc_id, octet_length(encode(COALESCE(text, ''))) + 1 AS size, md5(sha256(COALESCE(text, ''))) AS digest,
    list_transform(regexp_extract_all(hex(encode(COALESCE(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS bytes FROM documents),
d AS (SELECT doc_id, CAST(size AS BIGINT) AS size, digest, CAST(xor(list_reduce(bytes, lambda c, x: xor(c >> 8, tab.crc[1 + (xor(c, x) & 255)]), 4294967295), 4294967295) AS BIGINT) AS text_crc32 FROM b, tab),
g AS (SELECT digest, CAST(SUM(size) AS BIGINT) AS bytes FROM d GROUP BY digest),
o AS (SELECT bytes, ROW_NUMBER() OVER (ORDER BY bytes DESC) AS n FROM g),
lpt(n, bytes, shard, loads) AS (SELECT 0::BIGINT, 0::BIGINT, 0::BIGINT, list_transform(range(16), lambda i: 0::BIGINT)
    UNION ALL SELECT o.n, o.bytes, list_position(loads, list_min(loads)) - 1,
        list_transform(range(16), lambda i: loads[i + 1] + CASE WHEN i + 1 = list_position(loads, list_min(loads)) THEN o.bytes ELSE 0 END)
        FROM lpt JOIN o ON o.n = lpt.n + 1),
places AS (SELECT bytes, shard, ROW_NUMBER() OVER (PARTITION BY bytes ORDER BY shard) AS nth FROM lpt WHERE n > 0),
named AS (SELECT digest, bytes, ROW_NUMBER() OVER (PARTITION BY bytes ORDER BY digest) AS nth FROM g),
placed AS (SELECT digest, CAST(shard AS INTEGER) AS shard FROM named JOIN places USING (bytes, nth))
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, ROW_NUMBER() OVER (PARTITION BY shard
    ORDER BY substr(md5(concat_ws(',', doc_id, text_crc32)), 1, 3), doc_id NULLS FIRST, text_crc32) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM d JOIN placed USING (digest)
"""
