"""A quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is a table of n-gram probabilities, dealt out in shards. Each document's n-grams are counted,
the counts are dealt out to the same shards, and joins of the two give each document's perplexity. Neither
the model nor the documents' counts ever meet in one place.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from axisforge.llm.blobs import in_chunks, lean_memory, pack, runs, starts, steps, unpack
from axisforge.llm.common import discard, row_key, table, text_bytes, without, written

#: Bytes of the longest n-gram.
ORDER = 5
#: One in so many trusted documents is counted; the others calibrate the thresholds.
FOLDS = 2
#: The model has this many shards at least, and more if one would hold over SHARD_ROWS rows.
SHARDS, SHARD_ROWS = 8, 500_000
#: Bytes of text, for each shard, whose counts meet one copy of it.
GROUP = 8 << 20
#: The share of trusted documents of a language that lie at or below its threshold.
QUANTILE = 0.99
#: Bytes of average text for which the threshold makes allowance, as the perplexities of short texts vary widely.
PRIOR = 100
#: Bytes of text that are counted at once.
RUN = 1 << 22
#: Ids of trusted documents up to this number are broadcast, so that no text moves to meet them; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000

#: The upper 40 bits hold an n-gram, the lower 24 the number of its document in a run.
_GRAM, _DOC = np.uint64(0xFFFFFFFFFF000000), np.uint64(0xFFFFFF)


def grams(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(text number, n-gram that ends there) for each byte; the bytes before a text are zeros."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    pad = bytes(order - 1)
    data = b"".join(x for t in texts for x in (pad, t)) + bytes(8)
    # Eight bytes from each place on, of which the first are the n-gram.
    eight = np.ndarray((len(data) - 8,), dtype=">u8", buffer=data, strides=(1,)).astype(np.uint64)
    inside = np.ones(len(eight), dtype=bool)
    ends = np.cumsum(size + order - 1)
    for k in range(1, order):
        inside[ends - k] = False
    return np.repeat(np.arange(len(texts)), size), eight[inside] >> np.uint64(8 * (8 - order))


def pieces(texts: list[bytes]):
    """(number of the first text, how many, text numbers from it on, n-grams) for runs of texts; a long text comes in slices."""
    for lo, hi in in_chunks(texts, RUN):
        if hi - lo > 1:
            yield lo, hi - lo, *grams(texts[lo:hi])
        else:
            for a in range(0, len(texts[lo]), RUN):
                start = max(0, a - ORDER + 1)
                of, g = grams([texts[lo][start : a + RUN]])
                yield lo, 1, of[a - start :], g[a - start :]


def fit(trusted: DataFrame, text: str) -> DataFrame:
    """(order, is_context, gram, value): log probabilities of n-grams, and log weights of contexts for the next lower order.

    Counts are grouped aggregates; those of lower orders count the distinct bytes before an
    n-gram. The discounts of each order come from how many n-grams occur 1, 2, 3 and 4 times.
    """

    def count(batches):
        lean_memory()
        for _, texts in runs(batches, RUN):
            for _, _, _, g in pieces(texts):
                g, n = np.unique(g, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(n.astype(np.int64))], names=["gram", "n"])

    full = trusted.where(F.octet_length(text) > 0).select(text).mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    levels = {ORDER: written(full, "quality-counts")}
    for k in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1))
        levels[k] = written(levels[k + 1].groupBy(suffix.alias("gram")).agg(F.count(F.lit(1)).alias("n")), "quality-counts")
    out, below = None, None
    for k in range(1, ORDER + 1):
        t = [r or 0 for r in levels[k].agg(*[F.count_if(F.col("n") == i) for i in (1, 2, 3, 4)]).first()]
        y = t[0] / (t[0] + 2 * t[1]) if t[0] and t[1] else 0.5
        d = [min(i, max(0.05, i - (i + 1) * y * t[i] / t[i - 1])) if t[i - 1] else 0.5 * i for i in (1, 2, 3)]
        less = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        context = F.call_function("shiftright", F.col("gram"), F.lit(8))
        sums = levels[k].groupBy(context.alias("context")).agg(F.sum("n").alias("all"), F.sum(less).alias("freed"))
        p = levels[k].withColumn("context", context).join(sums, "context").withColumn("own", (F.col("n") - less) / F.col("all"))
        p = p.withColumn("suffix", F.col("gram").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1)))
        p = p.withColumn("lower", F.lit(1 / 256)) if k == 1 else p.join(below, "suffix")
        p = written(p.select("gram", (F.col("own") + F.col("freed") / F.col("all") * F.col("lower")).alias("p")), "quality-model")
        below = p.select(F.col("gram").alias("suffix"), F.col("p").alias("lower"))
        rows = p.select(F.lit(k).alias("order"), F.lit(False).alias("is_context"), "gram", F.log("p").alias("value"))
        rows = rows.unionByName(sums.select(F.lit(k).alias("order"), F.lit(True).alias("is_context"), F.col("context").alias("gram"), F.log(F.col("freed") / F.col("all")).alias("value")))
        out = rows if out is None else out.unionByName(rows)
    return out


class Shard:
    """Rows of the model by sorted keys: the n-gram or context, above it its order and kind."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values

    @classmethod
    def of(cls, rows: pd.DataFrame) -> Shard:
        kind = rows["order"].to_numpy(dtype=np.uint64) + np.uint64(16) * rows["is_context"].to_numpy(dtype=bool).astype(np.uint64)
        keys = rows["gram"].to_numpy(dtype=np.int64).view(np.uint64) | (kind << np.uint64(56))
        order = np.argsort(keys)
        return cls(keys[order], rows["value"].to_numpy(dtype=np.float32)[order])

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, value), the value 0 if not."""
        if not len(self.keys):
            return np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=np.float32)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = self.keys[at] == keys
        return found, np.where(found, self.values[at], np.float32(0))

    def log_probabilities(self, g: np.ndarray) -> np.ndarray:
        """The log probability of the last byte of each n-gram after the others, from the longest order that is known down."""
        out = np.zeros(len(g), dtype=np.float64)
        left = np.arange(len(g))
        for k in range(ORDER, 0, -1):
            own = g[left] & np.uint64((1 << 8 * k) - 1)
            found, value = self.get(own | np.uint64(k << 56))
            out[left[found]] += value[found]
            left = left[~found]
            _, weight = self.get((own[~found] >> np.uint64(8)) | np.uint64((k + 16) << 56))
            out[left] += weight  # 0 for an unknown context
        out[left] -= math.log(256)
        return out


def shard_of(g, shards: int):
    """The shard of n-grams, and of the contexts that a zero byte is put after: by the two bytes before the last. Columns or arrays."""
    if isinstance(g, Column):
        two = F.call_function("shiftright", g, F.lit(8)).bitwiseAND(F.lit(0xFFFF))
        return F.pmod(F.call_function("shiftright", (two * F.lit(0x9E3779B1)).bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(16)), F.lit(shards)).cast("int")
    two = (g >> np.uint64(8)) & np.uint64(0xFFFF)
    return (((two * np.uint64(0x9E3779B1) & np.uint64(0xFFFFFFFF)) >> np.uint64(16)) % np.uint64(shards)).astype(np.int64)


def sharded(model: DataFrame) -> tuple[DataFrame, int]:
    """((shard, model): its rows packed, their number). Orders 1 and 2, of 66,000 rows at most, are in each."""
    shards = max(SHARDS, -(-model.count() // SHARD_ROWS))
    last = F.when(F.col("is_context"), F.call_function("shiftleft", F.col("gram"), F.lit(8))).otherwise(F.col("gram"))
    to = F.when(F.col("order") > 2, F.array(shard_of(last, shards))).otherwise(F.sequence(F.lit(0), F.lit(shards - 1)))

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        s = Shard.of(rows)
        return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "model": [pack(s.keys, s.values)]})

    rows = model.select(F.explode(to).alias("shard"), "order", "is_context", "gram", "value")
    return written(rows.groupBy("shard").applyInPandas(packed, "shard int, model binary"), "quality-shards"), shards


def document_counts(docs: DataFrame, shards: int, groups: int) -> DataFrame:
    """(cell, blob): the n-gram counts of the documents (key, text) of each run, by shard; cell is the group of runs and the shard.

    A blob packs the documents' keys, the distinct n-grams in order, for each the number of
    its documents, and for each n-gram and document the document's number and the count.
    """
    schema = pa.schema([("cell", pa.int32()), ("blob", pa.binary())])

    def count(batches):
        from pyspark import TaskContext

        lean_memory()
        turn = TaskContext.get().partitionId()
        for (keys,), texts in runs(batches, RUN):
            for first, n, of, g in pieces(texts):
                turn += 1
                out = [(turn % groups * shards + s, blob) for s, blob in blobs(keys[first : first + n], of, g)]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    def blobs(keys: np.ndarray, of: np.ndarray, g: np.ndarray):
        both = (g << np.uint64(24)) | of.astype(np.uint64)
        both.sort()
        first = np.flatnonzero(starts(both))
        n = np.diff(np.append(first, len(both))).astype(np.uint32)
        both = both[first]
        new = np.flatnonzero(starts(both & _GRAM))  # where each distinct n-gram starts
        docs_each = np.diff(np.append(new, len(both)))
        gram, doc = both[new] >> np.uint64(24), (both & _DOC).astype(np.uint32)
        shard = shard_of(gram, shards)
        of_pair = np.repeat(shard.astype(np.uint16), docs_each)
        order = np.argsort(of_pair, kind="stable")
        cuts = np.searchsorted(of_pair[order], np.arange(shards + 1))
        for s in range(shards):
            at, mine = order[cuts[s] : cuts[s + 1]], shard == s
            if len(at):
                gap = np.diff(doc[at], prepend=np.uint32(0))
                begin = np.cumsum(docs_each[mine]) - docs_each[mine]
                gap[begin] = doc[at[begin]]
                yield s, pack(keys, steps(gram[mine]), docs_each[mine].astype(np.uint32), gap, n[at])

    return docs.select("key", "text").mapInArrow(count, "cell int, blob binary")


def scores(docs: DataFrame, model: DataFrame, size: int) -> DataFrame:
    """(key, bits, n): for each key the summed negative log probabilities of its bytes, and their number.

    docs: (key, text), no text empty; size: bytes of all texts. The shards of the model are
    copied to each group of runs of text, GROUP bytes for each shard, so that what moves of
    the model stays in proportion to the text however large the model is, and a task holds
    one shard and the counts of about GROUP bytes.
    """
    parts, shards = sharded(model)
    groups = -(-max(size, 1) // (GROUP * shards))
    counts = document_counts(docs, shards, groups)
    cells = F.transform(F.sequence(F.lit(0), F.lit(groups - 1)), lambda group: group * F.lit(shards) + F.col("shard"))
    copies = parts.select(F.explode(cells).alias("cell"), "model")

    def meet(model: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        lean_memory()
        shard = Shard(*unpack(model["model"].iloc[0])) if len(model) else Shard(np.zeros(0, np.uint64), np.zeros(0, np.float32))
        out = []
        for blob in counts["blob"]:
            keys, gram, docs_each, gap, n = unpack(blob)
            log_p = np.repeat(shard.log_probabilities(np.cumsum(gram)), docs_each)
            begin = np.cumsum(docs_each) - docs_each
            doc = np.cumsum(gap, dtype=np.int64)
            doc -= np.repeat(doc[begin] - gap[begin], docs_each)
            some = np.bincount(doc, weights=n, minlength=len(keys))
            bits = np.bincount(doc, weights=-log_p * n, minlength=len(keys))
            at = np.flatnonzero(some)
            out.append(pd.DataFrame({"key": keys[at], "bits": bits[at], "n": some[at].astype(np.int64)}))
        return pd.concat(out) if out else pd.DataFrame({"key": [], "bits": [], "n": []})

    met = copies.groupBy("cell").cogroup(counts.groupBy("cell")).applyInPandas(meet, "key bigint, bits double, n bigint")
    return met.groupBy("key").agg(F.sum("bits").alias("bits"), F.sum("n").alias("n"))


def kneser_ney_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", carry: list[str] | None = None) -> DataFrame:
    """The columns `carry` (by default all) with perplexity, threshold and kept.

    labels: (doc_id, quality, toxic); trusted are the documents of quality 1 that aren't
    toxic. The byte n-gram model is fitted on one in FOLDS of them, chosen by a hash of the
    id, however many they are; perplexity is that of a document's own bytes. Thresholds come
    from the trusted documents that the model wasn't fitted on. As short texts vary widely, a
    text of n bytes and entropy e counts as (n e + PRIOR m) / (n + PRIOR), m being its
    language's mean. The limit l of a language is the QUANTILE (to 1 in 10,000 of its rank) of
    these, and the threshold at n bytes the perplexity that comes up to it,
    exp(l + (l - m) PRIOR / n); of a language without any trusted ones (null, say), that of
    all. Documents above it aren't kept.

    Null and empty texts have neither perplexity nor threshold and are kept. Without trusted documents all are
    kept, with null thresholds. Repeated rows stay; labels count once. Texts meet the counts
    by a 64-bit hash of id and text. Long texts are counted in slices. Columns with the names
    of the results are replaced.
    """
    names = without(docs, "perplexity", "threshold", "kept").columns if carry is None else carry
    good = labels.groupBy(F.col("doc_id").alias("_af_good")).agg(F.min("quality").alias("q"), F.max("toxic").alias("t")).where("q = 1 and coalesce(t, 0) = 0 and _af_good is not null").select("_af_good")
    good = written(good, "quality-trusted")
    chosen = lambda c: F.pmod(F.xxhash64(c, F.lit("fit")), F.lit(FOLDS)) == 0
    raw, own_id = F.col(f"`{text}`"), F.col(f"`{doc_id}`")
    counted = good.where(chosen("_af_good"))
    counted = F.broadcast(counted) if good.count() <= BROADCAST_IDS else counted
    trusted = docs.join(counted, own_id == F.col("_af_good"), "left_semi").select(raw.alias("text"))
    model = written(fit(trusted, "text"), "quality-table")
    key = row_key(own_id, raw)
    some = docs.where(F.octet_length(raw) > 0).select(key.alias("key"), raw.alias("text"))
    bits = written(scores(some, model, text_bytes(docs, text)), "quality-scores")
    discard(model)
    rows = docs.select(*[F.col(f"`{c}`") for c in names], own_id.alias("_af_id"), F.col(f"`{lang}`").alias("_af_lang"), key.alias("_af_key"), F.coalesce(F.octet_length(raw), F.lit(0)).alias("_af_size"))
    mean = bits.select(F.col("key").alias("_af_k"), (F.col("bits") / F.col("n")).alias("_af_e"))
    found = rows.join(mean, (F.col("_af_key") == F.col("_af_k")) & (F.col("_af_size") > 0), "left").drop("_af_k", "_af_key")
    own = written(found, "quality-rows")
    tested = own.select("_af_id", "_af_lang", "_af_size", "_af_e").join(good.where(~chosen("_af_good")), F.col("_af_id") == F.col("_af_good"), "left_semi").where("_af_e is not null")
    average = F.sum(F.col("_af_e") * F.col("_af_size")) / F.sum("_af_size")
    means = written(tested.groupBy(F.col("_af_lang").alias("_af_l")).agg(average.alias("_af_m")), "quality-means")
    counted = (F.col("_af_e") * F.col("_af_size") + PRIOR * F.col("_af_m")) / (F.col("_af_size") + PRIOR)
    tested = tested.join(means, F.col("_af_lang").eqNullSafe(F.col("_af_l"))).withColumn("_af_c", counted)
    cut = F.percentile_approx("_af_c", QUANTILE, 10_000)
    all_cut, all_mean = tested.agg(cut, average).first()
    limits = written(tested.groupBy("_af_l").agg(cut.alias("_af_cut"), F.first("_af_m").alias("_af_m")), "quality-limits")
    limit, middle = F.coalesce("_af_cut", F.lit(all_cut).cast("double")), F.coalesce("_af_m", F.lit(all_mean).cast("double"))
    out = own.join(limits, F.col("_af_lang").eqNullSafe(F.col("_af_l")), "left")
    threshold = F.exp(limit + (limit - middle) * PRIOR / F.when(F.col("_af_size") > 0, F.col("_af_size")))
    out = out.withColumn("perplexity", F.exp("_af_e")).withColumn("threshold", threshold)
    kept = F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return out.select(*[F.col(f"`{c}`") for c in names], "perplexity", "threshold", kept.alias("kept"))


def op9_kneser_ney_quality(spark, sf_dir):
    return kneser_ney_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), carry=["doc_id", "lang"])
