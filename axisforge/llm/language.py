"""Language identification by Bayesian fusion of text, declared language, address suffix and host."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from axisforge.llm.blobs import lean_memory
from axisforge.llm.common import table, without, written

#: The text model is fitted on this many distinct texts of each declared language at most.
FIT = 20_000
#: Byte trigrams are counted in this many cells (a power of 2).
CELLS = 1 << 16
#: Share of a text's trigrams that any language takes for noise (numbers, keys, markup).
NOISE = 0.5
#: Share of the log likelihood of a text that counts: its trigrams overlap and depend on each other.
TEMPER = 1 / 3
#: Documents that a host, and its domain, count for beside their own.
STRENGTH = 20.0
#: The language of texts that fit none, its prior, and the least posterior of an accepted language.
UNKNOWN, UNKNOWN_PRIOR, LEAST = "und", 1e-4, 0.5

#: Languages whose counts a task holds before it hands them on.
HELD = 32

#: A-Z as a-z, other bytes as they are.
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint32)
_LETTER = np.array([97 <= (b | 32) <= 122 or b >= 128 for b in range(256)])


def trigram_cells(data: np.ndarray) -> np.ndarray:
    """The cells of the trigrams that start at each byte but the last two."""
    b = _LOWER[data]
    packed = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return (packed * np.uint32(0x9E3779B1)) >> np.uint32(32 - (CELLS.bit_length() - 1))


def language_code(declared: Column) -> Column:
    """The language that a declaration such as en, EN-us or de_AT names by its code of two or three letters; null for anything else."""
    code = F.lower(F.regexp_extract(F.trim(declared), r"^([A-Za-z]{2,3})(?:[-_][A-Za-z0-9_-]*)?$", 1))
    return F.nullif(code, F.lit(""))


def fit_sample(docs: DataFrame, declared: str, text: str) -> tuple[DataFrame, list[str]]:
    """The documents (l, t) that the text model is fitted on, and all declared languages.

    Of each language the FIT distinct texts with the smallest hashes, each once.
    """
    spark = docs.sparkSession
    known = docs.where(F.col(declared).isNotNull() & (F.octet_length(text) > 2)).select(F.col(declared).alias("l"), F.col(text).alias("t"), F.xxhash64(text).alias("h"))
    texts = written(known.select("l", "h").distinct(), "language-texts")
    per = {r[0]: r[1] for r in texts.groupBy("l").count().collect()}  # a row for each language
    # About twice as many hashes as needed are ranked, whatever the data.
    near = [(lang, min(2**63 - 1, -(2**63) + 2**64 * (2 * FIT + 100) // n)) for lang, n in per.items()]
    few = texts.join(F.broadcast(spark.createDataFrame(near, "l string, near long")), "l").where("h <= near")
    few = few.withColumn("rank", F.row_number().over(Window.partitionBy("l").orderBy("h"))).where(F.col("rank") <= FIT)
    last = few.groupBy("l").agg(F.max("h").alias("last"))
    return known.join(F.broadcast(last), "l").where("h <= last").dropDuplicates(["l", "h"]).select("l", "t"), sorted(per)


def fit_text_model(docs: DataFrame, declared: str, text: str) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities [cells, languages]) of byte trigrams, UNKNOWN last and uniform.

    Every language that a text of 3 bytes or more declares is one of them, however rare;
    there are as many as language codes are in use, at 256 KB each. Each is fitted on FIT of its distinct texts at most, so that copies
    count once.
    """
    sample, langs = fit_sample(docs, declared, text)
    at_lang = {lang: i for i, lang in enumerate(langs)}

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = np.frombuffer(t.encode(), dtype=np.uint8)
                if len(data) > 2:
                    if lang not in sums and len(sums) == HELD:
                        yield from counted(sums)
                        sums.clear()
                    sums.setdefault(lang, np.zeros(CELLS))
                    sums[lang] += np.bincount(trigram_cells(data), minlength=CELLS)
        yield from counted(sums)

    def counted(sums):
        for lang, s in sums.items():
            at = np.flatnonzero(s)
            yield pa.RecordBatch.from_pydict({"l": np.full(len(at), at_lang[lang], dtype=np.int32), "cell": at.astype(np.int32), "n": s[at]}, schema=schema)

    schema = pa.schema([("l", pa.int32()), ("cell", pa.int32()), ("n", pa.float64())])
    counts = sample.mapInArrow(count, "l int, cell int, n double").groupBy("l", "cell").agg(F.sum("n").alias("n")).toPandas()
    model = np.full((CELLS, len(langs) + 1), -math.log(CELLS), dtype=np.float32)
    for i in range(len(langs)):
        own = counts[counts.l == i]
        p = np.full(CELLS, 0.1)
        p[own["cell"].to_numpy()] += own["n"].to_numpy()
        model[:, i] = np.log((1 - NOISE) * p / p.sum() + NOISE / CELLS)
    return [*langs, UNKNOWN], model


def text_likelihoods(docs: DataFrame, text: str, langs: list[str], model: np.ndarray) -> DataFrame:
    """docs with `_af_ll` (array<float>: tempered log likelihoods in the order of langs) and `_af_letters` (boolean)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # CELLS rows of a few languages, whatever the data
    names = docs.columns
    col = names.index(text)
    schema = docs.select("*", F.lit(None).cast("array<float>").alias("_af_ll"), F.lit(False).alias("_af_letters")).schema

    def score(batches):
        lean_memory()
        table_ = shared.value
        for batch in batches:
            ll, letters = [], []
            for t in batch.column(col):
                data = np.frombuffer((t.as_py() or "").encode(), dtype=np.uint8)
                if len(data) > 2:
                    total = np.zeros(table_.shape[1])
                    for lo in range(0, len(data) - 2, 1 << 16):
                        total += table_[trigram_cells(data[lo : lo + (1 << 16) + 2])].sum(axis=0, dtype=np.float64)
                    ll.append((total * TEMPER).astype(np.float32))
                else:
                    ll.append(np.zeros(table_.shape[1], dtype=np.float32))
                letters.append(bool(_LETTER[data].any()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ll, pa.list_(pa.float32())), pa.array(letters)], names=[*names, "_af_ll", "_af_letters"])

    return docs.mapInArrow(score, schema)


class Evidence:
    """What the rows of a table say about languages: the text model, and counts of declarations, suffixes, hosts and domains."""

    def __init__(self, docs: DataFrame, text: str = "text", declared: str | None = None, host: str | None = None, domain: str | None = None, suffix: str | None = None):
        self.text, self.columns = text, {"_af_declared": declared, "_af_host": host, "_af_domain": domain, "_af_suffix": suffix}
        labelled = self.evidence(docs if declared else docs.limit(0), [])
        self.langs, self.model = fit_text_model(labelled.select("_af_declared", "_af_text"), "_af_declared", "_af_text")
        used = [k for k, c in self.columns.items() if c]
        # A row for each document, without its text.
        seen = written(self.scored(docs, []).select(*used, "_af_best"), "language-seen")
        self.total = {r[0]: float(r[1]) for r in seen.groupBy("_af_best").count().collect()}  # a row for each language
        self.sides = {}
        for key in used:
            per = seen.groupBy(key, "_af_best").agg(F.count(F.lit(1)).cast("double").alias("n"))
            counts = per.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("_af_best", "n"))).alias("m"))  # langs entries at most
            self.sides[key] = written(counts.select(key, F.array(*[F.coalesce(F.col("m")[lang], F.lit(0.0)) for lang in self.langs]).alias("_af_n")), "language-counts")

    def evidence(self, docs: DataFrame, names: list[str]) -> DataFrame:
        value = {a: F.col(f"`{c}`").cast("string") if c else F.lit(None).cast("string") for a, c in self.columns.items()}
        value["_af_declared"] = language_code(value["_af_declared"])
        return docs.select(*[F.col(f"`{c}`") for c in names], *[v.alias(a) for a, v in value.items()], F.col(f"`{self.text}`").alias("_af_text"))

    def named(self, at: Column) -> Column:
        return F.element_at(F.array(*map(F.lit, self.langs)), at.cast("int"))

    def scored(self, docs: DataFrame, names: list[str]) -> DataFrame:
        """names and evidence with the texts' likelihoods and their best language; the text itself only if it is one of names."""
        out = text_likelihoods(self.evidence(docs, names), "_af_text", self.langs, self.model).drop("_af_text")
        return out.withColumn("_af_best", F.when(F.col("_af_letters"), self.named(F.array_position("_af_ll", F.array_max("_af_ll")))).otherwise(UNKNOWN))

    def joined(self, frame: DataFrame, key: str) -> DataFrame:
        side = self.sides[key].withColumnRenamed(key, "_af_key")
        return frame.join(side, F.col(key).eqNullSafe(F.col("_af_key")), "left").drop("_af_key")

    def fused(self, scored: DataFrame) -> DataFrame:
        """scored with language and posterior."""
        langs = self.langs
        everywhere = sum(self.total.values()) or 1.0
        prior: Column = F.array(*[F.lit(UNKNOWN_PRIOR if lang == UNKNOWN else max(self.total.get(lang, 0.0), 1.0) / everywhere) for lang in langs])
        out = scored.withColumn("_af_log", F.col("_af_ll").cast("array<double>"))
        plus = lambda other: F.zip_with("_af_log", other, lambda a, b: a + b)
        none = F.array(*[F.lit(0.0)] * len(langs))
        for key in ("_af_declared", "_af_suffix"):
            if self.columns[key]:
                values = self.sides[key].count() + 1
                totals = F.array(*[F.lit(self.total.get(lang, 0.0) + 0.5 * values) for lang in langs])
                out = self.joined(out, key)
                out = out.withColumn("_af_log", plus(F.zip_with(F.coalesce("_af_n", none), totals, lambda n, t: F.log((n + 0.5) / t)))).drop("_af_n")
        for key, m in (("_af_domain", "_af_dm"), ("_af_host", "_af_hm")):
            if self.columns[key]:
                out = self.joined(out, key)
                out = out.withColumn(m, F.zip_with(F.coalesce("_af_n", none), prior, lambda c, p: c + p * STRENGTH)).drop("_af_n")
                out = out.withColumn("_af_mass", F.aggregate(F.col(m), F.lit(0.0), lambda a, b: a + b)).withColumn(m, F.transform(F.col(m), lambda c: c / F.col("_af_mass"))).drop("_af_mass")
                prior = F.col(m)
        out = out.withColumn("_af_log", plus(F.transform(prior, lambda p: F.log(p)))).withColumn("_af_top", F.array_max("_af_log"))
        out = out.withColumn("posterior", 1.0 / F.aggregate("_af_log", F.lit(0.0), lambda a, b: a + F.exp(b - F.col("_af_top"))))
        return out.withColumn("language", F.when(F.col("_af_letters"), self.named(F.array_position("_af_log", F.col("_af_top")))).otherwise(UNKNOWN))


def identify(docs: DataFrame, text: str = "text", declared: str | None = None, host: str | None = None, domain: str | None = None, suffix: str | None = None, accepted: set[str] | None = None, carry: list[str] | None = None) -> DataFrame:
    """The columns `carry` (by default all) with language, posterior, text_language and kept.

    The posterior of a language is the product of
      - the tempered likelihood of the text's byte trigrams (one class, UNKNOWN, is uniform);
      - the likelihoods of the declared language and of the address suffix, each a smoothed
        table of how often it occurs with the texts' own languages, over all rows;
      - the prior of the host: its share of each language, smoothed towards that of its domain,
        and this towards that of all rows, by STRENGTH documents each.
    declared, host, domain and suffix name columns; those not given count for nothing. What
    declares no language code is undeclared (see language_code). Texts that declare a
    language have also trained its text model, so that both kinds of evidence agree more
    than independent ones would; the tempered likelihood allows for it.
    kept: the best language is not UNKNOWN, has a posterior of LEAST or more and is one of
    `accepted` (None: any), and the text holds a letter.

    Texts are scored twice, first for the counts, grouped aggregates of a compact table, then
    with them, so that no text is written or moved; hosts may be any number. Null or empty
    texts, and those without letters, are UNKNOWN and not kept; a null declaration, suffix or
    host is a value of its own. Of languages with equal posteriors the first code wins.
    Repeated rows stay. Empty tables give empty results, long texts are read whole. Columns with the names of the results are
    replaced.
    """
    names = without(docs, "language", "posterior", "text_language", "kept").columns if carry is None else carry
    known = Evidence(docs, text, declared, host, domain, suffix)
    out = known.fused(known.scored(docs, names))
    kept = (F.col("language") != UNKNOWN) & (F.col("posterior") >= LEAST)
    if accepted is not None:
        kept = kept & F.col("language").isin(*sorted(accepted))
    return out.select(*[F.col(f"`{c}`") for c in names], "language", "posterior", F.col("_af_best").alias("text_language"), kept.alias("kept"))


def identify_pages(pages: DataFrame) -> DataFrame:
    """(page_id, language, posterior, text_language, kept) of raw pages: the html's lang attribute, and suffix, domain and host of the url."""
    from axisforge.llm.urls import host_of

    body = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"(?s)<[^>]*>", " ")
    lang = F.lower(F.regexp_extract("html", r"(?is)<html\b[^>]*\blang\s*=\s*[\"']?([a-z]+)", 1))
    host = host_of(F.col("url"))
    rows = pages.select("page_id", body.alias("text"), F.nullif(lang, F.lit("")).alias("declared"), host.alias("host"), F.substring_index(host, ".", -2).alias("domain"), F.substring_index(host, ".", -1).alias("suffix"))
    return identify(rows, declared="declared", host="host", domain="domain", suffix="suffix", carry=["page_id"])


def op7_fused_language_id(spark, sf_dir):
    """The rows of documents (doc_id) and of pages (page_id), each table by its own evidence; the other id is null."""
    docs = identify(table(spark, sf_dir, "documents"), declared="lang", host="source", carry=["doc_id"])
    pages = identify_pages(table(spark, sf_dir, "pages"))
    return docs.unionByName(pages, allowMissingColumns=True)
