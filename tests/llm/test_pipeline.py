"""The pipeline against its stages done by hand on a small table."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from axisforge.llm import common

from ..conftest import SF
from .test_operators import near_truth

tiktoken = pytest.importorskip("tiktoken")


def test_stages_take_effect(spark):
    docs = common.table(spark, SF, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    frames = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        frames.append(common.written(stage(spark, frames[-1], SF), f"test{k}"))
        assert k == 4 or frames[-1].columns == docs.columns
    known, exact, near, mixed, encoded = ([r for r in f.collect()] for f in frames[1:])
    assert {r.doc_id for r in known} <= set(rows) and len(known) > 0.97 * len(rows)
    first = {}
    for r in sorted(known, key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text), r.doc_id)
    assert sorted(r.doc_id for r in exact) == sorted(first.values())
    assert sorted(r.doc_id for r in near) == sorted(set(near_truth([(r.doc_id, r.text) for r in exact]).values()))
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in near}
    copies = Counter(r.doc_id for r in mixed)
    assert set(copies) <= set(size) and max(copies.values()) <= 2
    total = sum(size.values())
    assert sum(size[i] * n for i, n in copies.items()) == pytest.approx(1.5 * total, rel=0.3)
    import public_tokenizers as P

    from axisforge.llm.bpe import Vocabulary

    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=Vocabulary.load(P.path("byte_bpe_50k.tiktoken")).ranks, special_tokens={})
    assert Counter(r.doc_id for r in encoded) == copies
    for r in encoded:
        assert r.ids == lib.encode_ordinary(rows[r.doc_id].text) and r.n_tokens == len(r.ids)
    assert not math.isnan(total)


def test_run_equals_the_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "ids", "n_tokens"} <= set(out.columns)


def test_stages_on_odd_rows_and_on_none(spark):
    words = "the and with that have this from they been will would there their what about which when make like time just know take"
    rows = [(i, f"{words} {i}", "en", "a", 100) for i in range(6)]
    rows += [(None, None, None, None, None), (None, f"{words} more", "en", None, 9), (None, f"{words} more", "en", None, 9), (7, None, "en", "a", 0), (8, "", "de", "b", 0), (9, "12 34", "en", "b", 5), (3, "another text with the id of the third one, and of some length", "en", "b", 9), (10, "the and that " * 20_000, "en", "c", 1)]
    for given in (rows, []):
        docs = spark.createDataFrame(given, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumn("kept", F.lit("own")).withColumn("size", F.lit(1))
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            alone = stage(spark, docs, SF)  # each stage also takes the rows as they are
            before = docs.count()
            assert (alone.columns == docs.columns) == (k < 4) and alone.count() <= 2 * before
            if not given:
                assert alone.collect() == []
    kept = corpus_pipeline.language_id(spark, spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"), SF)
    assert all(r.text and any(c.isalpha() for c in r.text) for r in kept.collect())
    one = corpus_pipeline.exact(spark, kept, SF).collect()
    assert len(one) == len({r.text for r in one}) and sum(r.doc_id is None for r in one) == 1
