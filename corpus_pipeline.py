"""Corpus pipeline: stages that each take (spark, docs, sf_dir) and return a DataFrame.

All stages take nulls in any column, texts of any length, repeated rows and empty tables, and
keep the columns of documents as they are (the last returns its own); columns that an operator
adds never clash with them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from axisforge.llm.bpe import bpe_encode
from axisforge.llm.common import ship, table, written
from axisforge.llm.exact import exact_dedup
from axisforge.llm.language import identify
from axisforge.llm.mixing import cyclic_weights, n_words, repeated, water_fill_mix
from axisforge.llm.near import near_filter


def language_id(spark, docs, sf_dir):
    """Documents of which the language is found; the others go: null and empty texts, those without letters, and those that fit no language."""
    ship(spark)
    return identify(docs, declared="lang", host="source").where("kept").select(docs.columns)


def exact(spark, docs, sf_dir):
    """One document of each normalised text, that with the smallest id (null last; of equal rows one). Null counts as empty."""
    return exact_dedup(docs)


def near(spark, docs, sf_dir):
    """One document of each group of near-duplicates, the one with the smallest id (null last). Texts without words have none."""
    ship(spark)
    return near_filter(docs)


def mix(spark, docs, sf_dir):
    """The sources by weights 3, 1, 2 in turn to 150 % of all words, none over 2 epochs: documents repeat as often as the mix takes them.

    Null is a source of its own. Documents without words come once.
    """
    mixed = water_fill_mix(docs, cyclic_weights(docs, (3, 1, 2)), share=1.5, epochs=2.0, seed=17, size=n_words(F.col("text")), key=F.col("doc_id"))
    return repeated(mixed, docs.columns).select(docs.columns)


def encode(spark, docs, sf_dir):
    """Each document's token ids, and the digest of what they decode to; a null or empty text has no ids."""
    ship(spark)
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe_encode(docs, path, pattern, ("ids", "n_tokens", "decoded_sha256"), ["doc_id", "lang", "source"])


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("mixing to target weights", mix),
    ("byte-level BPE", encode),
]
#: SQL can express neither the first and third stage nor the last.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Applies STAGES to documents; each result is written as Parquet and reread as the next one's docs."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
