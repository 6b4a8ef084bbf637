"""A corpus pipeline: language, near copies, repeated passages, mixing, pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's docs; all but the last return the
columns of documents. Every stage works on all rows that its predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.common import shared_path
from starloom.llm.language_id import keep_known
from starloom.llm.minhash_dedup import keep_firsts
from starloom.llm.mixing import mixed_rows
from starloom.llm.queries import tokenizer_path
from starloom.llm.sentence_pieces import encode
from starloom.llm.suffix_dedup import remove_repeats


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is not known: texts without a letter, and the
    few (mostly short ones) of which no learned language is likelier than all others
    together. Learns from the documents' lang."""
    return keep_known(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the least doc_id of each group of near copies
    (five-word shingles, similarity of 0.8 or more)."""
    return keep_firsts(docs, shingle=5, threshold=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out every byte string of 100 bytes that also starts earlier."""
    return remove_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents of small sources, up to twice, so that the sources'
    weights are as even as that allows; every document stays once at least."""
    return mixed_rows(docs, max_repeats=2.0)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_pieces, ids) of every row."""
    return encode(docs, tokenizer_path("piece_bpe_32k.model"), ["doc_id", "source"])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("pieces", pieces),
]

# The language model, suffix sorting and pieces are not SQL; a test compares the rows of
# run() with plain versions of the stages behind the language model (which is held
# against held-out rows), but for how often mixing uses a document.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
