"""Language identification by multinomial naive Bayes over hashed character
n-grams.

Learning counts the n-grams (orders 1 to 3, hashed to BUCKETS cells) of every
training row in one pass; the counts are summed in Spark and the resulting
log-probability matrix, whose size is languages x orders x BUCKETS whatever
the input, is broadcast. Scoring adds up the matrix cells of a text's n-grams
with numpy, many texts at a time, over whole texts.

Null or empty texts, and texts without a letter, get `und` and score 0. Rows
with a null lang or null doc_id teach nothing. With nothing to learn from,
every text gets `und`. Repeated rows count each; other columns are ignored.
Equal scores go to the language that sorts first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_arrow

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
#: Characters that one numpy step works on (a longer text is one step).
STEP = 1 << 18
#: The matrix is broadcast: more languages than this are refused.
MAX_LANGUAGES = 500
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_COEF = (np.uint32(2654435769), np.uint32(2246822519), np.uint32(3266489917))


def fold(column: str, parts: int) -> Column:
    """crc32 of the column's text modulo `parts`; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """First and end positions of each text in the joined texts, and the cell
    of the n-gram at each position for each order. Two blanks follow a text."""
    low = [t.lower() for t in texts]
    codes = np.frombuffer("  ".join(low + [""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(t) for t in low])
    first = np.r_[0, np.cumsum(size + 2)[:-1]]
    cells, total = [], np.uint32(0)
    n = len(codes) - 2
    for k in ORDERS:
        total = total + codes[k - 1:k - 1 + n] * _COEF[k - 1]
        x = total ^ (total >> np.uint32(15))
        x = x * np.uint32(2654435761 + 2 * k)
        cells.append((x >> np.uint32(16)).astype(np.int64))
    return first, first + size, cells


def _steps(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    texts, at, size = [], 0, 0
    for i, text in enumerate(column.to_pylist()):
        texts.append(text or "")
        size += len(texts[-1])
        if size >= STEP:
            yield at, texts
            texts, at, size = [], i + 1, 0
    if texts:
        yield at, texts


def _count(languages: list[str]):
    number = {name: i for i, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), len(ORDERS), BUCKETS), np.int64)
        for batch in batches:
            lang = np.array([number[x] for x in batch.column(1).to_pylist()], np.int64)
            for lo, texts in _steps(batch.column(0)):
                first, end, cells = _grams(texts)
                kind = np.full(len(cells[0]), len(languages), np.int64)
                for i, (a, b) in enumerate(zip(first, end)):
                    kind[a:b] = lang[lo + i]
                kind *= BUCKETS
                for k, cell in enumerate(cells):
                    got = np.bincount(kind + cell, minlength=(len(languages) + 1) * BUCKETS)
                    total[:, k] += got.reshape(-1, BUCKETS)[:-1]
        flat = total.ravel()
        cell = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(flat[cell])], ["cell", "n"])
    return run


def fit(train: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Learn from (text, lang): languages, log priors, and the log-probability
    matrix (orders, languages, BUCKETS)."""
    train = train.filter("lang is not null and text is not null")
    rows = train.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    size = {r["lang"]: r["count"] for r in rows}
    languages = sorted(size)
    counts = np.zeros(len(languages) * len(ORDERS) * BUCKETS)
    if languages:
        got = (in_arrow(train.select("text", "lang"), _count(languages), "cell long, n long")
               .groupBy("cell").agg(F.sum("n").alias("n")).toArrow())
        counts[got["cell"].to_numpy()] = got["n"].to_numpy()
    counts = counts.reshape(len(languages), len(ORDERS), BUCKETS).transpose(1, 0, 2) + 0.5
    prior = np.log(np.array([size[x] for x in languages], float) / max(1, sum(size.values())))
    return languages, prior, np.log(counts / counts.sum(2, keepdims=True)).astype(np.float32)


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, prior, matrix = model.value
        for batch in batches:
            best, score = [], []
            for _, texts in _steps(batch.column("text")):
                first, end, cells = _grams(texts)
                total = np.tile(prior, (len(texts), 1))
                have = np.flatnonzero(end > first)
                edge = np.c_[first[have], end[have]].ravel()
                for k, cell in enumerate(cells if len(have) else ()):
                    cell = np.r_[cell, 0]
                    for l in range(len(languages)):
                        total[have, l] += np.add.reduceat(matrix[k, l][cell], edge, dtype=np.float64)[::2]
                for text, row in zip(texts, total):
                    if not len(row) or not _LETTER.search(text):
                        best.append(UNKNOWN)
                        score.append(0.0)
                    else:
                        i = int(row.argmax())
                        best.append(languages[i])
                        score.append(float(1 / np.exp(row - row[i]).sum()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(best, pa.string()), pa.array(score, pa.float64())],
                [*batch.schema.names[:-1], "lang_pred", "score"])
    return run


def identify(docs: DataFrame, train: DataFrame, keep: list[str]) -> DataFrame:
    """Columns `keep` of `docs` with lang_pred and score of its text, learned
    from the text and lang of `train`."""
    model = docs.sparkSession.sparkContext.broadcast(fit(train))
    rows = docs.select(*keep, F.col("text").cast("string").alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return in_arrow(rows, _score(model), f"{schema}, lang_pred string, score double")


def keep_known(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of `docs`, all their columns, whose text is of a known language
    with a score of `least` or more, learned from the rows' own text and lang. The
    score is the posterior of the whole text, which is near 1 for one language on any
    text of more than a few words, so this rejects little but texts without a letter;
    it does not tell languages that were not learned.
    Without any lang to learn from, rows whose text has a letter are kept."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs.select("text", "lang")))
    if not model.value[0]:
        return docs.filter(F.coalesce(F.regexp_count(F.col("text"), F.lit(r"\p{L}")) > 0, F.lit(False)))
    return in_arrow(docs, _known(model, least), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))


def _known(model, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([batch.column("text")], ["text"])
            for scored in _score(model)(iter([texts])):
                keep = np.array([name != UNKNOWN for name in scored.column(0).to_pylist()], bool)
                keep &= scored.column(1).to_numpy() >= least
                yield batch.take(pa.array(np.flatnonzero(keep)))
    return run
