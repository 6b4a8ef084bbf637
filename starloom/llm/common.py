"""Helpers shared by the operators: written intermediate tables, batches of
texts as one byte array, word and shingle hashes."""

from __future__ import annotations

import ctypes
import os
import tempfile
import time
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData, SparkSession

from ..session import ensure_checkpoint_dir

#: Bytes of text that one numpy step works on (a longer text is one step).
SLICE_BYTES = 1 << 20


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the executors' Python workers, once for
    each application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(os.path.realpath(tempfile.mkdtemp()), f"{os.path.basename(top)}.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)


def release_memory() -> None:
    """Give freed memory back to the system. A Python worker is used again by later
    tasks, of other operators too, and would keep what its largest step took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim is not None:
        trim(0)


def _releasing(function: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        release_memory()
    return run


def in_arrow(df: DataFrame, function: Callable, schema: str, release: bool = True) -> DataFrame:
    """mapInArrow with this package importable in the workers, which keep no freed
    memory behind a task (without `release` they keep it for the next one)."""
    ship_package(df.sparkSession)
    return df.mapInArrow(_releasing(function) if release else function, schema)


def in_groups(grouped: GroupedData, function: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """applyInArrow on the same terms as in_arrow."""
    def run(table: pa.Table) -> pa.Table:
        out = function(table)
        del table
        release_memory()
        return out

    ship_package(grouped._df.sparkSession)
    return grouped.applyInArrow(run, schema)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster names in spark.checkpoint.dir."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a Parquet table in the shared folder and read it back:
    lineage ends here, so a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out.stored_path = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for table in tables:
        remove_path(table.sparkSession, table.stored_path)


def release_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of finished steps deleted now: Spark does so once the driver has
    collected their garbage, which on a heap with room may be after many more steps. Twice, as the
    last step's plan is held until the listeners have heard of its end."""
    for pause in (0.3, 0):
        spark.sparkContext._jvm.System.gc()
        time.sleep(pause)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a written intermediate table that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the n + 1 offsets into them.
    A null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if large else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) for runs of whole texts
    of about `limit` bytes."""
    data, at = bytes_of(column)
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo]
        lo = hi


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits depend on all input bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def seeded(count: int, seed: int) -> np.ndarray:
    """`count` odd 64-bit constants made from a seed."""
    return mix64(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                 + np.uint64(seed)) | np.uint64(1)


_SYMBOL = seeded(256, 11)
_BASE = 0x5851F42D4C957F2D
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base mod 2**64 and of its inverse, n of each."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 2)
        up = np.full(size, _BASE, np.uint64)
        down = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        if size > 2 * SLICE_BYTES:  # one very long text: not worth keeping
            return np.cumprod(up), np.cumprod(down)
        _POWERS["up"], _POWERS["down"] = np.cumprod(up), np.cumprod(down)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray,
                symbol: np.ndarray = _SYMBOL) -> np.ndarray:
    """64-bit hashes of data[start:end] for many spans: a polynomial hash, by
    differences of one running sum (arithmetic mod 2**64). Other constants for
    the byte values (`symbol`) give an independent hash."""
    up, down = _powers(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(symbol[data] * up[:-1], out=total[1:])
    return mix64((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


#: Fixed values of the word rule: 0x20 and 0x09-0x0D separate words.
WORD_BREAK = np.zeros(256, bool)
WORD_BREAK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(data: np.ndarray, at: np.ndarray,
               breaks: np.ndarray = WORD_BREAK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of concatenated texts (offsets `at`), and
    the text that each word belongs to. Words do not cross texts. `breaks`
    marks the byte values between words."""
    word = ~breaks[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    inner = at[1:-1]
    inner = inner[inner < len(data)]
    first[inner] = word[inner]
    start = np.flatnonzero(first)
    last = word.copy()
    last[:-1] &= ~word[1:]
    inner = inner[inner > 0]
    last[inner - 1] = word[inner - 1]
    end = np.flatnonzero(last) + 1
    return start, end, np.searchsorted(at, start, "right") - 1


def shingle_hashes(words: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words of one text, and their texts; a text
    of fewer words (one at least) gives its whole sequence as one."""
    coef = seeded(size, 77)
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    full = np.zeros(n, bool)
    if n >= size:
        full[:n - size + 1] = doc[:n - size + 1] == doc[size - 1:]
    at = np.flatnonzero(full)
    out = np.zeros(len(at), np.uint64)
    for k in range(size):
        out += words[at + k] * coef[k]
    owner = doc[at]
    head = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    count = np.diff(np.r_[head, n])
    short = count < size
    head, count = head[short], count[short]
    if len(head):
        total = np.zeros(len(head), np.uint64)
        for k in range(size - 1):
            have = count > k
            total[have] += words[head[have] + k] * coef[k]
        total += count.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
        out, owner = np.r_[out, total], np.r_[owner, doc[head]]
    return mix64(out), owner


def sorted_sets(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (owner, hash) pairs in that order."""
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    if len(hashes):
        new = np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])]
        hashes, owner = hashes[new], owner[new]
    return hashes, owner
