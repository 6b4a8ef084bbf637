"""Token ids in binary files: canonical length-limited Huffman codes.

1. Each text is encoded with a tokenizer of the ``tokenizers`` library. Texts
   are cut where its pre-tokenizer always cuts: at a blank between two
   characters that are not white space, and, in pieces of Latin letters, digits
   and punctuation alone, where one of these ends. Arrow finds the distinct
   strings of a step; those seen before come from a bounded memory in the
   worker, the library encodes the new ones.
2. Ids are counted over all documents; package-merge turns the counts into code
   lengths of at most MAX_BITS, and these alone define the canonical code.
3. Documents are sorted over the cluster by doc_id; each task packs whole
   documents into blocks (BLOCK_IDS ids or one longer document) and writes them
   as rows of a Parquet dataset: part, block, ids of the part before it, doc
   ids and lengths, the bit offset of every STRIDE-th id, and the code bits.
   A second small dataset holds the code lengths.
4. Any block can be decoded alone, and from any of its offsets: all offsets of
   a block advance together through one table lookup for each id.

Null texts count as empty: one end id. Rows of equal doc_id stay rows of their
own, in the order of their ids; null doc_ids come first. An empty table gives
empty files.
"""

from __future__ import annotations

import json
import os
import zlib
from codecs import charmap_decode
from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bytes_of, in_arrow, shared_path, stored, text_slices

MAX_BITS = 18
BLOCK_IDS = 1 << 20
STRIDE = 256
#: Words, and pieces left whole, that a worker remembers.
CACHE_PIECES, CACHE_WORDS = 1 << 19, 1 << 20
STEP = 1 << 22
END_ID = 0

#: Kinds of bytes: three that byte-level pre-tokenizers cut into runs, each with the blank before
#: it; others (other scripts, apostrophes); and white space, from the newline on.
_LETTER, _DIGIT, _MARK, _OTHER, _NEWLINE, _SPACE, _BLANK = range(7)
_MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: White space of three bytes in UTF-8.
_WIDE_SPACE = [int.from_bytes(chr(c).encode()) for c in
               (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_BETWEEN = "\x00"


class _Known:
    """A bounded memory of strings and their ids. When it is full, only strings
    used again are kept, the half of it that was used most at the most."""

    def __init__(self, learn, most: int):
        self.learn, self.most = learn, most
        self.numbers = self._numbered([])
        self.flat, self.until = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.uses = np.zeros(0, np.int64)
        self.filled = 0

    @staticmethod
    def _numbered(strings: list) -> defaultdict:
        """Numbers of strings; any other gets the next number when it is looked up."""
        return defaultdict(count(len(strings)).__next__, zip(strings, range(len(strings))))

    def _add(self, ids: np.ndarray, size: np.ndarray) -> None:
        known, until = len(self.uses), self.until
        if known + len(size) + 1 > len(until):
            self.until = np.zeros(2 * (known + len(size) + 1), np.int64)
            self.until[:known + 1] = until[:known + 1]
        self.until[known + 1:known + 1 + len(size)] = self.filled + np.cumsum(size)
        if self.filled + len(ids) > len(self.flat):
            flat, self.flat = self.flat, np.zeros(2 * (self.filled + len(ids)), np.uint32)
            self.flat[:self.filled] = flat[:self.filled]
        self.flat[self.filled:self.filled + len(ids)] = ids
        self.filled += len(ids)
        self.uses = np.r_[self.uses, np.zeros(len(size), np.int64)]

    def _forget(self) -> None:
        keep = np.flatnonzero(self.uses > 1)
        if len(keep) > self.most // 2:
            keep = np.sort(keep[np.argsort(-self.uses[keep], kind="stable")[:self.most // 2]])
        strings = list(self.numbers)
        size = self.until[keep + 1] - self.until[keep]
        ids = self.flat[spans(self.until[keep], size)]
        self.numbers = self._numbered([strings[k] for k in keep.tolist()])
        self.uses, self.filled = np.zeros(0, np.int64), 0
        self._add(ids, size)

    def ids(self, strings: list[str], uses: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct strings, one after the other, and how many each has; `uses` counts for each."""
        if len(self.numbers) > self.most:
            self._forget()
        at = np.fromiter(map(self.numbers.__getitem__, strings), np.int64, len(strings))
        new = at >= len(self.uses)
        if new.any():
            self._add(*self.learn(list(compress(strings, new.tolist()))))
        self.uses[at] += uses
        size = self.until[at + 1] - self.until[at]
        return self.flat[spans(self.until[at], size)], size


def spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (size of them) of each, one after the other."""
    end = np.cumsum(size)
    return np.repeat(start + size - end, size) + np.arange(end[-1] if len(end) else 0)


class PieceEncoder:
    """Ids of texts. Pieces between blanks are cut into the words that the
    pre-tokenizer makes of them, pieces with other characters are left whole.
    Both are remembered; new words go to the library's model, new pieces to the library."""

    def __init__(self, path: str, pieces: int = CACHE_PIECES, words: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary, added = self.tokenizer.get_vocab(), self.tokenizer.get_added_tokens_decoder()
        # Bytes that an id stands for (byte-level vocabularies write a byte as a character).
        self.id_bytes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        self.id_bytes[list(vocabulary.values())] = list(map(len, vocabulary))
        contents = [t.content.encode() for t in added.values()]
        for i, content in zip(added, contents):
            self.id_bytes[i] = len(content)
        setting = json.loads(self.tokenizer.to_str())
        before = setting["pre_tokenizer"] or {}
        # Byte-level vocabularies write visible bytes as themselves, the others as characters from 256 on.
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = count(256)
        self.letters = "".join(chr(b if b in shown else next(hidden)) for b in range(256))
        kinds = bytearray([_OTHER]) * 256
        for kind, members in ((_LETTER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"), (_DIGIT, b"0123456789"),
                              (_MARK, bytes(set(_MARKS) - {c for x in contents for c in x})), (_NEWLINE, b"\n"),
                              (_SPACE, b"\t\x0b\x0c\r\x1c\x1d\x1e\x1f"), (_BLANK, b" ")):
            for c in members:
                kinds[c] = kind
        self.kinds, self.by_words = bytes(kinds), True
        # Words are cut of a byte level with nothing before it and no added token of plain characters.
        self.by_words = (before.get("type") == "ByteLevel" and before.get("use_regex", True)
                         and not before.get("add_prefix_space") and setting["normalizer"] is None
                         and setting["post_processor"] is None and set(self.letters) <= vocabulary.keys()
                         and all((self._kinds(np.frombuffer(x, np.uint8)) == _OTHER).any() for x in contents))
        if self.by_words:
            self.word_tokenizer = Tokenizer(self._uncached(setting["model"]))
            self.word_tokenizer.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(self.letters[0])
        else:  # no byte is of a run: every piece is left whole
            self.kinds = bytes(_OTHER if k <= _MARK else k for k in kinds)
        self.pieces = _Known(self._learn_pieces, pieces)
        self.words = _Known(self._learn_words, words)

    def _uncached(self, setting: dict):
        """The model without a memory of its own, which is of no use to words that come once."""
        from tokenizers import models
        if setting.pop("type") != "BPE":
            return self.tokenizer.model
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in setting.pop("merges")]
        given = {name: value for name, value in setting.items() if value is not None}
        return models.BPE(merges=merges, cache_capacity=0, **given)

    def _learn_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        return np.array([i for x in got for i in x], np.uint32), np.array([len(x) for x in got], np.int64)

    def _learn_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Many words are one input to the library, cut already."""
        raw = [_BETWEEN.join(words[k:k + 1000]).encode() for k in range(0, len(words), 1000)]
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.word_tokenizer.encode_batch_fast(
            [charmap_decode(r, "strict", self.letters)[0] for r in raw], add_special_tokens=False)])
        data = np.frombuffer(b"\0".join(raw) + b"\0", np.uint8)
        ends = np.flatnonzero(data == 0)
        until = np.searchsorted(np.cumsum(self.id_bytes[ids]), ends - np.arange(len(ends)), "right")
        return ids, np.diff(np.r_[0, until])

    def _kinds(self, data: np.ndarray) -> np.ndarray:
        """The kind of each byte of UTF-8; all bytes of a character have its kind."""
        kind = np.frombuffer(data.tobytes().translate(self.kinds), np.uint8)
        lead = np.flatnonzero(data >= 0xC2)
        if not len(lead):
            return kind
        kind = kind.copy()
        a, b = data[lead], data[np.minimum(lead + 1, len(data) - 1)]
        if self.by_words:  # U+00C0 to U+024F without the signs of multiplication and division
            latin = lead[(b >= 0x80) & (b < 0xC0) & (a >= 0xC3) & ((a < 0xC9) | (a == 0xC9) & (b < 0x90))
                         & ~((a == 0xC3) & ((b == 0x97) | (b == 0xB7)))]
            kind[latin] = kind[latin + 1] = _LETTER
        space = lead[(a == 0xC2) & ((b == 0x85) | (b == 0xA0))]
        kind[space] = kind[space + 1] = _SPACE
        wide = lead[(a >= 0xE1) & (a <= 0xE3) & ((b == 0x80) | (b == 0x81) | (b == 0x9A))]
        wide = wide[wide + 2 < len(data)]
        code = data[wide].astype(np.int64) << 16 | data[wide + 1].astype(np.int64) << 8 | data[wide + 2]
        space = wide[np.isin(code, _WIDE_SPACE)]
        kind[space] = kind[space + 1] = kind[space + 2] = _SPACE
        return kind

    def _cuts(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where words and whole pieces of the texts begin, and which are whole pieces.
        Both can be encoded alone: the pre-tokenizer always cuts there."""
        n = len(data)
        kind = self._kinds(data)
        edge = np.zeros(n + 1, bool)  # a text begins, or the last one has ended
        edge[at] = True
        white, run = kind >= _NEWLINE, kind <= _MARK
        blank = kind == _BLANK
        clean = blank & ~edge[:-1] & ~edge[1:]  # between two characters that are not white space
        clean[1:] &= ~white[:-1]
        clean[:-1] &= ~white[1:]
        odd = ~run & ~clean
        line = np.flatnonzero(kind == _NEWLINE)
        line = line[run[line - 1] & run[np.minimum(line + 1, n - 1)] & ~edge[line] & ~edge[line + 1]]
        odd[line] = False  # a newline between two runs is a word
        cut = edge[:-1].copy()
        cut[1:] |= (kind[1:] != kind[:-1]) & ~blank[:-1]
        cuts = np.flatnonzero(cut)
        odd = np.flatnonzero(odd)
        if not len(odd):
            return cuts, np.zeros(len(cuts), bool)
        first = (clean | edge[:-1])[cuts]  # a piece begins
        pieces = cuts[first]
        whole = np.zeros(len(pieces), bool)
        whole[np.searchsorted(pieces, odd, "right") - 1] = True
        whole = whole[np.cumsum(first) - 1]
        keep = first | ~whole
        return cuts[keep], whole[keep]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, END_ID after each, and their counts."""
        return self.encode_bytes(*bytes_of(pa.array(texts, pa.large_string())))

    def encode_bytes(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of texts in UTF-8, text k from at[k] to at[k + 1]; each distinct word is looked up once."""
        if not len(data):
            return np.full(len(at) - 1, END_ID, np.uint32), np.ones(len(at) - 1, np.int64)
        cuts, whole = self._cuts(data, at)
        strings = pa.Array.from_buffers(pa.large_string(), len(cuts), [
            None, pa.py_buffer(np.append(cuts, len(data))), pa.py_buffer(data)])
        coded = strings.dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        index = coded.indices.to_numpy()
        uses = np.bincount(index, minlength=len(names))
        is_piece = np.zeros(len(names), bool)
        is_piece[index[whole]] = True
        # The ids of this step's words, of its pieces and of a text's end, one after the other.
        ids, size = self.words.ids(list(compress(names, (~is_piece).tolist())), uses[~is_piece])
        piece_ids, piece_size = self.pieces.ids(list(compress(names, is_piece.tolist())), uses[is_piece])
        ids, size = np.r_[ids, piece_ids, np.uint32(END_ID)], np.r_[size, piece_size, 1]
        place = np.empty(len(names), np.int64)
        place[~is_piece] = np.arange(len(names) - len(piece_size))
        place[is_piece] = np.arange(len(names) - len(piece_size), len(names))
        until = np.searchsorted(cuts, at[1:])
        pick = np.insert(place[index], until, len(names))
        start, size = (np.cumsum(size) - size)[pick], size[pick]
        counts = np.cumsum(size)[until + np.arange(len(until))]
        return ids[spans(start, size)], np.diff(counts, prepend=0)


_ENCODERS: dict[str, PieceEncoder] = {}


def _tokens(path: str):
    def steps(encoder: PieceEncoder, batches: Iterator[pa.RecordBatch], total: _Totals) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, at in text_slices(batch.column(1), STEP):
                ids, counts = encoder.encode_bytes(data, at)
                total.add(ids)
                wide = 4 if ids.max() > 0xFFFF else 2
                until = np.append(0, np.cumsum(wide * counts))
                if until[-1] > 0x7FFFFFFF:
                    raise OverflowError(f"a text of {len(ids)} ids does not fit a row")
                raw = pa.py_buffer(ids.astype(f"<u{wide}"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.full(hi - lo, wide, np.int32)),
                     pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(until.astype(np.int32)), raw]),
                     pa.nulls(hi - lo, pa.binary())],
                    ["doc_id", "width", "ids", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.setdefault(path, None) or PieceEncoder(path)
        _ENCODERS[path] = encoder
        total, last = _Totals(), None
        for step in steps(encoder, batches, total):
            if last is not None:
                yield last
            last = step
        if last is not None:
            # The task's last row carries how often it met each id.
            have = np.flatnonzero(total.n)
            seen = np.c_[have, total.n[have]].astype("<i8").tobytes()
            counts = pa.array([None] * (len(last) - 1) + [seen], pa.binary())
            yield pa.RecordBatch.from_arrays([*last.columns[:3], counts], last.schema.names)
    return run


class _Totals:
    """How often each id was met."""

    def __init__(self):
        self.n = np.zeros(1, np.int64)

    def add(self, ids: np.ndarray) -> None:
        got = np.bincount(ids)
        if len(got) > len(self.n):
            self.n, got = got, self.n
        self.n[:len(got)] += got


def _ids(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, "<u4" if width == 4 else "<u2")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            id_, n = np.frombuffer(raw, "<i8").reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([pa.array(id_), pa.array(n)], ["id", "n"])


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most `limit` bits by package-merge; 0 for ids
    that do not occur."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        out[used] = 1
        return out
    limit = max(limit, int(len(used) - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(limit):
        both = np.r_[leaves, packages]
        rank = np.argsort(both, kind="stable")
        levels.append(rank < len(leaves))
        both = both[rank]
        packages = both[:len(both) // 2 * 2].reshape(-1, 2).sum(1)
    take, length = 2 * len(leaves) - 2, np.zeros(len(leaves), np.uint8)
    for leaf in reversed(levels):
        here = int(leaf[:take].sum())
        length[:here] += 1
        take = 2 * (take - here)
    out[order] = length
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in the order of length and id."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        size = lengths[order].astype(np.int64)
        step = 1 << (int(size.max()) - size)
        first = np.cumsum(step) - step
        codes[order] = (first >> (int(size.max()) - size)).astype(np.uint64)
    return codes


def pack(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Bit offsets of every STRIDE-th id and the code bits, most significant
    first, padded to 32-bit words with one word to spare."""
    if not len(ids):
        return np.zeros(0, np.int64), b""
    size = lengths[ids].astype(np.int64)
    at = np.cumsum(size) - size
    word = at >> 5
    value = codes[ids] << (64 - (at & 31) - size).astype(np.uint64)
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    out = np.zeros(int(word[-1]) + 3, np.uint64)
    out[word[first]] = np.add.reduceat(value >> np.uint64(32), first)
    out[word[first] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
    return at[::STRIDE], out.astype(">u4").tobytes()


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Id and code length for every value of the next `bits` bits."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    bits = int(lengths.max()) if len(lengths) else 0
    size = lengths[order].astype(np.int64)
    step = 1 << (bits - size)
    pad = max(0, (1 << bits) - int(step.sum()))
    ids = np.r_[np.repeat(order, step), np.zeros(pad, np.int64)]
    return ids.astype(np.uint32), np.r_[np.repeat(size, step), np.ones(pad, np.int64)], bits


def unpack(payload: bytes, offsets: np.ndarray, n: int, table) -> np.ndarray:
    ids, size, bits = table
    if not n:
        return np.zeros(0, np.uint32)
    words = np.frombuffer(payload, ">u4").astype(np.uint64)
    pair = words[:-1] << np.uint64(32) | words[1:]
    at = offsets.astype(np.int64)
    out = np.zeros((len(at), STRIDE), np.uint32)
    top = np.uint64(64 - bits)
    last = len(pair) - 1
    for k in range(STRIDE):
        word = np.minimum(at >> 5, last)  # past the end only in the last stride
        look = ((pair[word] << (at & 31).astype(np.uint64)) >> top).astype(np.int64)
        out[:, k] = ids[look]
        at += size[look]
    return out.ravel()[:n]


def _blocks(lengths: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = canonical(lengths)
        part, block, before = TaskContext.get().partitionId(), 0, 0
        docs: list = []
        held: list[np.ndarray] = []
        n = 0

        def row():
            ids = np.concatenate(held)
            offsets, payload = pack(ids, lengths, codes)
            return pa.RecordBatch.from_pylist([{
                "part": part, "block": block, "before": before, "n_ids": len(ids), "doc_ids": docs,
                "doc_sizes": [len(x) for x in held], "offsets": offsets.tolist(), "payload": payload}],
                schema=_BLOCK_ARROW)

        for batch in batches:
            for doc, width, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                ids = _ids(raw, width)
                if held and n + len(ids) > BLOCK_IDS:
                    yield row()
                    block, before, docs, held, n = block + 1, before + n, [], [], 0
                docs.append(doc)
                held.append(ids)
                n += len(ids)
        if held:
            yield row()
    return run


_BLOCK_ARROW = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("doc_sizes", pa.list_(pa.int64())),
    ("offsets", pa.list_(pa.int64())), ("payload", pa.binary())])
BLOCK_SCHEMA = ("part int, block int, before long, n_ids long, doc_ids array<long>, "
                "doc_sizes array<long>, offsets array<long>, payload binary")


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, width, ids, counts) of every row: its ids, END_ID after them, as
    little-endian integers of `width` bytes. One row of each task has the counts
    of the ids of all its rows, pairs of 8-byte integers; in the others they are null.
    `tokenizer` is a path that the executors can read."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return in_arrow(rows, _tokens(tokenizer), "doc_id long, width int, ids binary, counts binary",
                    release=False)


def write_files(tokens: DataFrame, path: str) -> None:
    """Write the ids of `tokens` (as :func:`encode_documents` gives them) in ascending doc_id order
    under `path`: blocks in `path`/blocks, code lengths in `path`/lengths."""
    spark = tokens.sparkSession
    got = (in_arrow(tokens.select("counts").filter("counts is not null"), _counts, "id long, n long")
           .groupBy("id").agg(F.sum("n").alias("n")).toArrow())  # at most a row for each id of the vocabulary
    ids, n = got["id"].to_numpy(), got["n"].to_numpy()
    counts = np.zeros(int(ids.max()) + 1 if len(ids) else 0, np.int64)
    counts[ids] = n
    lengths = code_lengths(counts)
    have = np.flatnonzero(lengths)
    spark.createDataFrame(pa.table({"id": have.astype(np.int64), "bits": lengths[have].astype(np.int32)})
                          ).write.parquet(f"{path}/lengths")
    ordered = tokens.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    in_arrow(ordered.select("doc_id", "width", "ids"), _blocks(lengths), BLOCK_SCHEMA).write.parquet(f"{path}/blocks")


def _read_blocks(lengths: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decode_table(lengths)
        for batch in batches:
            for i in range(len(batch)):
                r = {k: batch.column(k)[i] for k in batch.schema.names}
                ids = unpack(r["payload"].as_py(), r["offsets"].values.to_numpy(), r["n_ids"].as_py(), table)
                size = r["doc_sizes"].values.to_numpy()
                end = np.cumsum(size)
                raw = memoryview(ids.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [r["doc_ids"].values, pa.array(r["before"].as_py() + end - size), pa.array(size),
                     pa.array([raw[4 * (e - s):4 * e].tobytes() for s, e in zip(size, end)], pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"])
    return run


def _with_crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crc = [zlib.crc32(x) for x in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, pa.int64())],
                                         [*batch.schema.names[:3], "ids_crc32"])


def read_files(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document of the files; with
    `digest`, ids_crc32 in place of the ids (little-endian, 4 bytes each)."""
    code = spark.read.schema("id long, bits int").parquet(f"{path}/lengths").toArrow()
    ids = code["id"].to_numpy()
    lengths = np.zeros(int(ids.max()) + 1 if len(ids) else 0, np.uint8)
    lengths[ids] = code["bits"].to_numpy()
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    # Ids in front of each part: one row for each write task.
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    total, rows = 0, []
    for part, n in sorted((r["part"], r["n"]) for r in parts):
        rows.append((part, total))
        total += n
    front = spark.createDataFrame(rows, "part int, front long")
    placed = (blocks.join(F.broadcast(front), "part")
              .select((F.col("before") + F.col("front")).alias("before"), "n_ids", "doc_ids", "doc_sizes",
                      "offsets", "payload"))
    function = _read_blocks(lengths)
    if digest:
        return in_arrow(placed, lambda it: _with_crc(function(it)),
                        "doc_id long, start long, n_tokens long, ids_crc32 long")
    return in_arrow(placed, function, "doc_id long, start long, n_tokens long, ids binary")


def round_trip(docs: DataFrame, tokenizer: str, path: str | None = None, digest: bool = True) -> DataFrame:
    """Encode `docs`, write the files (in the shared folder if no `path` is
    given), and return what reading them back gives."""
    spark = docs.sparkSession
    path = path or shared_path(spark, "token-files")
    tokens = stored(encode_documents(docs, tokenizer), "token-ids")
    write_files(tokens, path)
    return read_files(spark, path, digest)
