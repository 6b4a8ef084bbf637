"""SentencePiece encoding and decoding with a batched numpy Viterbi.

The model file (pieces, scores, types) is read from its protocol-buffer bytes.
A text is the sequence of its characters with blanks as U+2581, one put in front;
its encoding is the sequence of pieces with the greatest sum of scores.
No piece of such a model has a blank after another character, so the words
between blanks are encoded alone, each distinct word once while a worker
remembers it (in two generations, so that a full memory forgets only what was not
used lately). Words of equal length advance together: hashes of all substrings
that end at a position are looked up in the sorted keys of the pieces, and
vectorised maxima over the candidates keep the best score and its piece. Of equal
sums the one with the longest last piece wins. A character that no piece covers
is written as its UTF-8 bytes where the model has byte pieces, else as <unk>.

Scores. A Unigram model's scores are used as they are. In a BPE model a score
is only the rank of a merge, no log-probability, and the best sum of ranks
is no sensible encoding: these models get the log-probabilities of a
Zipf-Mandelbrot law of the rank instead. (So their ids are those of a Unigram
model of the same pieces, not those of merging.)

Null and empty texts have no pieces. U+2581 in a text reads as a blank, also
after decoding, as with the library; every other text is restored exactly where
the model has byte pieces. Repeated rows count each.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, mix64

BLANK = "▁"
#: Longer words go piece by piece through a dictionary (the same maxima).
LONGEST = 48
#: Words that a worker remembers at most, in two generations.
CACHE_WORDS = 3 << 18
#: Leading bits of a piece's key that say where to look among the sorted keys.
_LEAD = 20
_BARE = "\0"
STEP = 1 << 18
# Fixed values of the file format: piece types, and how far below the least
# score an unknown character lies.
NORMAL, UNKNOWN, BYTE = 1, 2, 6
UNKNOWN_PENALTY = np.float32(10)
_UNIGRAM = 1
_BASE = np.uint64(0x9E6C63D0876A9A47)


def _fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = raw[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            size = varint()
            yield key >> 3, raw[at:at + size]
            at += size
        else:
            size = 4 if kind == 5 else 8
            yield key >> 3, struct.unpack("<f" if size == 4 else "<d", raw[at:at + size])[0]
            at += size


def rank_scores(scores: np.ndarray) -> np.ndarray:
    """Log-probabilities by a Zipf-Mandelbrot law of the scores' ranks."""
    order = np.argsort(-scores, kind="stable")
    rank = np.empty(len(scores))
    rank[order] = np.arange(len(scores))
    weight = 1 / (rank + 2.7)
    return np.log(weight / weight.sum()).astype(np.float32)


class Known:
    """Ids of words: one generation of a worker's memory."""

    def __init__(self) -> None:
        self.words: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.end = np.zeros(1 << 14, np.int64)   # ends of the words' ids; place 0 is no word
        self.filled = 0

    def add(self, words: list[str], ids: np.ndarray, count: np.ndarray) -> None:
        known = len(self.words) + 1
        self.words.update(zip(words, range(known, known + len(words))))
        while self.filled + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, self.flat])
        while known + len(words) > len(self.end):
            self.end = np.concatenate([self.end, self.end])
        self.flat[self.filled:self.filled + len(ids)] = ids
        self.end[known:known + len(words)] = self.filled + np.cumsum(count)
        self.filled += len(ids)

    def get(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words at these places, and how many each has."""
        size = self.end[at] - self.end[at - 1]
        until = np.cumsum(size)
        total = int(until[-1]) if len(until) else 0
        return self.flat[np.repeat(self.end[at] - until, size) + np.arange(total)], size


class PieceModel:
    """Pieces of a model file, and the encoder over them."""

    def __init__(self, path: str):
        pieces, kinds, scores = [], [], []
        self.prefix, model_type = True, _UNIGRAM
        with open(path, "rb") as file:
            raw = file.read()
        for number, value in _fields(raw):
            if number == 1:
                got = dict(_fields(value))
                pieces.append(got.get(1, b"").decode())
                scores.append(got.get(2, 0.0))
                kinds.append(got.get(3, NORMAL))
            elif number == 2:
                model_type = dict(_fields(value)).get(3, _UNIGRAM)
            elif number == 3:
                rules = dict(_fields(value))
                self.prefix = bool(rules.get(3, 1))
                if rules.get(2) or rules.get(1, b"identity") != b"identity" or rules.get(4, 1) or not rules.get(5, 1):
                    raise ValueError("only models that keep texts as they are can be used")
        kinds = np.array(kinds)
        self.pieces = pieces
        self.ids = np.flatnonzero(kinds == NORMAL)
        if any(BLANK in pieces[i].lstrip(BLANK) for i in self.ids):
            raise ValueError("a piece has a blank after another character")
        own = np.array(scores, np.float32)[self.ids]
        self.scores = own if model_type == _UNIGRAM else rank_scores(own)
        self.unknown_score = np.float32(self.scores.min() - UNKNOWN_PENALTY)
        self.unknown = int(np.flatnonzero(kinds == UNKNOWN)[0])
        byte = np.flatnonzero(kinds == BYTE)
        self.byte_ids = byte[np.argsort([int(pieces[i][1:-1], 16) for i in byte])] if len(byte) == 256 else None
        # What an id decodes to.
        self.output = [p.encode() if k == NORMAL else bytes([int(p[1:-1], 16)]) if k == BYTE else
                       " ⁇ ".encode() if k == UNKNOWN else b"" for p, k in zip(pieces, kinds)]
        self.longest = max(len(pieces[i]) for i in self.ids)
        self.place = {pieces[i]: k for k, i in enumerate(self.ids)}
        keys = np.array([self._key(p) for p in self.place], np.uint64)
        order = np.argsort(keys)
        # Where the keys of the same leading bits begin; a run of keys that no piece
        # has ends the sorted ones.
        self.shift = np.uint64(64 - _LEAD)
        lead = (keys[order] >> self.shift).astype(np.int64)
        self.first = np.searchsorted(lead, np.arange(1 << _LEAD)).astype(np.int32)
        self.run = int(np.bincount(lead).max()) if len(lead) else 1
        beyond = np.full(self.run, keys[order[-1]] if len(order) else 0, np.uint64)
        self.keys, self.at = np.r_[keys[order], beyond], np.r_[order, np.repeat(order[-1:], self.run)]
        self.key_scores = self.scores[self.at]
        self.clear()

    @staticmethod
    def _key(text: str) -> int:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)[None]
        return int(_prefix(codes)[0, -1])

    def clear(self) -> None:
        self.young, self.old = Known(), Known()

    def _probe(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is a piece's, and its place among the sorted keys."""
        at = self.first[(key >> self.shift).astype(np.int64)]
        hit = self.keys[at] == key
        for step in range(1, self.run):
            more = self.keys[at + step] == key
            at = np.where(more, at + step, at)
            hit |= more
        return hit, at

    def viterbi(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Best pieces of words of one length, one after another, and how many each
        word has: places in `self.ids`, or minus 1 minus the character's position
        for an unknown character."""
        n, length = len(words), len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, length)
        until = _prefix(codes.astype(np.uint64))
        best = np.zeros((n, length + 1), np.float32)
        back = np.zeros((n, length + 1), np.int64)
        piece = np.zeros((n, length + 1), np.int64)
        power = np.cumprod(np.full(self.longest + 1, _BASE, np.uint64))
        row = np.arange(n)
        for j in range(1, length + 1):
            most = min(j, self.longest)
            # Pieces that begin at j - most, ..., j - 1: the first of equal maxima is the longest.
            hit, at = self._probe(until[:, j, None] - until[:, j - most:j] * power[most - 1::-1])
            score = best[:, j - most:j] + np.where(hit, self.key_scores[at], np.float32(-np.inf))
            lone = ~hit[:, -1]
            score[lone, -1] = best[lone, j - 1] + self.unknown_score
            pick = score.argmax(1)
            best[:, j] = score[row, pick]
            back[:, j] = j - most + pick
            piece[:, j] = np.where((pick == most - 1) & lone, -j, self.at[at[row, pick]])
        rows, pieces, at = [], [], np.full(n, length)
        while len(row):
            rows.append(row)
            pieces.append(piece[row, at[row]])
            at[row] = back[row, at[row]]
            row = row[at[row] > 0]
        # Found from the last piece to the first.
        rows, pieces = np.concatenate(rows[::-1]), np.concatenate(pieces[::-1])
        order = np.argsort(rows, kind="stable")
        return pieces[order], np.bincount(rows, minlength=n)

    def one_by_one(self, word: str) -> list[int]:
        """The same for one long word."""
        best, back = [np.float32(0)], [(0, 0)]
        for j in range(1, len(word) + 1):
            top, way = None, None
            for size in range(min(j, self.longest), 0, -1):
                p = self.place.get(word[j - size:j])
                if p is None and size > 1:
                    continue
                score = best[j - size] + (self.scores[p] if p is not None else self.unknown_score)
                if top is None or score > top:
                    top, way = score, (size, p if p is not None else -j)
            best.append(top)
            back.append(way)
        out, j = [], len(word)
        while j:
            out.append(back[j][1])
            j -= back[j][0]
        return out[::-1]

    def _learn(self, words: list[str]) -> None:
        """Encode words (as `split` gives them) and remember their ids."""
        by_size: dict[int, list[str]] = {}
        for w in words:
            by_size.setdefault(len(w), []).append(w)
        for length, group in by_size.items():
            step = max(1, (1 << 20) // (length * length))
            for k in range(0, len(group), step):
                part = group[k:k + step]
                full = [self.whole(w) for w in part]
                if length >= LONGEST:
                    got = [self.one_by_one(w) for w in full]
                    places, count = np.array([p for g in got for p in g], np.int64), np.array([len(g) for g in got])
                else:
                    # A word at the start of a text may lack the blank that others have.
                    places, count = self.viterbi(full) if len({len(w) for w in full}) == 1 else self._mixed(full)
                self._remember(part, full, places, count)

    def _mixed(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [self.viterbi([w]) for w in words]
        return np.concatenate([g[0] for g in got]), np.array([len(g[0]) for g in got])

    def _remember(self, keys: list[str], words: list[str], places: np.ndarray, count: np.ndarray) -> None:
        ids = self.ids[np.maximum(places, 0)].astype(np.int32)
        lost = np.flatnonzero(places < 0)
        if len(lost) and self.byte_ids is None:
            ids[lost] = self.unknown
        elif len(lost):  # a character that no piece covers becomes its bytes
            owner = np.repeat(np.arange(len(words)), count)
            spelt = [self.byte_ids[list(words[owner[i]][-places[i] - 1].encode("utf-8", "surrogatepass"))] for i in lost]
            size = np.ones(len(places), np.int64)
            size[lost] = [len(x) for x in spelt]
            start = np.cumsum(size) - size
            wide = np.repeat(ids, size)
            for i, x in zip(lost, spelt):
                wide[start[i]:start[i] + len(x)] = x
            ids, count = wide, np.bincount(owner, size, len(words)).astype(np.int64)
        self.young.add(keys, ids, count)

    def whole(self, key: str) -> str:
        """The word that a key of `split` stands for."""
        return key[1:] if key[0] == _BARE else BLANK + key

    def split(self, text: str) -> list[str]:
        """Words, each with the blanks in front of it, as keys: the first blank is
        left out, and a word without one has a mark in front."""
        if not text:
            return []
        text = text.replace(BLANK, " ")
        parts, blanks = text.split(" "), ""
        out = []
        if not self.prefix:
            if parts[0]:
                out.append(_BARE + parts[0])
            del parts[0]
        if all(parts) and _BARE not in text:
            return out + parts
        for part in parts:
            blanks += BLANK
            if part:
                out.append((blanks + part)[1:] if blanks != BLANK or part[0] != _BARE else _BARE + BLANK + part)
                blanks = ""
        if blanks:
            out.append(blanks[1:] or _BARE + BLANK)
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and their counts. What the last words had in common
        with the older generation moves to the younger; when that is full it becomes
        the older one, so common words are not learned again."""
        if len(self.young.words) > CACHE_WORDS // 2:
            self.young, self.old = Known(), self.young
        cut = [self.split(t) for t in texts]
        new = set().union(*cut).difference(self.young.words)
        if new:
            again = [w for w in new if w in self.old.words]
            if again:
                self.young.add(again, *self.old.get(np.array([self.old.words[w] for w in again], np.int64)))
            fresh = list(new.difference(again))
            if fresh:
                self._learn(fresh)
        at = np.fromiter(map(self.young.words.__getitem__, chain.from_iterable(cut)), np.int64, sum(map(len, cut)))
        ids, size = self.young.get(at)
        count = np.r_[0, np.cumsum(size)][np.cumsum([len(c) for c in cut])]
        return ids, np.diff(np.r_[0, count])

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.output.__getitem__, ids)).decode("utf-8", "replace").replace(BLANK, " ")
        return text[1:] if self.prefix and text[:1] == " " else text


def _prefix(codes: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes of each row, the empty one first."""
    out = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
    symbol = mix64(codes + np.uint64(1))
    for j in range(codes.shape[1]):
        out[:, j + 1] = out[:, j] * _BASE + symbol[:, j]
    return out


_MODELS: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and size < STEP:
                    size += len(texts[hi])
                    hi += 1
                ids, count = own.encode(texts[lo:hi])
                rows = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count)], pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(lo, hi - lo) for c in batch.columns[:-1]), pa.array(count, pa.int64()), rows],
                    [*batch.schema.names[:-1], "n_pieces", "ids"])
                lo = hi
    return run


def encode(docs: DataFrame, model_file: str, keep: list[str]) -> DataFrame:
    """Columns `keep` of `docs` with n_pieces and ids (array of int) of its
    text. `model_file` is a path that the executors can read."""
    rows = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return in_arrow(rows, _encode(model_file), f"{kept}, n_pieces long, ids array<int>")


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for lo in range(0, len(batch), 200):
                part = column.slice(lo, 200)
                texts = [own.decode(x.values.to_numpy(zero_copy_only=False).tolist()) if x.values is not None else ""
                         for x in part]
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, 200) for c in batch.columns), pa.array(texts, pa.string())],
                                                 [*batch.schema.names, "decoded"])
    return run


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """`encoded` with `decoded`, the text of its last column, the ids."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return in_arrow(encoded, _decode(model_file), f"{schema}, decoded string")


def round_trip(docs: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, n_pieces, ids, n_chars, decoded_sha256) of every row: its
    pieces, and the length and SHA-256 of the text that they decode to."""
    coded = decode(encode(docs, model_file, ["doc_id"]), model_file)
    return coded.select("doc_id", "n_pieces", "ids", F.char_length("decoded").cast("long").alias("n_chars"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
