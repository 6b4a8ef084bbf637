"""Near-duplicate documents by HyperMinHash.

A document's set holds its distinct word shingles. Their 64-bit hashes fall
into REGISTERS buckets by the top bits; each bucket keeps one byte for its
least hash: the count of leading zeros (4 bits) and the next 4 bits after the
first one. A bucket that no shingle falls into takes the register of the
occupied bucket that a fixed random ranking puts first for it. Bands of
ROWS registers are the join keys: two sets of similarity 0.8 agree in no band
with a probability of (1 - 0.8**8)**64, below 1e-5.

Documents of equal sets are one class from the start. Of the pairs of classes
that a band proposes, those whose sizes rule out the threshold go first, then
those whose collision-corrected register estimate lies below it by over five
standard deviations; the rest is confirmed on the full sets.

A band that many classes share does not become all its pairs. Where its pairs
are few they are all proposed; otherwise its members are compared with a few
hubs first, and what is then in one component needs no further link. Bands that
still join different components are settled in tiles of at most 2 * TILE members:
a task compares the registers of members of different components (each pair
in the first band that it agrees in) in steps of PAIRS, confirms a step's likely
ones on their full sets, most alike first, while they are not yet connected, and
returns only links that connect: no list of all pairs of a tile is made. So the
rows that move stay in proportion to the members of bands, and no link that would
join two components is left out by any limit.

Nulls, empty texts: empty set, linked with nothing. Rows of equal doc_id count
as copies of one document. A null doc_id is linked with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (LOWER, bytes_of, forget, in_arrow, in_groups, mix64, seeded, shingle_hashes, sorted_sets,
                     span_hashes, stored, text_slices, word_spans)
from .components import components

REGISTERS, ROWS = 512, 8
BANDS = REGISTERS // ROWS
_SHIFT = np.uint64(64 - int(np.log2(REGISTERS)))
#: An estimate this far below the threshold rules a pair out: over five
#: standard deviations of a mean of 512 registers at 0.8, 0.0177 each.
MARGIN = 0.1
#: A band with at most so many pairs for each member has all of them compared.
PAIRS_A_MEMBER = 4
TILE = 1024
#: Pairs whose registers are compared in one step.
PAIRS = 2000
#: Bytes of text in one step of the sketches, and of texts whose sets are compared in one step.
SKETCH_BYTES, CONFIRM_BYTES = 1 << 18, 1 << 22

# Ranking of donor buckets for each empty bucket.
_RANK = mix64(np.arange(REGISTERS * REGISTERS, dtype=np.uint64) + np.uint64(1 << 40)).reshape(
    REGISTERS, REGISTERS)
DONORS = 24
#: Sets whose empty buckets are filled in one step.
DONOR_ROWS = 128
_DONOR = np.argsort(_RANK, axis=1)[:, :DONORS]


def shingle_sets(column: pa.Array, shingle: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, hashes, owners) of the distinct shingles
    of the lower-cased texts, in the order of owner and hash."""
    for lo, hi, data, at in text_slices(column, SKETCH_BYTES):
        data = LOWER[data]
        start, end, doc = word_spans(data, at)
        hashes, owner = shingle_hashes(span_hashes(data, start, end), doc, shingle)
        yield lo, hi, *sorted_sets(hashes, owner)


def registers(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """n rows of one-byte registers for sets given as sorted (owner, hash)."""
    bucket = (hashes >> _SHIFT).astype(np.int64)
    cell = owner * REGISTERS + bucket
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, int)
    rest = hashes[first] << np.uint64(64 - int(_SHIFT)) | np.uint64(1)
    zeros = np.minimum(64 - np.frexp(rest.astype(np.float64))[1], 15).astype(np.uint64)
    after = rest << (zeros + np.uint64(1)) >> np.uint64(60)
    out = np.zeros((n, REGISTERS), np.uint8)
    out.ravel()[cell[first]] = (zeros << np.uint64(4) | after).astype(np.uint8)
    filled = np.zeros((n, REGISTERS), bool)
    filled.ravel()[cell[first]] = True
    # Down the ranking of donors for all empty buckets of some rows at once (short texts leave
    # nearly all of them empty); what is then left belongs to sets of few shingles, which look at
    # all of their own.
    for lo in range(0, n, DONOR_ROWS):
        part, full = out[lo:lo + DONOR_ROWS], filled[lo:lo + DONOR_ROWS]
        d, none = np.nonzero(~full & full.any(1)[:, None])
        for step in range(DONORS):
            donor = _DONOR[none, step]
            hit = full[d, donor]
            part[d[hit], none[hit]] = part[d[hit], donor[hit]]
            d, none = d[~hit], none[~hit]
        for row in np.unique(d):
            have, lack = np.flatnonzero(full[row]), none[d == row]
            part[row, lack] = part[row, have[_RANK[np.ix_(lack, have)].argmin(1)]]
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """(rows, BANDS) keys; a band's number is part of its key."""
    words = np.ascontiguousarray(regs).view(np.uint64).reshape(len(regs), BANDS)
    return mix64(words * np.uint64(0x9FB21C651E98DF25) + seeded(BANDS, 5))


def collision_rate(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Chance that a bucket of a set of n and one of a set of m shingles hold
    equal registers for different least hashes."""
    edges = [0.0]
    for zeros in range(15, -1, -1):
        low = 0.0 if zeros == 15 else 2.0 ** -(zeros + 1)
        high = 2.0 ** -15 if zeros == 15 else 2.0 ** -zeros
        edges += list(low + (high - low) * np.arange(1, 17) / 16)
    x = np.array(edges)

    def chance(size):
        load = np.maximum(np.asarray(size, float), 1)[:, None] / REGISTERS
        tail = np.exp(-load * x)
        return (tail[:, :-1] - tail[:, 1:]) / (1 - np.exp(-load))

    return (chance(n) * chance(m)).sum(1)


def _sketch(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, hashes, owner in shingle_sets(batch.column(1), shingle):
                size = np.bincount(owner, minlength=hi - lo).astype(np.int64)
                add = np.zeros(hi - lo, np.uint64)
                xor = np.zeros(hi - lo, np.uint64)
                have = np.flatnonzero(size)
                if len(have):
                    at = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                    add[have] = np.add.reduceat(mix64(hashes + np.uint64(3)), at)
                    xor[have] = np.bitwise_xor.reduceat(mix64(hashes + np.uint64(9)), at)
                regs = registers(hashes, owner, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(size), pa.array(add.view(np.int64)),
                     pa.array(xor.view(np.int64)),
                     pa.array([r.tobytes() for r in regs], pa.binary())],
                    ["doc_id", "n_shingles", "set_sum", "set_xor", "regs"])
    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each band of each set (id, size, regs)."""
    for batch in batches:
        for lo in range(0, len(batch), 4096):
            part = batch.slice(lo, 4096)
            keys = band_keys(bytes_rows(part.column(2)))
            row = pa.array(np.repeat(np.arange(len(part)), BANDS))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), part.column(0).take(row), part.column(1).take(row),
                 pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(part)))], ["band", "id", "size", "no"])


def bytes_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), REGISTERS)


def _estimate(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    chance = collision_rate(na, nb)
    return ((ra == rb).mean(1) - chance) / (1 - chance)


def _likely(threshold: int):
    """Keeps pairs (a, b, na, nb, ra, rb) whose estimate does not rule them out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), PAIRS):
                part = batch.slice(lo, PAIRS)
                estimate = _estimate(bytes_rows(part.column(4)), bytes_rows(part.column(5)),
                                     part.column(2).to_numpy(), part.column(3).to_numpy())
                yield part.select([0, 1]).take(pa.array(np.flatnonzero(estimate >= threshold / 100 - MARGIN)))
    return run


def _sets(texts: pa.Array, shingle: int) -> list[np.ndarray]:
    """The distinct shingles of each text, in the order of their hashes."""
    out = []
    for lo, hi, hashes, owner in shingle_sets(texts, shingle):
        out += np.split(hashes, np.searchsorted(owner, np.arange(1, hi - lo)))
    return out


def _linked(x: np.ndarray, y: np.ndarray, threshold: int) -> bool:
    if not len(x) or not len(y):
        return False
    at = np.searchsorted(x, y)
    both = int((x.take(at, mode="clip") == y).sum())
    return both > 0 and 100 * both >= threshold * (len(x) + len(y) - both)


def _confirm(shingle: int, threshold: int):
    """Keeps pairs (a, b, text_a, text_b) by exact comparison of their sets, in steps
    of CONFIRM_BYTES of text (or one longer pair)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            until = np.cumsum(sum(np.diff(bytes_of(batch.column(k))[1]) for k in (2, 3)))
            lo = 0
            while lo < len(batch):
                before = until[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(until, before + CONFIRM_BYTES, "right")))
                part = batch.slice(lo, hi - lo)
                ids = np.r_[part.column(0).to_numpy(), part.column(1).to_numpy()]
                _, first, which = np.unique(ids, return_index=True, return_inverse=True)
                texts = pa.concat_arrays([part.column(2), part.column(3)]).take(pa.array(first))
                sets = _sets(texts, shingle)
                n = len(part)
                keep = [i for i in range(n) if _linked(sets[which[i]], sets[which[n + i]], threshold)]
                yield part.select([0, 1]).take(pa.array(keep, pa.int64()))
                lo = hi
    return run


def _settle(shingle: int, threshold: int):
    """Within one tile of an open band: links that connect members of
    different components."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("id").combine_chunks()
        ids, size, label = (table[c].to_numpy() for c in ("id", "size", "label"))
        label = label.copy()  # by the links found so far
        side, no = table["side"].to_numpy(), table["no"][0].as_py()
        two = side.min() != side.max()
        regs = bytes_rows(table["regs"].chunk(0))
        keys = band_keys(regs)
        text = table["text"].chunk(0)
        sets: dict[int, np.ndarray] = {}
        held = 0  # bytes of `sets`
        out_a, out_b = [], []
        rows = max(1, (1 << 24) // max(1, BANDS * len(ids)))
        for lo in range(0, len(ids), rows):
            r = np.arange(lo, min(len(ids), lo + rows))
            pair = (label[r][:, None] != label) & (r[:, None] < np.arange(len(ids)))
            pair &= 100 * np.minimum(size[r][:, None], size) >= threshold * np.maximum(size[r][:, None], size)
            if two:
                pair &= side[r][:, None] != side
            i, j = np.nonzero(pair)
            i = r[i]
            for k in range(0, len(i), PAIRS):
                a, b = i[k:k + PAIRS], j[k:k + PAIRS]
                # What earlier links connect needs no further one.
                keep = label[a] != label[b]
                if no:
                    keep &= ~(keys[a, :no] == keys[b, :no]).any(1)
                a, b = a[keep], b[keep]
                estimate = _estimate(regs[a], regs[b], size[a], size[b])
                ok = np.flatnonzero(estimate >= threshold / 100 - MARGIN)
                ok = ok[np.argsort(-estimate[ok], kind="stable")]
                a, b = a[ok], b[ok]
                if held > CONFIRM_BYTES:
                    sets, held = {}, 0
                of = np.array([x for x in np.unique(np.r_[a, b]).tolist() if x not in sets], np.int64)
                sets.update(zip(of.tolist(), _sets(text.take(pa.array(of)), shingle)))
                held += sum(sets[x].nbytes for x in of.tolist())
                for x, y in zip(a.tolist(), b.tolist()):
                    low, high = sorted((label[x], label[y]))
                    if low != high and _linked(sets[x], sets[y], threshold):
                        label[label == high] = low
                        out_a.append(int(ids[x]))
                        out_b.append(int(ids[y]))
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})
    return run


def _first_pairs(buckets: DataFrame, threshold: int) -> DataFrame:
    """All pairs of small bands, pairs with the hub of the others."""
    counted = buckets.select("band", "id", "size", (F.col("n") - 1 <= 2 * PAIRS_A_MEMBER).alias("few"))
    # Combines map-side: a band's members never meet in one task for it.
    hubs = (counted.filter("not few").groupBy("band").agg(F.min(F.struct(F.xxhash64("id"), "id", "size")).alias("h"))
            .select("band", F.col("h.id").alias("hub"), F.col("h.size").alias("hub_size")))
    few = counted.filter("few")
    pairs = (counted.filter("not few").join(hubs, "band").filter("id <> hub")
             .unionByName(few.join(few.select("band", F.col("id").alias("hub"), F.col("size").alias("hub_size")), "band")
                          .filter("id > hub")))
    return (pairs.filter(f"100 * least(size, hub_size) >= {threshold} * greatest(size, hub_size)")
            .select(F.greatest("id", "hub").alias("a"), F.least("id", "hub").alias("b")).distinct())


def _open_bands(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (band, no, id, size, label, n) of the large bands that hold more
    than one component."""
    state = (buckets.filter(F.col("n") - 1 > 2 * PAIRS_A_MEMBER).join(labels, "id", "left")
             .select("band", "no", "id", "size", "n", F.coalesce("component_id", "id").alias("label")))
    split = (state.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"))
             .filter("low < high").select("band"))
    return state.join(split, "band")


def near_duplicates(docs: DataFrame, shingle: int = 5, threshold: int = 80) -> DataFrame:
    """`docs` has doc_id, text. Returns (doc_id, n_shingles, component_id,
    kept) for each document: component_id is the least doc_id that links lead
    to, a link being 100 * intersection >= threshold * union of two sets of
    `shingle`-word shingles; kept marks doc_id = component_id (a null doc_id
    has no component and is kept). Repeated doc_ids give one row, with the
    largest of their sets' sizes."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = stored(in_arrow(docs, _sketch(shingle),
                           "doc_id long, n_shingles long, set_sum long, set_xor long, regs binary"),
                  "minhash-sets")
    linkable = sets.filter("n_shingles > 0 and doc_id is not null")
    classes = linkable.groupBy("n_shingles", "set_sum", "set_xor").agg(F.min("doc_id").alias("first"))
    # One row for each class: its first document's set.
    own = stored(linkable.join(classes, ["n_shingles", "set_sum", "set_xor"])
                 .filter("doc_id = first").dropDuplicates(["doc_id", "set_sum", "set_xor"])
                 .select("doc_id", "n_shingles", "regs"), "minhash-classes")
    own_rows = own.select(F.col("doc_id").alias("id"), F.col("n_shingles").cast("int").alias("size"), "regs")
    bands = in_arrow(own_rows, _bands, "band long, id long, size int, no int")
    shared = bands.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    buckets = stored(bands.join(shared, "band"), "minhash-bands")
    # A row repeated any number of times is one text.
    texts = stored(docs.join(buckets.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi")
                   .withColumn("part", F.sha2("text", 256)).groupBy("doc_id", "part").agg(F.first("text").alias("text"))
                   .drop("part"), "minhash-texts")

    sides = [own.select(F.col("doc_id").alias(x), F.col("n_shingles").alias(f"n{x}"), F.col("regs").alias(f"r{x}"))
             for x in "ab"]
    likely = (_first_pairs(buckets, threshold).join(sides[0], "a").join(sides[1], "b")
              .select("a", "b", "na", "nb", "ra", "rb"))
    likely = stored(in_arrow(likely, _likely(threshold), "a long, b long"), "minhash-likely")
    found = (likely.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
             .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
             .select("a", "b", "ta", "tb"))
    labels = stored(components(in_arrow(found, _confirm(shingle, threshold), "a long, b long")), "minhash-labels")

    open_ = stored(_open_bands(buckets, labels), "minhash-open")
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    own_tile = F.pmod(F.xxhash64("id"), tiles).cast("int")
    placed = (open_.withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1))).withColumn("own", own_tile)
              .select("band", "no", "id", "size", "label", F.least("own", "other").alias("i"),
                      F.greatest("own", "other").alias("j"), F.col("own").alias("side"))
              .join(own_rows.select("id", "regs"), "id")
              .join(texts.select(F.col("doc_id").alias("id"), "text"), "id"))
    more = stored(in_groups(placed.groupBy("band", "i", "j"), _settle(shingle, threshold), "a long, b long"),
                  "minhash-links")
    if not more.isEmpty():
        stars = labels.select(F.col("id").alias("a"), F.col("component_id").alias("b"))
        labels = stored(components(stars.unionByName(more)), "minhash-labels")
    forget(own, buckets, texts, likely, open_, more)
    # A document's component is that of its class.
    member = (linkable.join(classes, ["n_shingles", "set_sum", "set_xor"]).select("doc_id", "first")
              .join(labels.withColumnRenamed("id", "first"), "first", "left")
              .select("doc_id", F.coalesce("component_id", "first").alias("component_id")))
    return (sets.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"))
            .join(member.groupBy("doc_id").agg(F.min("component_id").alias("component_id")), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def keep_firsts(docs: DataFrame, shingle: int = 5, threshold: int = 80) -> DataFrame:
    """The rows of `docs`, all their columns, less near copies of a document of
    smaller doc_id. Of rows that repeat a doc_id one is kept, the same on every run."""
    dropped = near_duplicates(docs, shingle, threshold).filter("not kept").select(F.col("doc_id").alias("_dropped"))
    kept = docs.join(dropped, docs["doc_id"].cast("long") == F.col("_dropped"), "left_anti")
    if docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty():
        return kept
    row = F.struct(*docs.columns)
    named = (kept.filter("doc_id is not null").groupBy(F.col("doc_id").alias("_id"))
             .agg(F.min_by(row, F.xxhash64(*docs.columns)).alias("_row")).select("_row.*"))
    return named.unionByName(kept.filter("doc_id is null"))
