"""Removal of repeated byte strings across documents by sorted suffixes.

A byte is removed if a string of LENGTH bytes that covers it also starts
earlier: in a document of smaller id, or earlier in its own. Strings are judged
on the input.

1. Copies of a whole text: all but the first are removed as a whole.
2. Each window of LENGTH bytes has an anchor, the GRAM-byte string in it of the
   least hash (the leftmost of equals). Equal windows have equal anchors, so only
   windows whose anchor occurs more than once in the corpus are looked at
   further. Consecutive windows of one anchor and the bytes that they cover
   make a context.
3. Equal contexts: all but the first are removed as a whole.
4. First contexts of an anchor that has several are cut from their texts and go
   to shards by anchor; an anchor with more than HOT contexts is dealt over shards of its own. A shard
   sorts the suffixes of its contexts (suffix_sort: induced sorting, in memory),
   and runs of neighbours with a common prefix of LENGTH bytes are its equal
   windows: all but the first are repeats. For hot anchors each shard sends on only
   the first of each, and a grouped minimum finds the first over the shards.

Null texts are empty; texts shorter than LENGTH lose nothing. Repeated rows
count once. Rows of one doc_id and different texts are parts of one document in
the order of their SHA-256. Null doc_ids come before all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, in_arrow, in_groups, release_shuffles, seeded, span_hashes, stored, text_slices
from .suffix_sort import common_prefix, suffix_order

LENGTH, GRAM = 100, 32
SHARD_BYTES = 1 << 20
HOT = 2000
#: Windows that one numpy step works on (its arrays fit a core's cache); places within it fit PLACE_BITS.
STEP, PLACE_BITS = 1 << 17, 24
_OTHER = seeded(256, 23)
_NULL_PLACE = -(1 << 63)


def anchor_runs(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """For concatenated texts (offsets `at`): document, first and last window
    start (in `data`), and anchor hash of each run of windows of one anchor."""
    out = []
    lo = 0
    while lo + LENGTH <= len(data):
        hi = min(len(data), lo + STEP + LENGTH - 1)
        part = data[lo:hi]
        n = len(part) - LENGTH + 1
        gram = span_hashes(part, np.arange(len(part) - GRAM + 1), np.arange(GRAM, len(part) + 1))
        low = np.uint64((1 << PLACE_BITS) - 1)
        least = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)
        width, reach = LENGTH - GRAM + 1, 1
        while 2 * reach <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < width:
            least = np.minimum(least[:len(least) - (width - reach)], least[width - reach:])
        start = np.arange(lo, lo + n)
        a, b = np.searchsorted(at, [lo, lo + n - 1], "right") - 1
        doc = np.repeat(np.arange(a, b + 1), np.diff(np.r_[lo, at[a + 1:b + 1], lo + n]))
        inside = np.flatnonzero(start + LENGTH <= at[doc + 1])
        if len(inside):
            own, anchor = doc[inside], (least[inside] & low).astype(np.int64)
            first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (own[1:] != own[:-1])])
            last = np.r_[first[1:], len(inside)] - 1
            out.append((own[first], start[inside[first]], start[inside[last]], gram[anchor[first]]))
        lo += STEP
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*out))


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, place, part, times): distinct anchors of each text, 2 for more than one run."""
    for batch in batches:
        for lo, hi, data, at in text_slices(batch.column(2)):
            doc, _, _, anchor = anchor_runs(data, at)
            if not len(doc):
                continue
            order = np.lexsort((anchor, doc))
            doc, anchor = doc[order], anchor[order]
            first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])])
            times = np.minimum(np.diff(np.r_[first, len(doc)]), 2)
            row = pa.array(lo + doc[first])
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[first].view(np.int64)), batch.column(0).take(row), batch.column(1).take(row),
                 pa.array(times, pa.int32())], ["anchor", "place", "part", "times"])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (place, part, anchors, text): the contexts of the given anchors, by place and size."""
    for batch in batches:
        wanted = batch.column(2)
        for lo, hi, data, at in text_slices(batch.column(3)):
            doc, first, last, anchor = anchor_runs(data, at)
            keep = np.zeros(len(doc), bool)
            cut = np.searchsorted(doc, np.arange(hi - lo + 1))
            for d in range(hi - lo):
                mine = slice(cut[d], cut[d + 1])
                keep[mine] = np.isin(anchor[mine].view(np.int64), wanted[lo + d].values.to_numpy())
            doc, first, last, anchor = doc[keep], first[keep], last[keep], anchor[keep]
            end = last + LENGTH
            row = pa.array(lo + doc)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(span_hashes(data, first, end).view(np.int64)),
                 pa.array(span_hashes(data, first, end, _OTHER).view(np.int64)), batch.column(0).take(row),
                 batch.column(1).take(row), pa.array(first - at[doc]), pa.array((end - first).astype(np.int64))],
                ["anchor", "c1", "c2", "place", "part", "start", "size"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (place, part, wanted, text): the bytes of the wanted contexts, with where they are dealt to."""
    for batch in batches:
        for lo, hi, data, at in text_slices(batch.column(3)):
            wanted = batch.column(2).slice(lo, hi - lo)
            doc = np.repeat(np.arange(hi - lo), wanted.value_lengths().to_numpy())
            shard, salt, hot, start, size = wanted.flatten().flatten()
            first = at[doc] + start.to_numpy()
            end = first + size.to_numpy()
            raw = data.tobytes()
            row = pa.array(lo + doc)
            yield pa.RecordBatch.from_arrays(
                [shard, salt, hot, batch.column(0).take(row), batch.column(1).take(row), start,
                 pa.array([raw[a:b] for a, b in zip(first.tolist(), end.tolist())], pa.binary())],
                ["shard", "salt", "hot", "place", "part", "start", "bytes"])


def _shard(table: pa.Table) -> pa.Table:
    """Repeated windows of a shard's contexts as ranges of bytes; for hot
    anchors also the first window of each content, with its hashes."""
    # Windows of one text lie in one context each, so those of contexts in order are in order.
    table = table.sort_by([(k, "ascending") for k in ("place", "part", "start")]).combine_chunks()
    hot = table["hot"][0].as_py()
    raw = table["bytes"].chunk(0).to_pylist()
    text = np.frombuffer(b"".join(raw), np.uint8)
    size = np.array([len(x) for x in raw], np.int64)
    at = np.cumsum(size) - size
    start = table["start"].to_numpy()
    context = np.repeat(np.arange(len(raw)), size)
    within = np.arange(len(text)) - at[context]
    order = suffix_order(text)
    order = order[within[order] + LENGTH <= size[context[order]]]  # windows
    new = common_prefix(text, order, LENGTH) < LENGTH
    kind = np.cumsum(new) - 1
    by = np.lexsort((order, kind))
    again = np.r_[False, kind[by][1:] == kind[by][:-1]] if len(by) else np.zeros(0, bool)
    # Windows that repeat, as ranges within their contexts.
    repeat = np.sort(order[by[again]])
    first = np.flatnonzero(np.r_[True, (np.diff(repeat) != 1) | (np.diff(context[repeat]) != 0)]) if len(
        repeat) else np.zeros(0, int)
    last = np.r_[first[1:], len(repeat)] - 1 if len(first) else first
    a, b = repeat[first], repeat[last]
    stop = b + LENGTH
    lead = order[by[~again]] if hot else np.zeros(0, int)
    a, stop = np.r_[a, lead], np.r_[stop, lead + LENGTH]
    opened = np.arange(len(a)) >= len(a) - len(lead)
    row = context[a]
    w1, w2 = np.zeros(len(a), np.uint64), np.zeros(len(a), np.uint64)
    w1[opened], w2[opened] = span_hashes(text, lead, lead + LENGTH), span_hashes(text, lead, lead + LENGTH, _OTHER)
    return pa.table({"place": table["place"].take(pa.array(row)), "part": table["part"].take(pa.array(row)),
                     "start": pa.array(start[row] + within[a]), "stop": pa.array(start[row] + stop - at[row]),
                     "w1": pa.array(w1.view(np.int64)), "w2": pa.array(w2.view(np.int64)), "open": pa.array(opened)})


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["start"], s["stop"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        place, sha, text, ranges = (batch.column(k).to_pylist() for k in range(4))
        spans, kept = [], []
        for t, r in zip(text, ranges):
            merged, data = _merged(r), (t or "").encode()
            digest, at = hashlib.sha256(), 0
            for a, b in merged:
                digest.update(data[at:a])
                at = b
            digest.update(data[at:])
            spans.append([{"start": a, "stop": b} for a, b in merged])
            kept.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), pa.array(kept)],
            ["place", "sha", "spans", "kept_sha256"])


def _placed(docs: DataFrame) -> DataFrame:
    """(place, sha, text) of `docs`; place orders documents, sha the texts of one place."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_PLACE)).alias("place"),
                       F.sha2(text, 256).alias("sha"), text.alias("text"))


def find_repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For `docs` (doc_id, text): a table (place, sha, n_bytes) of all distinct
    rows, and one of the rows that lose bytes: (place, sha, spans,
    kept_sha256), spans being the removed byte ranges."""
    spark = docs.sparkSession
    rows = _placed(docs)
    # Places of several texts. Only their rows need more than the place to be told apart: part is the SHA-256 there
    # and empty elsewhere, so that places of one text, nearly all, carry no hash.
    shared = stored(rows.groupBy("place").agg(F.min("sha").alias("a"), F.max("sha").alias("b")).filter("a <> b")
                    .select("place", F.lit(True).alias("shared")), "suffix-shared")
    part = F.when(F.col("shared"), F.col("sha")).otherwise(F.lit("")).alias("part")
    rows = rows.join(shared, "place", "left").select("place", "sha", part, "text")
    known = rows.groupBy("place", "part", "sha").agg(F.max(F.octet_length("text")).cast("long").alias("n_bytes"))
    firsts = known.groupBy("sha").agg(F.min("place").alias("first"))
    info = stored(known.join(firsts, "sha").select("place", "sha", "part", "n_bytes",
                                                   (F.col("place") > F.col("first")).alias("copy")), "suffix-documents")

    document = ["place", "part"]
    anchors = stored(in_arrow(rows.select(*document, "text"), _anchors,
                              "anchor long, place long, part string, times int"), "suffix-grams")
    often = anchors.groupBy("anchor").agg(F.sum("times").alias("n")).filter("n > 1").select("anchor")
    copies = info.filter("copy").select(*document)
    found = stored(anchors.join(often, "anchor").join(copies, document, "left_anti"), "suffix-anchors")
    forget(anchors)
    release_shuffles(spark)
    # Without the copies many anchors occur only once.
    often = found.groupBy("anchor").agg(F.sum("times").alias("n")).filter("n > 1").select("anchor")
    wanted = found.join(often, "anchor").groupBy(*document).agg(F.collect_set("anchor").alias("anchors"))
    # Repeated rows are dropped before the shuffle and after it.
    texts = (rows.filter(F.octet_length("text") >= LENGTH).dropDuplicates(document).join(wanted, document))
    texts = stored(texts.select("place", "sha", "part", "anchors", "text"), "suffix-texts")
    forget(found, shared)
    release_shuffles(spark)
    # Contexts by place and size only: their bytes are most of them, and are wanted of few.
    contexts = stored(in_arrow(texts.select("place", "part", "anchors", "text"), _contexts,
                               "anchor long, c1 long, c2 long, place long, part string, start long, size long"),
                      "suffix-contexts")

    content, window = ["anchor", "c1", "c2"], [*document, "start"]
    elsewhere = "place <> lead.place or part <> lead.part or start <> lead.start"
    lead = stored(contexts.groupBy(content).agg(F.min(F.struct(*window)).alias("lead"), F.max("size").alias("size")),
                  "suffix-leads")
    release_shuffles(spark)
    again = stored(contexts.join(lead.select(*content, "lead"), content).filter(elsewhere)
                   .select(*window, (F.col("start") + F.col("size")).alias("stop")), "suffix-again")
    forget(contexts)
    release_shuffles(spark)
    several = stored(lead.groupBy("anchor").agg(F.count("*").alias("n"), F.sum("size").alias("total")).filter("n > 1"),
                     "suffix-several")
    total = several.agg(F.sum("total")).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    hot = F.col("n") > HOT
    dealt = (lead.join(several, "anchor").select("anchor", "c1", "lead.*", "size", "n").withColumn("hot", hot)
             .withColumn("shard", F.when(hot, F.col("anchor")).otherwise(F.pmod(F.col("anchor"), F.lit(shards))))
             .withColumn("salt", F.when(hot, F.pmod(F.col("c1"), F.ceil(F.col("n") / HOT))).otherwise(F.lit(-1).cast("long")))
             .groupBy(*document).agg(F.collect_list(F.struct("shard", "salt", "hot", "start", "size")).alias("wanted")))
    dealt = in_arrow(texts.join(dealt, document).select(*document, "wanted", "text"), _pieces,
                     "shard long, salt long, hot boolean, place long, part string, start long, bytes binary")
    sorted_ = stored(in_groups(dealt.groupBy("shard", "salt"), _shard,
                               "place long, part string, start long, stop long, w1 long, w2 long, open boolean"),
                     "suffix-windows")
    forget(lead, several)
    release_shuffles(spark)
    first = sorted_.filter("open").groupBy("w1", "w2").agg(F.min(F.struct(*window)).alias("lead"))
    across = (sorted_.filter("open").join(first, ["w1", "w2"]).filter(elsewhere)
              .select(*window, "stop"))
    ranges = again.unionByName(across).unionByName(sorted_.filter("not open").select(*window, "stop"))
    by_text = ranges.groupBy(*document).agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    marks = in_arrow(texts.join(by_text, document).select("place", "sha", "text", "ranges"), _marks,
                     "place long, sha string, spans array<struct<start:long,stop:long>>, kept_sha256 string")
    whole = info.filter(f"copy and n_bytes >= {LENGTH}").select(
        "place", "sha", F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("stop"))).alias("spans"),
        F.lit(hashlib.sha256().hexdigest()).alias("kept_sha256"))
    marks = stored(marks.unionByName(whole), "suffix-marks")
    forget(texts, again, sorted_)
    release_shuffles(spark)
    return info.select("place", "sha", "n_bytes"), marks


def _doc_id():
    return F.when(F.col("place") != F.lit(_NULL_PLACE), F.col("place"))


def repeat_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    info, marks = find_repeats(docs)
    lost = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return info.join(marks, ["place", "sha"], "left").select(
        _doc_id().alias("doc_id"), "n_bytes", F.coalesce(lost, F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents without their last column's byte ranges in the text."""
    for batch in batches:
        names = batch.schema.names[:-1]
        texts = batch.column(names.index("text")).to_pylist()
        sizes = batch.column(names.index("n_chars")).to_pylist() if "n_chars" in names else None
        keep = []
        for i, spans in enumerate(batch.column(len(names)).to_pylist()):
            if spans:
                data, out, at = (texts[i] or "").encode(), [], 0
                for s in spans:
                    out.append(data[at:s["start"]])
                    at = s["stop"]
                # A character that loses some of its bytes goes as a whole.
                texts[i] = "".join(x.decode("utf-8", "ignore") for x in (*out, data[at:]))
                if sizes:
                    sizes[i] = len(texts[i])
            if not spans or texts[i].strip():
                keep.append(i)
        columns = list(batch.columns[:-1])
        columns[names.index("text")] = pa.array(texts, batch.schema.field("text").type)
        if sizes:
            columns[names.index("n_chars")] = pa.array(sizes, batch.schema.field("n_chars").type)
        yield pa.RecordBatch.from_arrays(columns, names).take(pa.array(keep, pa.int64()))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text and any other columns) with the repeats cut out of
    the texts; n_chars, if there, is brought up to date. A row that has
    nothing left but white space is dropped if it lost anything."""
    _, marks = find_repeats(docs)
    marks = marks.select(F.col("place").alias("_mark_place"), F.col("sha").alias("_mark_sha"),
                         F.col("spans").alias("_mark_spans"))
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_PLACE))
    sha = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)
    rows = (docs.join(marks, (place == F.col("_mark_place")) & (sha == F.col("_mark_sha")), "left")
            .select(*(docs[c] for c in docs.columns), "_mark_spans"))
    return in_arrow(rows, _cut, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))
