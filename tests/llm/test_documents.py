"""Language, quality, fingerprints, near copies, mixing: small fixtures."""

import re

import numpy as np
import pyarrow as pa
import pytest
from corpus_fixtures import SF_SMALL, near_copies, no_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F

from starloom.llm import common, fingerprints, language_id, minhash_dedup, mixing, quality
from starloom.llm.components import components

pytestmark = pytest.mark.slow


def shingles(text, size, lower=str.lower):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def components_by_hand(links, ids):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 21), (30, 30), (None, 4), (2, 1)]
    got = {r.id: r.component_id for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 1, 8: 1, 9: 1, 20: 20, 21: 20}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_language_on_odd_rows(spark, odd_docs, no_docs):
    out = {r.doc_id: r for r in language_id.identify(odd_docs, odd_docs, ["doc_id"]).collect()}
    assert out[4].lang_pred == out[5].lang_pred == out[13].lang_pred == "und" and out[4].score == 0
    assert out[9].lang_pred in ("en", "fr") and 0 <= out[9].score <= 1
    assert language_id.identify(no_docs, no_docs, ["doc_id"]).count() == 0
    alone = language_id.identify(odd_docs, no_docs, ["doc_id"])
    assert {r.lang_pred for r in alone.collect()} == {"und"}
    kept = language_id.keep_known(odd_docs)
    assert kept.columns == odd_docs.columns and not {4, 5, 6, 13} & {r.doc_id for r in kept.collect()}


def test_language_held_out(spark):
    from starloom.llm.queries import QUERIES
    out = QUERIES["op1_naive_bayes_language"](spark, SF_SMALL).filter("held_out")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang")
    assert out.join(docs, "doc_id").filter("lang <> lang_pred").count() <= 1


def test_quality_features_and_odd_rows(spark, odd_docs, no_docs):
    x = quality.features(pa.array(["a a a", None, "", "One. Two!\nOne."]))
    assert x.shape == (4, len(quality.NAMES)) and np.isfinite(x).all() and not x[1].any() and not x[2].any()
    labels = spark.createDataFrame([(i,) for i in range(1, 15)], "doc_id long")
    out = quality.score_quality(odd_docs, labels.limit(6), labels.limit(7), ["doc_id"]).collect()
    assert len(out) == odd_docs.count() and all(0 <= r.score <= 1 for r in out)
    assert quality.score_quality(no_docs, labels, labels, ["doc_id"]).count() == 0


def test_bounded_risk_is_never_negative():
    risk = quality.non_negative_risk(0.9)
    u, p = (1.0, 0.5, 0.1, np.zeros(3), np.zeros(3)), (1.0, 0.3, 0.7, np.zeros(3), np.zeros(3))
    assert risk((0.5, 0.1, np.zeros(3), np.zeros(3)), (0.3, 0.7, np.zeros(3), np.zeros(3)))[0] >= 0.9 * 0.3
    assert len(u) == len(p)


def test_fingerprints(spark, odd_docs, no_docs):
    docs = odd_docs.filter("doc_id is not null and doc_id < 14").select("doc_id", "text", "score")
    rows = {r.doc_id: r.text or "" for r in docs.collect()}
    out = {r.doc_id: r for r in fingerprints.fingerprint_edits(docs).collect()}
    ids = sorted(rows)
    for i, k in enumerate(ids):
        text, after = rows[k], rows[ids[(i + 1) % len(ids)]]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        import hashlib
        assert out[k].n_chars == len(text) and out[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b = shingles(text, 5), shingles(edited, 5)
        truth = len(a & b) / len(a | b) if a | b else 1.0
        assert abs(out[k].near_edited - truth) < 0.25
    assert out[1].fingerprint == out[2].fingerprint and out[1].near_next == 1.0
    assert out[4].fingerprint == "" and len(out[7].fingerprint) == 256
    assert fingerprints.fingerprint_edits(no_docs).count() == 0
    one = fingerprints.fingerprint_edits(docs.filter("doc_id = 1")).first()
    assert one.near_next == 1.0


def test_fingerprint_neighbours_across_ranges(spark):
    docs = spark.range(300).select((F.col("id") * 3).alias("doc_id"), F.col("id").cast("string").alias("text"))
    out = fingerprints.with_next(docs.repartition(5), ["text"]).collect()
    assert len(out) == 300 and all(int(r.next_text) == (int(r.text) + 1) % 300 for r in out)


def test_near_duplicates_against_all_pairs(spark, odd_docs, no_docs):
    out = {r.doc_id: r for r in minhash_dedup.near_duplicates(odd_docs, 4, 80).collect()}
    rows = {r.doc_id: r.text for r in odd_docs.collect()}
    sets = {k: shingles(t, 4) for k, t in rows.items() if k is not None}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and
             100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    truth = components_by_hand(links, sets)
    assert {k: r.component_id for k, r in out.items() if k is not None} == truth
    assert all(r.n_shingles == len(sets[k]) and r.kept == (truth[k] == k) for k, r in out.items() if k is not None)
    assert out[None].component_id is None and out[None].kept
    assert minhash_dedup.near_duplicates(no_docs).count() == 0
    kept = minhash_dedup.keep_firsts(odd_docs, 4, 80)
    assert kept.columns == odd_docs.columns and {r.doc_id for r in kept.collect()} == {
        None, *(k for k in truth if truth[k] == k)}


def test_a_large_group_of_near_copies(spark):
    """More copies than a band compares at once: hubs, then tiles."""
    rows = near_copies(150)
    out = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), 4, 80).collect()}
    sets = {k: shingles(t, 4) for k, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert out == components_by_hand(links, sets)


def test_collision_rate_and_registers():
    assert 0 < minhash_dedup.collision_rate(np.array([100]), np.array([100]))[0] < 0.05
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 63, 1200).astype(np.uint64)
    a, b = np.sort(pool[:1000]), np.sort(pool[200:])
    regs = [minhash_dedup.registers(x, np.zeros(len(x), np.int64), 1)[0] for x in (a, b)]
    chance = minhash_dedup.collision_rate(np.array([1000]), np.array([1000]))[0]
    assert abs(((regs[0] == regs[1]).mean() - chance) / (1 - chance) - 800 / 1200) < 0.08


@pytest.mark.parametrize("limit", [1.0, 2.0, 3.5])
def test_mixing_uses_every_document_and_keeps_the_limit(spark, odd_docs, no_docs, limit):
    rows = mixing.mix(odd_docs, max_repeats=limit).collect()
    assert len(rows) == odd_docs.count() and all(r.n_repeats >= 1 for r in rows)
    by = {}
    for r in rows:
        size, used = by.get(r.source, (0, 0))
        by[r.source] = size + r.n_tokens, used + r.n_tokens * r.n_repeats
    most = max(r.n_tokens for r in rows)
    assert all(used <= limit * size + 2 * most for size, used in by.values())
    assert mixing.mix(no_docs, max_repeats=limit).count() == 0
    out = mixing.mixed_rows(odd_docs, max_repeats=limit)
    assert out.columns == odd_docs.columns and out.count() == sum(r.n_repeats for r in rows)


def test_exponent_meets_the_target(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 100), ("c", 10), ("d", 0)], "key string, tokens long")
    share = np.array([1000, 100, 10]) / 1110
    a = mixing.find_exponent(sizes, 4.0, None, None)
    assert abs((share.max() / share.min()) ** (1 - a) - 4) < 1e-6
    a = mixing.find_exponent(sizes, None, 0.9, None)
    w = share ** a / (share ** a).sum()
    assert abs(-(w * np.log(w)).sum() - 0.9) < 1e-6
    assert mixing.find_exponent(sizes, None, 5.0, None) == 0.0


@pytest.mark.parametrize("name", ["op7_hyperminhash_dedup", "op10_subspace_embedding_dedup"])
def test_queries_match_their_sql(spark, name):
    import duckdb

    from starloom.llm.queries import ORACLE_SQL, QUERIES
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.sql(f"create view {table} as select * from '{SF_SMALL}/{table}.parquet'")
    out = QUERIES[name](spark, SF_SMALL)
    got = sorted(map(tuple, out.collect()))
    assert got == sorted(con.sql(f"select {', '.join(out.columns)} from ({ORACLE_SQL[name]})").fetchall())


def test_repeated_rows_are_one_text(spark, monkeypatch):
    """Two near copies, a thousand rows each: two texts go on to be confirmed."""
    seen = {}

    def stored(df, name):
        out = kept(df, name)
        seen[name] = out.count()
        return out
    kept = minhash_dedup.stored
    monkeypatch.setattr(minhash_dedup, "stored", stored)
    base = " ".join(f"t{i}" for i in range(200))
    rows = [(1, base)] * 1000 + [(2, base + " end")] * 1000 + [(3, "other words here")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {tuple(r) for r in minhash_dedup.near_duplicates(docs).collect()}
    assert got == {(1, 196, 1, True), (2, 197, 1, False), (3, 1, 3, True)}
    assert seen["minhash-texts"] == 2 and seen["minhash-likely"] <= 1


def test_a_row_of_a_repeated_id_is_kept_the_same_on_every_run(spark):
    rows = [(1, f"text number {i} of one id", "s", i) for i in range(20)] + [(None, "x", None, 1), (None, "x", None, 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    first, again = (minhash_dedup.keep_firsts(frame.repartition(n)).collect() for n in (1, 7))
    assert len(first) == 3 and sorted(first, key=str) == sorted(again, key=str)


def test_registers_by_ranking_of_donors():
    """Empty buckets take the first occupied one of their ranking, whatever the size."""
    rng = np.random.default_rng(4)
    sizes = [1, 3, 20, 200, 2000, 0]
    hashes = [np.sort(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)) for n in sizes]
    regs = minhash_dedup.registers(np.concatenate(hashes), np.repeat(np.arange(len(sizes)), sizes), len(sizes))
    for h, got in zip(hashes, regs):
        if not len(h):
            assert not got.any()
            continue
        bucket = (h >> minhash_dedup._SHIFT).astype(int)
        alone = minhash_dedup.registers(h, np.zeros(len(h), np.int64), 1)[0]
        assert (alone == got).all()
        have = np.unique(bucket)
        for e in np.setdiff1d(np.arange(minhash_dedup.REGISTERS), have)[:50]:
            assert got[e] == got[have[minhash_dedup._RANK[e, have].argmin()]]


def test_a_task_leaves_no_freed_memory(spark):
    """Arrow's pool of a worker holds no more behind a task than the live bytes need."""

    def hoard(batches):
        for _ in batches:
            for _ in range(4):
                held = [pa.array(np.arange(1 << 16)) for _ in range(200)]
                del held
        yield pa.RecordBatch.from_arrays([pa.array([0])], ["n"])
    seen = []
    run = common._releasing(hoard)
    real, common.release_memory = common.release_memory, lambda: seen.append(real())
    try:
        assert [b.num_rows for b in run(iter([None]))] == [1] and seen == [None]
    finally:
        common.release_memory = real
    assert common.in_arrow(spark.range(3), lambda batches: batches, "id long").count() == 3


def test_pairs_are_confirmed_in_steps_of_bounded_bytes(monkeypatch):
    texts = ["", "one two", *(" ".join(f"w{(i + k) % 90}" for k in range(60)) for i in range(40)), None]
    a, b = zip(*((i, j) for i in range(len(texts)) for j in range(i)))
    pairs = pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array([texts[i] for i in a], pa.string()),
                                        pa.array([texts[i] for i in b], pa.string())], ["a", "b", "ta", "tb"])
    sets = [shingles(t, 5) for t in texts]
    want = {(i, j) for i, j in zip(a, b)
            if sets[i] & sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    monkeypatch.setattr(minhash_dedup, "CONFIRM_BYTES", 1000)
    parts = list(minhash_dedup._confirm(5, 80)(iter([pairs])))
    assert len(parts) > 100  # about a thousand bytes in each
    assert {(r["a"], r["b"]) for p in parts for r in p.to_pylist()} == want != set()


def test_a_tile_makes_no_list_of_all_its_pairs():
    n = 300
    texts = pa.array([t for _, t in near_copies(n)])
    sketch = minhash_dedup._sketch(5)
    rows = pa.Table.from_batches(list(sketch(iter([pa.RecordBatch.from_arrays([pa.array(range(n)), texts], ["id", "t"])]))))
    tile = pa.table({"no": [0] * n, "id": rows["doc_id"], "size": rows["n_shingles"], "label": rows["doc_id"],
                     "side": [0] * n, "regs": rows["regs"], "text": texts})
    compared, estimate = [], minhash_dedup._estimate
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(minhash_dedup, "_estimate", lambda a, *rest: compared.append(len(a)) or estimate(a, *rest))
        links = minhash_dedup._settle(5, 80)(tile)
    hashes = minhash_dedup._sets(texts, 5)
    label = list(range(n))

    def join(a, b):
        low, high = sorted((label[a], label[b]))
        label[:] = [low if x == high else x for x in label]

    for a, b in zip(links["a"].to_pylist(), links["b"].to_pylist()):
        assert label[a] != label[b] and minhash_dedup._linked(hashes[a], hashes[b], 80)
        join(a, b)
    found = list(label)
    label = list(range(n))
    for a in range(n):
        for b in range(a):
            if label[a] != label[b] and minhash_dedup._linked(hashes[a], hashes[b], 80):
                join(a, b)
    assert found == label
    # Members connected by an earlier step's links are not compared again.
    assert max(compared) <= minhash_dedup.PAIRS and sum(compared) < n * (n - 1) // 2
