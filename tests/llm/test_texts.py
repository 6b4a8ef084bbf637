"""Repeated strings, tokens, pieces, pages, vectors, pipeline."""

import collections
import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from corpus_fixtures import SF_SMALL, no_docs, odd_docs, prose  # noqa: F401
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from starloom.llm import embedding_dedup, html_consensus, sentence_pieces, suffix_dedup, suffix_sort, token_files
from starloom.llm.queries import tokenizer_path

pytestmark = pytest.mark.slow
SETTINGS = settings(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.integers(0, 4), max_size=200), st.sampled_from([1, 32]))
def test_suffix_order(symbols, repeats):
    text = np.array(symbols, np.int64)
    before, suffix_sort.LEAST_REPEATS = suffix_sort.LEAST_REPEATS, repeats
    try:
        got = suffix_sort.suffix_order(text)
    finally:
        suffix_sort.LEAST_REPEATS = before
    assert got.tolist() == sorted(range(len(text)), key=lambda i: symbols[i:])


def repeats_by_hand(rows):
    """(n_bytes, n_removed, n_spans, sha256 of the rest) of each (id, text), in order."""
    seen, out = set(), {}
    for key, text in rows:
        data = (text or "").encode()
        lost = np.zeros(len(data), bool)
        for i in range(len(data) - 99):
            if data[i:i + 100] in seen:
                lost[i:i + 100] = True
            seen.add(data[i:i + 100])
        spans = int((lost & ~np.r_[False, lost[:-1]]).sum()) if len(data) else 0
        rest = bytes(np.frombuffer(data, np.uint8)[~lost])
        out[key] = (len(data), int(lost.sum()), spans, hashlib.sha256(rest).hexdigest())
    return out


@pytest.mark.parametrize("hot", [2000, 2])
def test_repeats_against_a_scan(spark, odd_docs, no_docs, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    out = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.repeat_digests(odd_docs).collect()}
    rows = sorted({(-1 if r.doc_id is None else r.doc_id, r.text or "") for r in odd_docs.collect()})
    truth = repeats_by_hand(rows)
    assert out == {None if k == -1 else k: v for k, v in truth.items()}
    assert suffix_dedup.repeat_digests(no_docs).count() == 0
    cut = suffix_dedup.remove_repeats(odd_docs)
    assert cut.columns == odd_docs.columns
    left = {r.doc_id: r.text for r in cut.collect()}
    assert 2 not in left and left[1] == dict(rows)[1] and left[4] is None


def test_repeated_rows_and_copies_among_the_texts_of_one_id(spark):
    """A repeated row loses nothing to itself; a doc_id with a copied and an own text keeps both apart."""
    shared, own = prose(20, 30), prose(21, 40)
    rows = [(1, f"{shared} {prose(22, 20)}")] * 2 + [(2, f"{prose(23, 20)} {shared}"), (3, own), (4, own),
                                                     (4, f"{shared} {prose(24, 20)}"), (None, prose(25, 30) + shared),
                                                     (None, prose(25, 30) + shared), (None, prose(26, 30) + shared)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(r[1].encode()).hexdigest()))
    truth = repeats_by_hand([((k, t), t) for k, t in order])
    out = [tuple(r) for r in suffix_dedup.repeat_digests(docs).collect()]
    assert sorted(out, key=str) == sorted(((k, *v) for (k, _), v in truth.items()), key=str)
    assert suffix_dedup.remove_repeats(docs).filter("doc_id = 1").count() == 2


def test_no_group_holds_the_texts_of_one_id(spark, monkeypatch):
    """Null doc_ids are one place: nothing gathers its texts or anchors into one row."""
    shared = prose(30, 30)
    rows = [(None, f"{prose(31 + i, 20)} {shared} {prose(61 + i, 20)}") for i in range(24)] + [(1, shared)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    plans, most, stored = [], [], suffix_dedup.stored

    def watched(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        out = stored(df, name)
        if "anchors" in out.columns:
            most.append(out.agg(F.max(F.size("anchors"))).first()[0])
        return out
    monkeypatch.setattr(suffix_dedup, "stored", watched)
    out = [tuple(r) for r in suffix_dedup.repeat_digests(docs).collect()]
    order = sorted(rows, key=lambda r: (r[0] is not None, hashlib.sha256(r[1].encode()).hexdigest()))
    truth = repeats_by_hand([((k, t), t) for k, t in order])
    assert sorted(out, key=str) == sorted(((k, *v) for (k, _), v in truth.items()), key=str)
    assert not any("collect_set(sha" in p for p in plans)
    assert most == [max(most)] and most[0] <= len(shared) // 4


def test_only_texts_are_kept_between_steps_and_shuffles_are_released(spark, odd_docs, monkeypatch):
    stored, release = suffix_dedup.stored, suffix_dedup.release_shuffles
    columns, steps = {}, []

    def watched(df, name):
        columns[name] = {f.name: f.dataType.typeName() for f in df.schema}
        steps.append(name)
        return stored(df, name)

    def released(session):
        steps.append("release")
        release(session)

    monkeypatch.setattr(suffix_dedup, "stored", watched)
    monkeypatch.setattr(suffix_dedup, "release_shuffles", released)
    assert suffix_dedup.repeat_digests(odd_docs).count() == 15
    # Bytes of contexts are neither stored nor joined for all contexts.
    assert [n for n, c in columns.items() if "binary" in c.values() or "text" in c] == ["suffix-texts"]
    for large in ("suffix-anchors", "suffix-texts", "suffix-leads", "suffix-again", "suffix-windows", "suffix-marks"):
        assert steps[steps.index(large) + 1] == "release"


def test_contexts_are_cut_from_their_texts():
    kind = pa.list_(pa.struct([("shard", pa.int64()), ("salt", pa.int64()), ("hot", pa.bool_()), ("start", pa.int64()),
                               ("size", pa.int64())]))
    piece = lambda start, size: {"shard": 5, "salt": -1, "hot": False, "start": start, "size": size}
    batch = pa.RecordBatch.from_arrays(
        [pa.array([7, 8, 9]), pa.array(["", "", "s"]), pa.array([[piece(1, 2)], [], [piece(3, 4), piece(0, 2)]], kind),
         pa.array(["éa b", "zzz", "0123é56789"])], ["place", "part", "wanted", "text"]).slice(0)
    for part in ([batch], [batch.slice(0, 1), batch.slice(1)]):
        rows = [r for out in suffix_dedup._pieces(iter(part)) for r in out.to_pylist()]
        assert [(r["place"], r["part"], r["start"], r["bytes"]) for r in rows] == [
            (7, "", 1, "é".encode()[1:] + b"a"), (9, "s", 3, "3é5".encode()), (9, "s", 0, b"01")]


def test_code_lengths_are_limited_and_decodable():
    counts = np.array([1 << k for k in range(30)] + [0, 5])
    for limit in (5, 8, 18):
        lengths = token_files.code_lengths(counts, limit)
        assert lengths.max() <= limit and lengths[30] == 0
        assert sum(2.0 ** -int(n) for n in lengths if n) <= 1
        ids = np.random.default_rng(1).choice(np.flatnonzero(counts), 3000).astype(np.uint32)
        offsets, payload = token_files.pack(ids, lengths, token_files.canonical(lengths))
        assert (token_files.unpack(payload, offsets, len(ids), token_files.decode_table(lengths)) == ids).all()
    free = token_files.code_lengths(np.array([5, 9, 12, 13, 16, 45]), 18)
    assert (free * np.array([5, 9, 12, 13, 16, 45])).sum() == 224  # Huffman's optimum


def test_token_files_round_trip(spark, odd_docs, no_docs):
    from tokenizers import Tokenizer
    path = tokenizer_path("byte_bpe_50k.json")
    extra = spark.createDataFrame([(50 + i, t) for i, t in enumerate(
        ["  a  b", " lead", "x\n\n y\n", "tab\t z  \n", " ", "don't 12 3a!? <|endoftext|>x", "a\r\n b", "x  "])],
        "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").unionByName(extra)
    library, start = Tokenizer.from_file(path), 0
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    got = sorted(token_files.round_trip(docs, path).collect(), key=lambda r: r.start)
    for r, g in zip(rows, got, strict=True):
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [0]
        assert tuple(g) == (r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert token_files.round_trip(no_docs, path).count() == 0


def test_pieces_against_the_library(spark, odd_docs, no_docs):
    """The library's own Unigram encoder over the same pieces and scores."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb
    path = tokenizer_path("piece_bpe_32k.model")
    own = sentence_pieces.PieceModel(path)
    with open(path, "rb") as file:
        proto = pb.ModelProto.FromString(file.read())
    for place, i in enumerate(own.ids):
        proto.pieces[int(i)].score = float(own.scores[place])
    proto.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    score = dict(zip(own.ids.tolist(), own.scores.tolist()))
    rows = {r.doc_id: r for r in sentence_pieces.decode(sentence_pieces.encode(
        odd_docs.filter("doc_id < 14"), path, ["doc_id"]), path).collect()}
    for r in odd_docs.filter("doc_id < 14").collect():
        got, want = rows[r.doc_id].ids, library.encode((r.text or ""))
        total = lambda ids: sum(score.get(i, -40.0) for i in ids)
        assert got == want or abs(total(got) - total(want)) < 1e-3 * len(want)  # equal sums in another order
        assert rows[r.doc_id].decoded == (r.text or "")
    for text in ("", " ", "  a  b ", "x\n\ty", "w" * 300, "é漢𝄞"):
        ids, count = own.encode([text])
        assert own.decode(ids.tolist()) == text and count[0] == len(ids)
    assert own.viterbi(["hello"])[0] == own.one_by_one("hello")
    assert sentence_pieces.round_trip(no_docs, path).count() == 0


PAGE = """<html><head><title>T</title></head><body class="page"><header><h1>Site</h1></header>
<nav><a href=x>Home</a></nav><div class="cookie-notice">We use cookies</div><div id="wrap"><div class="main-col post-{n}">
<h2>Title &amp; more {n}</h2><p>First <b>bo</b>ld para {n}.<p>Second  <a href="y">link</a> here,\nlong enough.<ul><li>one<li>two</ul>
<div class="share">Share</div><form><input><button>Go</button></form></div><aside><p>Side</p></aside></div>
<section id="comments"><p>I disagree!</p></section><footer>F</footer><script>if(a<b){{"</p>"}}</script></body></html>"""


def test_pages(spark):
    rows = [(n, f"http://a.example/{n}", PAGE.format(n=n)) for n in range(5)]
    rows += [(10, None, None), (11, "nonsense", ""), (12, "http://b.example/", "plain &lt;text&gt; only"), (13, "http://a.example/x", "<p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    out = {r.page_id: r for r in html_consensus.extract(pages, ["page_id", "url"]).collect()}
    for n in range(5):
        assert out[n].text == f"Title & more {n} First bold para {n}. Second link here, long enough. one two"
        assert out[n].n_chars == len(out[n].text) and out[n].path.endswith("div.main-col.post-#")
    assert out[10].text == out[11].text == out[13].text == "" and out[12].text == "plain <text> only"
    assert html_consensus.extract(pages.limit(0), ["page_id", "url"]).count() == 0


def test_pages_of_many_templates_of_one_host(spark):
    """Each template is read by its own path, however many the host has."""
    page = '<html><body><article class="{}"><p>Body of {} that is long enough</p></article><div class="x"><p>Other</p></div></body></html>'
    names = ["".join(chr(97 + int(d)) for d in str(100 + n)) for n in range(40)]
    rows = [(n, f"http://a.example/{n}", page.format(name, name)) for n, name in enumerate(names)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r.page_id: r for r in html_consensus.extract(pages, ["page_id"]).collect()}
    for n, name in enumerate(names):
        assert out[n].text == f"Body of {name} that is long enough" and out[n].path.endswith(f"article.{name}")


def test_only_names_of_boilerplate_drop_text():
    """Attribute names as a whole, whole class names, blocks only, and no container of the main text."""
    body = "<p>The text of the page.</p><p>More of the text here.</p>"
    kept = ['<body style="overflow:hidden">{}', '<div data-hidden="false" data-id="reply-3">{}</div>', '<div class="layout has-sidebar">{}</div>',
            '<div class="entry-content no-comments">{}</div>', '<div class="entry-content comments">{}</div>',
            '<div class="sidebar"><article>{}</article></div>', '<div class="page-banner">{}</div><div class="x">Less</div>']
    for frame in kept:
        pieces = html_consensus.read_page(frame.format(body))[0]
        assert "".join(pieces).split()[:10] == "The text of the page. More of the text here.".split()[:10], frame
    assert "".join(html_consensus.read_page('<p>A <span class="notice">b</span> c')[0]).split() == ["A", "b", "c"]
    for gone in ('<div class="site-footer">Gone</div>', '<div id="reply-3">Gone</div>', '<div hidden>Gone</div>',
                 '<ul class="menu-items"><li>Gone</ul>', '<section class="comments"><article>Gone</article></section>'):
        assert "Gone" not in "".join(html_consensus.read_page(f"<article>{body}</article>{gone}")[0]), gone


def test_vectors_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", 16)
    rng = np.random.default_rng(5)
    base = rng.standard_normal((12, 24))
    rows = [(i, (base[i % 12] + 0.12 * rng.standard_normal(24)).tolist(), i % 2) for i in range(90)]
    rows += [(100, rows[0][1], 0), (101, None, 0), (102, [0.0] * 24, 0), (103, [float("nan")] * 24, 1), (104, rows[0][1], None),
             (105, [2 * x for x in rows[0][1]], 0), (106, [], 0), (107, [1.0, None], 0), (None, rows[0][1], 0)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("id", F.lit(1))
    out = {r.vec_id: r for r in embedding_dedup.near_vectors(vectors, 0.93).collect()}
    ok = [r for r in rows if r[0] is not None and r[2] is not None and r[1] and None not in r[1] and any(r[1]) and r[1][0] == r[1][0]]
    cos = lambda a, b: np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b)
    links = [(a[0], b[0]) for a in ok for b in ok if a[0] < b[0] and a[2] == b[2] and len(a[1]) == len(b[1]) and cos(a[1], b[1]) >= 0.93]
    root = {r[0]: r[0] for r in rows if r[0] is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    for k in root:
        assert out[k].n_links == sum(k in pair for pair in links), k
        assert out[k].component_id == find(k) and out[k].kept == (find(k) == k)
    assert out[None].kept and embedding_dedup.near_vectors(vectors.limit(0)).count() == 0


def test_pipeline_stages(spark, odd_docs, no_docs, tmp_path):
    for start in (odd_docs, no_docs):
        docs = start
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF_SMALL)
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == start.columns, name
            path = str(tmp_path / f"{name}-{start is odd_docs}")
            out.write.parquet(path)
            docs = spark.read.parquet(path)
        ids = {r.doc_id for r in docs.collect()}
        assert ids == ({None, 1, 7, 8, 9, 10, 11} if start is odd_docs else set())


@pytest.mark.slow
def test_pipeline_against_plain_versions_of_its_stages(spark):
    """run() over whole documents: near copies by all pairs, repeats by a scan of all
    100-byte strings, pieces by decoding; what the language stage keeps is taken as it
    is, and each document may be used once or twice by mixing."""
    from test_documents import components_by_hand, shingles
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    known = {r.doc_id: r for r in corpus_pipeline.STAGES[0][1](spark, docs, SF_SMALL).collect()}
    assert all(not any(c.isalpha() for c in r.text or "") for r in docs.collect() if r.doc_id not in known)
    sets = {i: shingles(r.text, 5) for i, r in known.items()}
    by_item = {}
    for i, s in sets.items():
        for x in s:
            by_item.setdefault(x, []).append(i)
    both = {}
    for ids in by_item.values():
        for a in ids:
            for b in ids:
                if a < b:
                    both[a, b] = both.get((a, b), 0) + 1
    links = [(a, b) for (a, b), n in both.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    firsts = components_by_hand(links, list(known))
    rows = sorted((i, (known[i].text or "").encode()) for i in known if firsts[i] == i)
    seen, want = set(), {}
    for i, data in rows:
        gone = bytearray(len(data))
        for k in range(len(data) - 99):
            window = data[k:k + 100]
            if window in seen:
                gone[k:k + 100] = b"\1" * 100
            seen.add(window)
        left = bytes(c for c, g in zip(data, gone) if not g)
        if left.strip() or not any(gone):
            want[i] = left.decode("utf-8", "ignore")
    model = sentence_pieces.PieceModel(tokenizer_path("piece_bpe_32k.model"))
    got = {}
    for r in corpus_pipeline.run(spark, SF_SMALL).collect():
        assert r.n_pieces == len(r.ids) and r.source == known[r.doc_id].source
        got.setdefault(r.doc_id, []).append(model.decode(r.ids))
    assert set(got) == set(want) and all(len(v) <= 2 for v in got.values())
    assert all(set(v) == {want[i].replace("\u2581", " ")} for i, v in got.items())


# -- long and broken markup, small memories ---------------------------------------------

@pytest.mark.parametrize("html", ["<a " * 350000, '<a "' * 250000, '<a ">"' * 170000, "<div>" * 100000, "<div>t" * 100000,
                                  "<span>" * 50000 + "<p>" * 50000, "<p><option>" + "<h1>" * 100000,
                                  "<div>" * 50000 + "</x>" * 50000, "<!--" * 250000, "<" * 1000000])
def test_broken_markup_is_read_in_one_pass(html):
    import time
    from starloom.llm import html_consensus
    begin = time.process_time()
    pieces, found = html_consensus.read_page(html)
    html_consensus._shares(found)
    assert time.process_time() - begin < 5 and len(pieces) <= 2 * html.count("<") + 1


def test_ends_of_tags():
    from starloom.llm.html_consensus import Tags
    for html, want in (('<a x="1>2">t', [(0, 11)]), ('<a x="1>t', [(0, 8)]), ("<a x='\">' y>t<b>", [(0, 12), (13, 16)]),
                       ('<a "><b "><c>', [(0, 10), (10, 13)]), ("<a '><b>", [(0, 5), (5, 8)]), ("<a <b", []),
                       ("<!-- > --><a>", [(10, 13)]), ("<!-- <a>", []), ("< a><3><b/>", [(7, 11)])):
        tags, at, got = Tags(html), 0, []
        while m := tags.find(at):
            at = m[1]
            if m[3]:
                got.append(m[:2])
        assert got == want, html


@pytest.mark.slow
def test_a_small_memory_of_words_gives_the_same_pieces(monkeypatch):
    from corpus_fixtures import prose
    from starloom.llm import sentence_pieces
    from starloom.llm.queries import tokenizer_path
    path = tokenizer_path("piece_bpe_32k.model")
    texts = [prose(k % 7, 40) + " é漢 \0x \0" + " the same words again  " + "\u2581x" + "long" * 30 + prose(k, 30) for k in range(60)]
    want = sentence_pieces.PieceModel(path).encode(texts)
    monkeypatch.setattr(sentence_pieces, "CACHE_WORDS", 100)
    small = sentence_pieces.PieceModel(path)
    got = [small.encode(texts[k:k + 3]) for k in range(0, len(texts), 3)]
    assert (np.concatenate([g[0] for g in got]) == want[0]).all() and (np.concatenate([g[1] for g in got]) == want[1]).all()
    assert len(small.young.words) < 400 and len(small.old.words) < 400
    at = np.r_[0, np.cumsum(want[1])]
    assert [small.decode(want[0][a:b].tolist()) for a, b in zip(at, at[1:])] == [t.replace("\u2581", " ") for t in texts]
    one = sentence_pieces.PieceModel(path)
    for word in ("\u2581the", "\u2581words", "\u2581漢é", "\u2581" + "ab" * 20):
        places, count = one.viterbi([word])
        assert places.tolist() == one.one_by_one(word) and count.tolist() == [len(places)]


@pytest.mark.parametrize("pieces, words", [(1 << 20, 1 << 19), (200, 60)])
def test_remembered_pieces_give_the_librarys_ids(pieces, words):
    """Cuts into words, and a memory below the vocabulary, against the library on whole texts."""
    from tokenizers import Tokenizer
    path = tokenizer_path("byte_bpe_50k.json")
    library, encoder = Tokenizer.from_file(path), token_files.PieceEncoder(path, pieces, words)
    assert encoder.by_words
    draw = np.random.default_rng(5)
    signs = list(" \n'ab.Zé1<|>\x00\t\r×日_, ")
    texts = ["", " ", "it's don't 'll", "<|endoftext|> a<|endoftext|>b <| x", "a\nb\n\nc d\n", "12a3 4,5. x\x85 y"]
    texts += ["".join(draw.choice(signs, draw.integers(1, 40))) for _ in range(3000)]
    for lo in range(0, len(texts), 40):
        ids, counts = encoder.encode(texts[lo:lo + 40])
        want = [library.encode(t, add_special_tokens=False).ids + [0] for t in texts[lo:lo + 40]]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]
    assert encoder.encode([])[0].tolist() == []


def test_marks_and_newlines_make_no_new_words():
    """A word is remembered once, whatever stands around it; only pieces with other characters are whole."""
    from tokenizers import Tokenizer
    path = tokenizer_path("byte_bpe_50k.json")
    library, encoder = Tokenizer.from_file(path), token_files.PieceEncoder(path)
    words = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}\u00e9" for k in range(200)]
    texts = [" ".join(f"{a}{mark}{b}" for a, b in zip(words, words[k + 1:])) for k, mark in enumerate(",.;\n")]
    ids, counts = encoder.encode(texts)
    want = [library.encode(t, add_special_tokens=False).ids + [0] for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    # Each word with a blank before it and without, and the four signs.
    assert len(encoder.words.numbers) <= 2 * len(words) + 4 and not len(encoder.pieces.numbers)
    encoder.encode(["it's \u65e5\u672c wa\u00e9", "wa\u00e9 it's"])
    assert set(encoder.pieces.numbers) == {"it's", " \u65e5\u672c", " it's"}


@pytest.mark.parametrize("pieces, words", [(1 << 20, 1 << 19), (150, 60)])
def test_white_space_and_other_scripts_are_cut_as_the_library_cuts(pieces, words):
    from tokenizers import Tokenizer
    path = tokenizer_path("byte_bpe_50k.json")
    library, encoder = Tokenizer.from_file(path), token_files.PieceEncoder(path, pieces, words)
    draw = np.random.default_rng(11)
    signs = [" ", " ", "\n", "\t", "\x1c", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u205f", "\u3000", "a", "Ab",
             "\u00e9", "\u00d7", "\u00f7", "\u024f", "\u0250", "\u65e5", "'s", "don't", "\u2019", "12", "\u00b2", "?!",
             "<|endoftext|>", "|", "\x00", "\U0001f600"]
    for _ in range(40):
        texts = ["".join(draw.choice(signs, draw.integers(0, 14))) for _ in range(50)]
        texts += [" ".join(draw.choice(signs, draw.integers(0, 14))) for _ in range(50)]
        ids, counts = encoder.encode(texts)
        want = [library.encode(t, add_special_tokens=False).ids + [0] for t in texts]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_ids_are_counted_while_they_are_encoded(spark, odd_docs, monkeypatch):
    """One row of each task has the counts of all its ids."""
    rows = token_files.encode_documents(odd_docs, tokenizer_path("byte_bpe_50k.json")).collect()
    want, got = collections.Counter(), collections.Counter()
    for r in rows:
        want.update(token_files._ids(r.ids, r.width).tolist())
        if r.counts is not None:
            for i, n in np.frombuffer(r.counts, "<i8").reshape(-1, 2).tolist():
                got[i] += n
    assert got == want and sum(r.counts is None for r in rows) < len(rows)
