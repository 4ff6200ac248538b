"""Operators on small fixtures with nulls, empty and very long texts, ties, repeated rows and clashing extra columns, against brute force."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

import corpus_pipeline
from sedimenta.llm import embedding_dedup, exact_dedup, html_extract, licenses, packing, sentencepiece_bpe, simhash, substring_dedup, toxicity, warc
from sedimenta.llm.common import components, shared_dir

SPACE = re.compile(r"[\x20\x09-\x0D]+")
DOC = "doc_id long, text string, lang string, source string, n_chars long, digest string, __x string, fp string, g string, toxic_score string"


def words(text):
    return [w for w in SPACE.split(text or "") if w]


@pytest.fixture(scope="module")
def docs():
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)] + ["Idiot", "license", "MIT", "é", "%%%", "the"]
    texts = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 120))) for _ in range(60)]
    texts += [texts[0], texts[0].replace(" ", " \n\t"), texts[1] + " tail", " ".join(texts[2:6]), None, "", "  ", "x", "the MIT License and the GNU General Public-License"]
    texts += ["SPDX-License-Identifier: (MIT OR GPL-2.0-only WITH Classpath-exception-2.0) AND Zlib\n", " ".join(["go"] * 30), "a" * 5000, " ".join(rnd.choice(vocabulary) for _ in range(9000))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, texts[3]), (None, texts[4]), (None, "only here")]
    return [(i, t, "en", "s", len(t or ""), "d", "x", "f", "g", "t") for i, t in rows]


@pytest.fixture(scope="module")
def sf(spark, docs, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(docs, DOC).repartition(3).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(d[0], 1, int("Idiot" in (d[1] or ""))) for d in docs if d[0] is not None], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return base


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], DOC).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{base}/pages.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{base}/embeddings.parquet")
    return base


def test_empty_tables(spark, empty):
    from sedimenta.llm.queries import QUERIES

    for name, query in QUERIES.items():
        assert query(spark, empty).count() == 0, name


def test_exact_dedup(spark, sf, docs):
    got = exact_dedup.op1_exact_dedup(spark, sf).collect()
    groups = {}
    for d in docs:
        groups.setdefault(SPACE.sub(" ", d[1] or ""), []).append(d[0])
    low = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    assert len(got) == len(docs)
    assert all(r["keep_id"] == low[sha[r["text_sha256"]]] and r["group_size"] == len(groups[sha[r["text_sha256"]]]) for r in got)
    assert Counter(r["text_sha256"] for r in got if r["kept"]) == Counter(list(sha))  # just one of each group


def test_digest_index_keeps_what_it_saw(spark, docs):
    df = spark.createDataFrame(docs, DOC)
    index = exact_dedup.DigestIndex(spark)
    first, again = index.ingest(df).where("kept").count(), index.ingest(df)
    assert again.where("kept").count() == 0 and index.rows().count() == first
    more = spark.createDataFrame([(900, docs[0][1]), (901, "new one")], "doc_id long, text string")
    assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in index.ingest(more).collect()} == {(900, 0, False), (901, 901, True)}
    for buckets in (1, 4, 64):  # the stored layout counts, also where the session never saw the table
        spark.sql(f"DROP TABLE {index.table}")
        reopened = exact_dedup.DigestIndex(spark, index.path, buckets)
        assert reopened.buckets == index.buckets and reopened.rows().count() == first + 1
        assert reopened.ingest(df).where("kept").count() == 0 and reopened.rows().count() == first + 1


def test_digest_index_survives_a_killed_run(spark, docs, monkeypatch):
    df = spark.createDataFrame(docs, DOC)
    index = exact_dedup.DigestIndex(spark)
    whole = exact_dedup.files.create_once

    def killed(spark, path, text):
        if "/log/" in path:
            raise RuntimeError("lost")
        return whole(spark, path, text)

    monkeypatch.setattr(exact_dedup.files, "create_once", killed)
    with pytest.raises(RuntimeError, match="lost"):
        index.ingest(df, "monday")
    monkeypatch.setattr(exact_dedup.files, "create_once", whole)
    assert index.rows().count() == 0  # nothing of the killed run counts
    rerun = Counter(tuple(r) for r in index.ingest(df, "monday").collect())
    assert sum(r[3] * n for r, n in rerun.items()) == index.rows().count() > 0
    assert Counter(tuple(r) for r in index.ingest(df, "monday").collect()) == rerun  # its answer was lost: the same verdicts again
    assert index.ingest(df, "tuesday").where("kept").count() == 0


def test_digest_index_of_two_batches_at_a_time(spark, docs, monkeypatch):
    df = spark.createDataFrame(docs, DOC)
    index = exact_dedup.DigestIndex(spark)
    whole, other = exact_dedup.files.create_once, []

    def late(spark, path, text):
        if "/log/" in path and not other:
            other.append(1)
            other.append(exact_dedup.DigestIndex(spark, index.path).ingest(df).where("kept").count())
        return whole(spark, path, text)

    monkeypatch.setattr(exact_dedup.files, "create_once", late)
    assert index.ingest(df).where("kept").count() == 0 and other[1] == index.rows().count()


def test_exact_dedup_keeps_columns_of_any_name(spark):
    rows = [(1, "a  b", "x1", "y1"), (2, "a b", "x2", "y2"), (None, "a b", "x3", "y3"), (None, "c", "x4", "y4"), (None, "c", "x4", "y4"), (3, None, None, "y5"), (3, "", None, "y5")]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string, _KEY string").withColumnsRenamed({"key": "key"})
    for names in (("key", "_KEY"), ("__digest", "__id"), ("digest", "row"), ("kept", "keep_id")):
        one = df.toDF("doc_id", "text", *names)
        got = exact_dedup.DigestIndex(spark).keep(one)
        assert got.columns == one.columns
        assert Counter((r[0], r[2], r[3]) for r in got.collect()) == Counter([(1, "x1", "y1"), (None, "x4", "y4"), (3, None, "y5")])


def test_toxicity_marginals_are_exact():
    tagger = toxicity.Tagger({}, -2.0, np.array([[0.5, -0.7], [-0.2, 0.9]]), np.array([0.3, -0.4]))
    rng = np.random.default_rng(0)
    for _ in range(40):
        n = int(rng.integers(1, 50))
        at = sorted(rng.choice(n, size=min(n, int(rng.integers(1, 8))), replace=False).tolist())
        cue = rng.normal(0, 3, len(at)).tolist()
        e = np.zeros((n, 2))
        e[:, 1] = tagger.bias
        e[at, 1] += cue
        a = [tagger.start + e[0]]
        for j in range(1, n):
            a.append(np.logaddexp(a[-1][0] + tagger.trans[0], a[-1][1] + tagger.trans[1]) + e[j])
        b = [np.zeros(2)]
        for j in range(n - 1, 0, -1):
            x = e[j] + b[0]
            b.insert(0, np.logaddexp(tagger.trans[:, 0] + x[0], tagger.trans[:, 1] + x[1]))
        m = np.array(a) + np.array(b)
        assert np.allclose(tagger.marginals(at, cue, n), np.exp(m - np.logaddexp(m[:, :1], m[:, 1:]))[at, 1])


def test_toxicity_held_out_accuracy(spark):
    got = toxicity.op2_toxicity(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    held = [r for r in got.collect() if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in held)
    assert sum(r["predicted"] == r["toxic"] for r in held) / len(held) >= 0.93


def test_toxicity_rows(spark, sf, docs):
    got = toxicity.op2_toxicity(spark, sf).collect()
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 for r in got)


def test_sentencepiece(spark, sf, docs):
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter()
    for d in docs:
        ids = sp.encode(d[1] or "")
        want[(d[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in sentencepiece_bpe.op3_sentencepiece(spark, sf).collect()) == want
    rnd = random.Random(1)
    parts = ["a", "b", "e", " ", "  ", "\n", "é", "▁", "the", "aaaa", "漢", "😀", "\t", "\x00", "0", "12", "ing", "\r", "<s>", " ", "%%%"]
    code = sentencepiece_bpe.coder(public_tokenizers.path("piece_bpe_32k.model"))
    odd = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(2000)]
    for text, (n, ids, data) in zip(odd, code.rows(odd), strict=True):
        ref = sp.encode(text)
        assert (n, ids.decode(), data.decode()) == (len(ref), ",".join(map(str, ref)), sp.decode(ref))
        assert code.model.decode(code.model.encode(text)) == sp.decode(ref)


def full_marginals(tagger, cues):
    """P(label 1) of every word, by forward and backward sums over the whole text in logs."""
    n = len(cues)
    e = np.zeros((n, 2))
    e[:, 1] = np.clip(tagger.bias + np.array(cues), -30, 30)
    a = [tagger.start + e[0]]
    for j in range(1, n):
        a.append(np.logaddexp(a[-1][0] + tagger.trans[0], a[-1][1] + tagger.trans[1]) + e[j])
    b = [np.zeros(2)]
    for j in range(n - 1, 0, -1):
        x = e[j] + b[0]
        b.insert(0, np.logaddexp(tagger.trans[:, 0] + x[0], tagger.trans[:, 1] + x[1]))
    m = np.array(a) + np.array(b)
    return np.exp(m - np.logaddexp(m[:, :1], m[:, 1:]))[:, 1]


def test_toxicity_against_brute_force(spark, sf, docs):
    """Scores and spans of the query are those of sums over every word of every text, under the model that the labels give."""
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    tagger = toxicity.train(frame, spark.read.parquet(f"{sf}/labels.parquet"))
    assert tagger.weights
    want = Counter()
    for d in docs:
        seq = [m[0].lower() for m in toxicity.WORD.finditer(d[1] or "")]
        cues = [tagger.cue(w) for w in seq]
        p = full_marginals(tagger, cues) if seq else np.zeros(0)
        p = p[[i for i, c in enumerate(cues) if c]]
        want[d[0], round(tagger.score(p), 6), int((p >= 0.5).sum())] += 1
    got = Counter((r["doc_id"], round(r["score"], 6), r["n_spans"]) for r in toxicity.op2_toxicity(spark, sf).collect())
    assert got == want
    empty = {r["doc_id"]: r["score"] for r in toxicity.op2_toxicity(spark, sf).collect()}
    assert empty[64] == empty[65] < 0.5  # null and empty


def test_toxicity_gradient_counts_sentences():
    """Equal sentences by number, in blocks, give the gradient of all sentences one by one."""
    rows = [((0,), (), (1,)), ((), ()), ((), (), (), ())]
    tags = [[1, 0, 1], [0, 0], [0, 0, 0, 0]]
    times = [3, 5, 2]
    args = (np.array([0.4, -0.2]), -1.5, np.array([[0.3, -0.1], [0.2, 0.5]]), np.array([0.1, -0.3]))
    one = toxicity.Block(rows, tags, np.array(times, float)).gradient(*args)
    many = toxicity.Block([r for r, n in zip(rows, times) for _ in range(n)], [t for t, n in zip(tags, times) for _ in range(n)], np.ones(10)).gradient(*args)
    parts = [toxicity.Block([r], [t], np.array([float(n)])).gradient(*args) for r, t, n in zip(rows, tags, times)]
    for k in range(4):
        assert np.allclose(one[k], many[k]) and np.allclose(one[k], sum(p[k] for p in parts))


def test_toxicity_spans_of_any_text():
    tagger = toxicity.Tagger({"=idiot": 9.0}, -4.0)
    cues = toxicity.Memo(tagger.cue)
    for text in ("idiot here", "\u0130 idiot here", "\u0130IDIOT idiot"):
        spans = tagger.tag(text, cues)[1]
        assert [text[a:b].lower() for a, b in spans] == ["idiot"]


PAGE = "page_id long, url string, html string, digest string, payload string"


def test_warc(spark, tmp_path):
    big = "<p>" + "x" * 1200
    rows = [(1, "http://a b/", big, "d", "p"), (9, "http://c/", big, "d", "p"), (4, None, big + "é", "d", "p"), (2, "u", "s", "d", "p"), (3, "u", "s", "d", "p"), (5, "u", None, "d", "p"), (None, "u", big, "d", "p"), (4, None, big + "é", "d", "p"), (7, "u", "\x1f\x8b\x08 not a record" * 90, "d", "p")]
    spark.createDataFrame(rows, PAGE).repartition(2).write.parquet(str(tmp_path / "pages.parquet"))
    want = Counter()
    for i, _, h, *_ in rows:
        data = (h or "").encode()
        again = len(data) >= 1000 and h == big and i != 9
        want[(i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", 9 if again else None)] += 1
    assert Counter(tuple(r) for r in warc.op4_warc(spark, str(tmp_path)).collect()) == want
    manifest = warc.write(spark.read.parquet(str(tmp_path / "pages.parquet")), shared_dir(spark, "warc"))
    for split in (1, 7, 300, 1 << 20):
        got = warc.read_archives(manifest, split).collect()
        assert len(got) == len(rows)
        assert {bytes(r["payload"]) for r in got if r["record_type"] == "response"} == {(r[2] or "").encode() for r in rows}


def test_packing(spark, sf, docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.vocabulary())
    want = Counter()
    for d in docs:
        ids = [*tok.encode(d[1] or "", add_special_tokens=False).ids, 0]
        for n, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want[(d[0], n, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    got = packing.op5_packing(spark, sf).collect()
    assert Counter(tuple(r)[:5] for r in got) == want
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in places.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= 1.1 * sum(r["length"] for r in got) / 2048 + 2


@pytest.mark.parametrize("histogram", [{}, {1: 5}, {2048: 3}, {700: 1000}, {1025: 7, 1023: 9, 1: 4}, {k: 1 + k % 3 for k in range(1, 2049)}])
def test_packing_plan_holds_all(histogram):
    runs = packing.plan(histogram)
    ranks = Counter()
    for n, low, high, *_ in runs:
        ranks[n] += high - low
    assert +ranks == Counter(histogram)


def test_tokenizer_odd_characters():
    from tokenizers import Tokenizer

    tok, own = Tokenizer.from_file(packing.vocabulary()), packing.tokenizer(packing.vocabulary())
    rnd = random.Random(3)
    chars = [chr(c) for c in range(0x250)] + ["a", "'s", "_", "1", " ", "the", "ing", "<|endoftext|>", "%%%", "Σ", "́"] * 20
    odd = ["".join(rnd.choice(chars) for _ in range(rnd.randint(0, 14))) for _ in range(3000)]
    for text, data in zip(odd, own.encode(odd), strict=True):
        assert np.frombuffer(data, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids


def test_packing_writes_only_its_pieces(spark, sf, monkeypatch):
    written = []
    monkeypatch.setattr(packing, "materialise", lambda df, name, f=packing.materialise: written.append(name) or f(df, name))
    packing.op5_packing(spark, sf)
    assert written == ["pack-pieces"]


def test_tokenizer_stays_small(monkeypatch):
    import tracemalloc

    monkeypatch.setattr(packing, "KEPT", 40_000, raising=False)
    own = packing.WordTokenizer(packing.vocabulary())
    assert "library" not in vars(own)  # plain texts don't need it
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choices("abcdefghij", k=3000))
    for _ in range(30):
        own.encode([f"the {word()} end"])
    assert sum(map(len, own.known)) <= 40_000  # letters are bounded, not only words
    for _ in range(30):
        own.encode([f"\u0370{word()}"])
    assert sum(map(len, own.odd)) <= 40_000
    text = "of the time " * 10_000
    own.encode([text])
    tracemalloc.start()
    got = own.encode([text] * 60)
    peak = tracemalloc.get_traced_memory()[1] - sum(map(len, got))
    tracemalloc.stop()
    assert peak < 60_000_000  # not all texts' words at once
    assert len(set(got)) == 1


def test_tokenizer_plain_characters():
    from tokenizers import Tokenizer

    tok, own = Tokenizer.from_file(packing.vocabulary()), packing.tokenizer(packing.vocabulary())
    plain = [chr(c) for c in range(0x180) if not packing.ODD.search(chr(c))]
    pairs = [a + b for a in plain for b in plain] + [a + b + c for a in "a'. é" for b in plain for c in ("s", "'ll", "'m")]
    for text, data in zip(pairs, own.encode(pairs), strict=True):
        assert np.frombuffer(data, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids


def test_html_extract(spark, tmp_path):
    html = '<html><head><title>t</title><style>p{}</style></head><body><header>Site</header><nav><ul><li><a href="/a">One</a></li></ul></nav><div class="ad">Buy it</div><article><h1>Head  &amp; line</h1><p>First\n <b>bold</b> para&nbsp;graph of text.<p>Second &lt;one&gt; here<br>goes on.</p><form>mail</form><div class="comments"><p>Nice!</p></div></article><footer>f</footer></body></html>'
    rows = [(1, "u", html), (2, "u", None), (3, "u", ""), (4, "u", "<script>x</script>"), (1, "u", html)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    text = "Head & line\nFirst bold para graph of text.\nSecond <one> here goes on."
    want = Counter([(1, "u", text, len(text)), (1, "u", text, len(text)), *((i, "u", "", 0) for i in (2, 3, 4))])
    assert Counter(tuple(r) for r in html_extract.op6_html_extract(spark, str(tmp_path)).collect()) == want


def brute_components(ids, linked):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                parent[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(ids))]


def brute_fingerprint(text):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("crowd", [4096, 1])
def test_simhash(spark, sf, docs, crowd, monkeypatch):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    fps = [brute_fingerprint(d[1]) for d in docs]
    low = brute_components([d[0] for d in docs], lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    want = Counter((d[0], f"{f:016x}", c) for d, f, c in zip(docs, fps, low, strict=True))
    assert Counter(tuple(r) for r in simhash.op7_simhash(spark, sf).collect()) == want


def test_simhash_classes_on_chains(spark):
    rng = np.random.default_rng(0)
    fps = []
    for base in rng.integers(0, 2**63, 15, dtype=np.uint64):
        x = int(base)
        for _ in range(20):
            for _ in range(rng.integers(0, 4)):
                x ^= 1 << int(rng.integers(0, 64))
            fps.append(x)
    fps = list(dict.fromkeys(fps))
    signed = [int(x) for x in np.array(fps, np.uint64).view(np.int64)]
    root = {r["fp"]: r["root"] for r in simhash.classes(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()}
    want = brute_components(list(range(len(fps))), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    pairs = {(w, root.get(s, s)) for w, s in zip(want, signed, strict=True)}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_components_on_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 2000 + i) for i in range(200)] + [(5, 5), (None, 1)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(201)) and all(got[2000 + i] == 1000 for i in range(200))


@pytest.mark.parametrize("group", [1024, 7])
def test_substring_dedup(spark, sf, docs, group, monkeypatch):
    monkeypatch.setattr(substring_dedup, "GROUP_DOCS", group)
    owner = {}
    for d in docs:
        w = words(d[1])
        for i in range(len(w) - 12 if d[0] is not None else 0):
            k = tuple(w[i : i + 13])
            owner[k] = min(owner.get(k, d[0]), d[0])
    want = Counter()
    for d in docs:
        w = words(d[1])
        gone = [False] * len(w)
        for i in range(len(w) - 12 if d[0] is not None else 0):
            if owner[tuple(w[i : i + 13])] < d[0]:
                gone[i : i + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want[(d[0], len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in substring_dedup.op8_substring_dedup(spark, sf).collect()) == want


def test_substring_dedup_tells_long_words_and_orders_apart(spark, tmp_path):
    """Words and passages in the two orders of a Thue-Morse sequence, which polynomials modulo a power of two can't tell apart."""
    a = "".join("ab"[i.bit_count() % 2] for i in range(2048))
    b = "".join("ba"[i.bit_count() % 2] for i in range(2048))
    head = " ".join(f"h{i}" for i in range(12))
    rows = [(1, f"{head} {a}"), (2, f"{head} {b}"), (3, " ".join(a)), (4, " ".join(b)), (5, f"{head} {a} end"), (6, "\u00a0".join("abc")), (7, " ".join("abcdefghijklm") + "\x0b\x0c n")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.op8_substring_dedup(spark, str(tmp_path)).collect()}
    assert got[2] == 0 and got[5] == 13 and got[1] == got[3] == got[6] == got[7] == 0
    conn = duckdb.connect()
    conn.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert {(d, n) for d, _, n, _ in conn.execute(substring_dedup.SQL).fetchall()} == set(got.items())


def test_substring_spans_are_verified(spark, monkeypatch):
    """Labels that don't tell words apart are found out at the source's coordinates."""
    rnd = random.Random(1)
    rows = [(i, " ".join(f"{i}w{rnd.randrange(9**9)}" for _ in range(40))) for i in range(2)]

    def same(self, low, high):
        return np.ones((len(low), 2), np.uint64)

    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert substring_dedup.remove(df).count() == 2
    own = substring_dedup.Group([0, 1], [t.encode() for _, t in rows])
    monkeypatch.setattr(substring_dedup.Group, "labels", same)
    wrong = substring_dedup.Group([0, 1], [t.encode() for _, t in rows])
    hits = wrong.spans({substring_dedup.STRETCH: (np.ones((1, 2), np.uint64), np.array([[0, 0, 0]]))})
    assert len(hits) and all(a != b for a, b in zip(own.digests(hits[:, 0], hits[:, 1]), own.digests(hits[:, 3], hits[:, 1]), strict=True))
    grouped = substring_dedup.Grouped(df.coalesce(1), ["doc_id", "text"])
    claim = spark.createDataFrame([(0, 40, 13, 0, 0, bytes(own.digests(np.array([40]), np.array([13]))[0]))], substring_dedup.SPANS)
    with pytest.raises(ValueError, match="differ"):
        substring_dedup.verified(grouped, claim)


def test_license_scan(spark, sf, docs):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    got = Counter(tuple(r) for r in licenses.op9_license_scan(spark, sf).collect())
    want = Counter()
    for d in docs:
        w = word.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in d[1] or ""))

        def found(phrases, w=w):
            return [(i, label) for p, label in phrases.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]

        hits, more, tags = found(licenses.BASE), found(licenses.MORE), found({licenses.TAG: ""})
        at = [i for i, _ in hits]
        base = {x for _, x in hits}
        labels = base | {x for _, x in more} | ({"mit", "gpl", "zlib"} if tags else set())  # the one tagged text
        score = 1.0 if tags else 1 - 0.5 ** (len(hits) + 0.5 * len(labels - base)) if labels else 0.0
        want[(d[0], len(w), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score, False if tags else None)] += 1
    assert got == want


def test_license_choice():
    auto = licenses.automaton()

    def obliges(expression):
        return licenses.scan(f"SPDX-License-Identifier: {expression}".encode(), auto)[7]

    assert obliges("MIT OR GPL-2.0-only") is False and obliges("MIT AND GPL-2.0-only") is True
    assert obliges("(MIT OR Zlib) AND (LGPL-2.1+ OR MPL-2.0)") is True and obliges("GPL-2.0-only WITH Classpath-exception-2.0 OR ISC") is False
    assert obliges("") is None and licenses.scan(b"the mit license", auto)[7] is None
    wide = " AND ".join(f"(A{i} OR GPL-{i})" for i in range(4000))  # 2 ** 4000 alternatives
    assert obliges(wide) is False and licenses.scan(f"SPDX-License-Identifier: {wide}".encode(), auto)[5].count(",") == 4000


def test_license_expressions():
    assert licenses.expression("MIT OR Apache-2.0 AND GPL-2.0-only WITH Classpath-exception-2.0") == [{"MIT"}, {"Apache-2.0", "GPL-2.0-only with Classpath-exception-2.0"}]
    assert licenses.expression("(MIT OR BSD-3-Clause) AND Zlib */") == [{"MIT", "Zlib"}, {"BSD-3-Clause", "Zlib"}]
    assert licenses.expression("") == [] and licenses.expression("AND") == [] and licenses.expression("(MIT") == [{"MIT"}]


@pytest.mark.parametrize("homes", [1024, 16])
def test_embedding_dedup(spark, tmp_path, homes, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "HOMES", homes)
    monkeypatch.setattr(embedding_dedup, "VISITS", 2 * homes)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(150, 16))
    near = x[rng.integers(0, 12, 150)] + rng.normal(size=(150, 16)) * 0.12
    rows = [(i, v.astype(np.float32).tolist(), int(i % 3)) for i, v in enumerate(np.concatenate([x, near, near[:20], near[:20] * 2]))]
    odd = [(1000, None, 1), (1001, [0.0] * 16, 1), (1002, [float("nan")] * 16, 1), (1003, [None] * 16, 1), (1004, rows[0][1], None), (1005, [], 1), (None, rows[5][1], rows[5][2]), (5, rows[5][1], rows[5][2])]
    spark.createDataFrame([(*r, "c", "n") for r in rows + odd], "vec_id long, embedding array<float>, label int, code string, node string").repartition(2).write.parquet(str(tmp_path / "embeddings.parquet"))
    good = rows + odd[6:]
    y = np.array([r[1] for r in good], np.float64)
    y /= np.linalg.norm(y, axis=1)[:, None]
    label = np.array([r[2] for r in good])
    link = (y @ y.T >= 0.98) & (label[:, None] == label[None])
    np.fill_diagonal(link, False)
    low = brute_components([r[0] for r in good], lambda i, j: link[i, j])
    exact = embedding_dedup.near_groups(spark.read.parquet(str(tmp_path / "embeddings.parquet")), recall=1.0).collect()
    want = Counter((r[0], int(n), c) for r, n, c in zip(good, link.sum(1), low, strict=True)) + Counter((r[0], 0, r[0]) for r in odd[:6])
    assert Counter(tuple(r) for r in exact) == want  # the exact setting misses nothing
    got = embedding_dedup.op10_embedding_dedup(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) + len(odd)
    want = Counter((r[0], int(n), c) for r, n, c in zip(good, link.sum(1), low, strict=True)) + Counter((r[0], 0, r[0]) for r in odd[:6])
    found = Counter(tuple(r)[:3] for r in got)
    assert sum(r["n_links"] for r in got) >= 0.99 * link.sum() and sum(r["n_links"] for r in got) <= link.sum()
    assert sum((want - found).values()) <= 0.02 * len(got)


def test_embedding_dedup_of_many_lengths(spark, monkeypatch):
    """Vectors of lengths beyond those with codebooks of their own link as well."""
    monkeypatch.setattr(embedding_dedup, "GRIDS", 2)
    rows = [(100 * n + i, [1.0] * n + [0.001 * i], 1) for n in range(1, 9) for i in range(n + 2)]
    got = embedding_dedup.near_groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), recall=1.0).collect()
    assert {(r["vec_id"], r["n_links"], r["component_id"]) for r in got} == {(100 * n + i, n + 1, 100 * n) for n in range(1, 9) for i in range(n + 2)}


def test_embedding_visits_are_the_cells_within_budget():
    """The multi-sequence gives just the cells whose border cost is within the budget, nearest first, as the whole grid shows."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    grid = embedding_dedup.Grid(x, np.zeros(300), 300 * 4096)
    grid.budget = 0.02
    words = [len(h.book) for h in grid.halves]
    assert min(words) > 100 and embedding_dedup.book_size(4 * 10**8) == 2 * embedding_dedup.book_size(10**8)
    rows, cells, home = grid.visits(x[:40])
    for i in range(40):
        cost = grid.cost(np.repeat(x[i : i + 1], words[0] * words[1], 0), np.arange(words[0] * words[1]))
        mine = cells[rows == i]
        assert set(mine.tolist()) == set(np.flatnonzero(cost <= 0.02).tolist()) and (np.diff(cost[mine]) >= 0).all()
        assert home[rows == i].sum() == 1 and cost[mine[home[rows == i]]] == 0


def brute_pipeline(rows, tagger):
    """(doc_id, text) that each stage but the last leaves of rows (doc_id, text)."""
    out = []
    kept = []
    for d, t in rows:
        cues = [tagger.cue(m[0].lower()) for m in toxicity.WORD.finditer(t or "")]
        p = full_marginals(tagger, cues) if cues else np.zeros(0)
        if tagger.score(p[[i for i, c in enumerate(cues) if c]]) < 0.5:
            kept.append((d, t))
    out.append(kept)
    first = {}
    for d, t in kept:
        k = SPACE.sub(" ", t or "")
        if k not in first or (d is not None and (first[k][0] is None or d < first[k][0])):
            first[k] = (d, t)
    out.append(list(first.values()))
    sets = [brute_shingles(t) for _, t in out[-1]]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if alike(sets[i], sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(out[-1]):
        least.setdefault(find(i), []).append((d is None, d or 0, i))
    out.append([out[-1][min(x)[2]] for x in least.values()])
    owner = {}
    for d, t in out[-1]:
        w = words(t)
        for i in range(len(w) - 12 if d is not None else 0):
            k = tuple(w[i : i + 13])
            owner[k] = min(owner.get(k, d), d)
    cut = []
    for d, t in out[-1]:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - 12 if d is not None else 0):
            if owner[tuple(w[i : i + 13])] < d:
                gone[i : i + 13] = [True] * 13
        cut.append((d, " ".join(x for x, g in zip(w, gone, strict=True) if not g) if any(gone) else t))
    out.append(cut)
    return out


def test_pipeline_against_brute_force(spark, docs, tmp_path):
    """What every stage decides, and what run() packs, row by row."""
    from tokenizers import Tokenizer

    rows = [(d[0], d[1]) for d in docs] + [(1000 + i, t) for i, t in enumerate(near_texts())]
    df = spark.createDataFrame([(d, t, "en", "s", len(t or ""), "g", "x") for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long, score string, row string")
    df.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(d, 1, int("Idiot" in (t or ""))) for d, t in rows if d is not None], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    read = spark.read.parquet(str(tmp_path / "documents.parquet"))
    want = brute_pipeline(rows, toxicity.train(read, spark.read.parquet(str(tmp_path / "labels.parquet"))))
    at = read
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, at, str(tmp_path))
        assert out.columns == read.columns
        out.write.parquet(str(tmp_path / name))
        at = spark.read.parquet(str(tmp_path / name))
        got = Counter((r["doc_id"], r["text"]) for r in at.collect())
        if n in (1, 2):  # of equal or alike texts under one id any may stay
            assert Counter(d for d, _ in got.elements()) == Counter(d for d, _ in want[n]), name
        else:
            assert got == Counter(want[n]), name
    assert len(want[0]) < len(rows) and len(want[2]) < len(want[1]) < len(want[0]) and want[3] != want[2]
    tok, pieces = Tokenizer.from_file(packing.vocabulary()), Counter()
    for d, t in want[3]:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        for a in range(0, len(ids), 2048):
            pieces[d, a, zlib.crc32(np.array(ids[a : a + 2048], "<u4").tobytes())] += 1
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r["doc_id"], r["start"], r["ids_crc32"]) for r in packed) == pieces


def test_clashing_column_names(spark):
    """Columns of documents that are named as the operators' own come out as they went in."""
    names = ["doc_id", "text", "lang", "source", "n_chars", "group", "_group", "__group", "score", "spans", "key", "__row", "row", "digest", "__digest", "__id", "__score", "Score", "g", "first", "root"]
    names = [x for i, x in enumerate(names) if x.lower() not in [y.lower() for y in names[:i]]]
    rnd = random.Random(4)
    rows = [(i, " ".join(f"w{rnd.randrange(50)}" for _ in range(30)), "en", "s", 90, *(f"{x}{i}" for x in names[5:])) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{x}` string" for x in names[5:]))
    for stage in (exact_dedup.DigestIndex(spark).keep, substring_dedup.remove, lambda d: corpus_pipeline.drop_near_copies(spark, d, ""), lambda d: toxicity.tag(d, toxicity.Tagger({}), d.columns, "a score", "a span").drop("a score", "a span")):
        out = stage(df)
        assert out.columns == names
        assert {tuple(r)[5:] for r in out.collect()} == {r[5:] for r in rows}


def test_pipeline(spark, sf, docs):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = spark.createDataFrame(stage(spark, df, sf).collect(), df.schema)
        assert out.columns == df.columns
        before, after = df.count(), out.count()
        if name == "exact_dedup":
            texts = [SPACE.sub(" ", r["text"] or "") for r in out.collect()]
            assert len(texts) == len(set(texts))
            texts_before = {SPACE.sub(" ", r["text"] or "") for r in df.collect()}
            assert set(texts) == texts_before
        if name == "substring_dedup":
            assert after == before
        df = out
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_sql(spark):
    duck = duckdb.connect()
    for t in ("documents", "pages"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    for query, sql in ((exact_dedup.op1_exact_dedup, exact_dedup.SQL), (warc.op4_warc, warc.SQL), (substring_dedup.op8_substring_dedup, substring_dedup.SQL)):
        cursor = duck.execute(sql)
        names = [d[0] for d in cursor.description]
        got = query(spark, "/root/testdata/sf0.001").select(*names).collect()
        assert Counter(tuple(r) for r in got) == Counter(cursor.fetchall())


def brute_shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def alike(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def near_texts():
    """Texts of 40 to 300 words with copies edited to similarities around 0.7 to 0.97, a common passage, and a large group of near copies."""
    rnd = random.Random(8)
    vocabulary = [f"v{i}" for i in range(3000)]
    texts = []
    for i in range(30):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randint(40, 300))]
        texts.append(" ".join(base))
        for share in (0.005, 0.01, 0.02, 0.03, 0.04):
            texts.append(" ".join(rnd.choice(vocabulary) if rnd.random() < share else w for w in base))
    passage = [rnd.choice(vocabulary) for _ in range(60)]
    texts += [" ".join([*passage, *(rnd.choice(vocabulary) for _ in range(rnd.randint(2, 40)))]) for _ in range(50)]
    hub = [rnd.choice(vocabulary) for _ in range(120)]
    for _ in range(90):
        copy = list(hub)
        for _ in range(rnd.randint(1, 4)):
            copy[rnd.randrange(120)] = rnd.choice(vocabulary)
        texts.append(" ".join(copy))
    texts += ["", "  ", None, "one two", "ONE two", "one two three four five"]
    rnd.shuffle(texts)
    return texts


@pytest.mark.parametrize("crowd", [32, 2])
def test_near_dedup(spark, crowd, monkeypatch):
    from sedimenta.llm import near_dedup

    monkeypatch.setattr(near_dedup, "CROWD", crowd)
    texts = near_texts()
    sets = [brute_shingles(t) for t in texts]
    low = brute_components(list(range(len(texts))), lambda i, j: alike(sets[i], sets[j]))
    assert sum(0.8 <= len(sets[i] & sets[j]) / len(sets[i] | sets[j]) <= 0.95 for i in range(len(sets)) for j in range(i)) > 50
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = [r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, df, "").collect()]
    assert sorted(got) == sorted(set(low))


def test_html_names_on_layout_wrappers():
    story = "<h1>Title</h1><p>One two three four five six.</p><p>Seven eight nine ten eleven.</p>"
    plain = "Title\nOne two three four five six.\nSeven eight nine ten eleven."
    menu = '<nav><a href="/">Home</a></nav><div class="sidebar"><p>Side words</p></div>'

    def text(body):
        return html_extract.Page(f"<html><body>{body}</body></html>").text(html_extract.DEFAULT)

    for kind in ("article", "main"):
        page = f'<div class="content-sidebar-wrap"><div class="page has-sidebar"><{kind} class="x">{story}</{kind}>{menu}</div></div>'
        assert text(page) == plain and html_extract.Page(page).main() is not None
    assert text(f'<div class="page has-sidebar"><article class="post no-comments">{story}</article>{menu}</div>') == plain
    assert text(f'<div class="post no-comments">{story}</div>{menu}') == plain
    assert text(f'<form id="search"><main>{story}</main></form>{menu}') == plain
    # Names still count on what isn't the content, with an article inside too.
    comments = '<div id="comments"><article class="comment"><p>Nice!</p></article><article><p>Not so nice, and at more length than all of the story is, by far, by very far, I would say, if asked.</p></article></div>'
    assert text(f"<article>{story}{comments}</article>") == plain
    assert text(f"<article>{story}</article><aside><article><p>Teaser</p></article></aside>{menu}") == plain
    related = f'<article>{story}</article><div class="related"><article><p>Teaser</p></article></div>'
    page = html_extract.Page(related)
    assert text(related) == plain and page.elements[page.main()][2] == 0


def test_html_names_kill_whole_containers_only():
    def text(body, learnt=frozenset()):
        return html_extract.Page(f"<html><body><article>{body}</article></body></html>", learnt).text(html_extract.DEFAULT)

    story = "<p>One two three four five six.</p>"
    for kept in ('<h2 id="related-work">Related work</h2>', '<p class="notice-board">Notice board</p>', '<div class="search-trees">Search trees</div>', '<p>Of <math><mi>x</mi><mo>=</mo><mn>2</mn></math></p>', '<span class="ad">word</span>'):
        assert text(story + kept).split("\n")[1:] == [" ".join(re.sub("<[^>]*>", "", kept).split())]
    for lost in ('<div class="ad">x</div>', '<div id="cookieNotice">x</div>', '<section class="post-comments">x</section>', '<ul class="menu main-menu"><li>x</ul>', '<svg><title>x</title></svg>', "<textarea>x</textarea>", "<form>x</form>"):
        assert text(story + lost) == "One two three four five six."
    assert text(f'{story}<div class="zq">x</div>', frozenset(["zq"])) == "One two three four five six."
    page = f'<html><body><div class="zq frame"><p>Stock rises</p></div><article><div class="frame">{story * 3}</div></article></body></html>'
    assert html_extract.learn([page] * 19)[1] == frozenset() and html_extract.learn([page] * 20)[1] == frozenset(["zq"])


def test_html_region_is_the_maximum_scoring_subsequence():
    rnd = random.Random(9)
    weights = {"word": 1.0, "link": -1.5, "tag": -1.0, "p": -0.5, "div": -2.5, "a": -0.5, "boiler": -1.0}
    for _ in range(200):
        body = "".join(rnd.choice(["<p>", "</p>", "<div>", "</div>", "<a>", "</a>", "one two ", "three ", "<hr>"]) for _ in range(rnd.randint(1, 40)))
        page = html_extract.Page(body)
        scores = [(piece, n * weights.get("boiler" if kind == "word" and page.elements[page.pieces[piece][1]][4] else kind, weights["tag"])) for piece, kind, n in page.kinds()]
        first, after = page.region(weights)
        got = max((sum(x for _, x in scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1) if scores[i][0] >= first and scores[j - 1][0] < after), default=0.0)
        best = max((sum(x for _, x in scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=0.0)
        assert abs(max(best, 0.0) - max(got, 0.0)) < 1e-9


@pytest.mark.parametrize("unit", ["<a ", "<b>", "<div>", "<p><b>", "<b><div></div>", "<article>", "<div class='ad'>", "<svg>", "<!--", "<a \" > \" ", "<", "</p><p>", "<math", "<title>x", "<a x='"])
def test_html_reads_in_linear_time(unit):
    import time

    source = "<p>first words here</p>" + unit * (1_000_000 // len(unit)) + " last"
    began = time.process_time()
    page = html_extract.Page(source)
    page.main()
    page.text(html_extract.DEFAULT)
    assert time.process_time() - began < 20


def test_license_tags_on_one_line_and_over_line_ends():
    auto = licenses.automaton()

    def labels(text):
        return licenses.scan(text.encode(), auto)[5]

    assert labels("SPDX-License-Identifier: MIT one two SPDX-License-Identifier: Zlib") == "mit,zlib"
    assert labels("/* SPDX-License-Identifier: MIT */ f(x); " * 2 + "// SPDX-License-Identifier: (ISC OR 0BSD) z") == "0bsd,isc,mit"
    assert labels("# SPDX-License-Identifier: (MIT OR\n#   Zlib)\n# AND Apache-2.0") == "mit,zlib"
    assert labels("// SPDX-License-Identifier: MIT OR\n// Zlib\n// or BSD-3-Clause") == "mit,zlib"
    assert labels("SPDX-License-Identifier: MIT\nand more") == "mit" and labels("SPDX-License-Identifier:\nMIT") == ""
    assert labels("SPDX-License-Identifier: SPDX-License-Identifier: MIT OR") == "mit"


def test_near_dedup_decides_by_row(spark):
    rnd = random.Random(2)
    a, b, c, d = ([f"x{rnd.randrange(9999)}" for _ in range(100)] for _ in range(4))
    # 7 stands for a near copy of 3 and for a text of its own; the two of id 1 are near copies; so are the two without an id.
    rows = [(3, a), (7, [*a, "end"]), (7, b), (1, c), (1, [*c, "end"]), (None, d), (None, [*d, "end"])]
    df = spark.createDataFrame([(i, " ".join(t), "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, df, "").collect()]
    assert Counter(i for i, _ in got) == Counter([3, 7, 1, None])
    assert (3, " ".join(a)) in got and (7, " ".join(b)) in got


def test_near_dedup_compares_in_proportion_to_rows(spark, monkeypatch):
    from sedimenta.llm import near_dedup

    rnd = random.Random(4)
    base = [f"v{rnd.randrange(9999)}" for _ in range(150)]
    copies = [[rnd.choice("xyz") + w if rnd.random() < rate else w for w in base] for rate in [0.01] * 200 + [0.05] * 40]
    rows = [(i, " ".join(t)) for i, t in enumerate(copies)]
    pairs, write = [], near_dedup.materialise

    def counting(df, name):
        out = write(df, name)
        pairs.append(out.count() if {"a", "b"} <= set(out.columns) else 0)
        return out

    monkeypatch.setattr(near_dedup, "materialise", counting)
    found = near_dedup.near_copies(spark.createDataFrame(rows, "__row long, text string").repartition(3)).collect()
    sets = [brute_shingles(t) for _, t in rows]
    low = brute_components(list(range(len(rows))), lambda i, j: alike(sets[i], sets[j]))
    assert {(r["row"], r["root"]) for r in found} == {(i, x) for i, x in enumerate(low) if low.count(x) > 1}
    assert 0 < max(pairs) <= 10 * len(rows)


@pytest.mark.parametrize("written", [True, False])
def test_near_dedup_leaves_no_intermediates(spark, tmp_path, written):
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    words = [f"x{i}" for i in range(100)]
    rows = [(i, " ".join([*words, *["end"] * (i % 2), *[f"y{i}-{k}" for k in range(100 * (i > 1))]]), "en", "s", 0) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    if written:
        df.write.parquet(f"{tmp_path}/docs")
        df = spark.read.parquet(f"{tmp_path}/docs")
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    kept = corpus_pipeline.drop_near_copies(spark, df, "")
    left = sorted(name.rsplit("-", 1)[0] for name in set(os.listdir(shared)) - before)
    assert left == (["near-copies"] if written else ["near-copies", "numbered"])
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 3, 4, 5]


def test_near_dedup_has_candidates_by_anchors(spark):
    from sedimenta.llm import near_dedup

    rnd = random.Random(6)
    texts = []
    for _ in range(30):
        base = [f"v{rnd.randrange(9999)}" for _ in range(600)]
        texts += [" ".join(base), " ".join([*base, "end"])]
    df = spark.createDataFrame(list(enumerate(texts)), "__row long, text string").repartition(3)
    base = near_dedup.profiles(df, np.array([], np.int64), np.array([], np.int64))
    got = {(r["a"], r["b"]) for r in near_dedup.by_anchor(base.select("row", "fp")).collect()}
    fp = [simhash.fingerprint(t.encode(), 5) for t in texts]
    low = brute_components(list(range(len(fp))), lambda i, j: (fp[i] ^ fp[j]).bit_count() <= 2)
    assert got == {(x, i) for i, x in enumerate(low) if x < i} and len(got) > 5
