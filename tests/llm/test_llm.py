"""The training-data operators on small tables with nulls, empties, ties, repeats and clashing columns, against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from isthmus.llm import common, langid, mixing, ngram_join, packing, quality, substring, tokens, toxicity, vectors
from isthmus.llm.common import Scratch
from isthmus.llm.html import main_text

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def texts() -> list[tuple]:
    r = random.Random(4)
    vocab = [f"w{i}" for i in range(300)] + ["Éa", "b.", "x\ny"]
    base = [" ".join(r.choice(vocab) for _ in range(r.choice([5, 20, 80, 300]))) for _ in range(60)]
    out = list(base)
    for t in base[:25]:
        w = t.split(" ")
        for k in (0, 1, 2):
            v = list(w)
            for _ in range(k):
                v[r.randrange(len(v))] = r.choice(vocab)
            out.append(" ".join(v))
    passage = " ".join(r.choice(vocab) for _ in range(60))
    out += [f"{t[:50]} {passage} tail{i}" for i, t in enumerate(base[30:40])]
    out += [None, "", "  \n ", "one", "One two", "one TWO three", "é" * 70_000, "a b " * 3000]
    rows = [(i, t, ("en", "de", None)[i % 3], (None, "s1", "s2", "s3")[i % 4], len(t or "")) for i, t in enumerate(out)]
    return rows + [rows[3], rows[3], (None, base[0], "en", "s1", 1), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(texts(), SCHEMA).repartition(3)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_whole_texts(name):
    e, r = tokens.encoder(common.tokenizer_path(name)), random.Random(1)
    some = ["".join(r.choice("ab É\n\n  .,'s1２ß\t ́Σσ<|endoftext|>漢😀\r") for _ in range(r.randint(0, 40))) for _ in range(1500)]
    for t, ids in zip(some, map(e.ids, some), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids


def test_word_hashes_equal_for_equal_words_only(monkeypatch):
    import pyarrow as pa

    for stretch in (64, 1 << 19):
        monkeypatch.setattr(common, "STRETCH", stretch)
        monkeypatch.setattr(common, "_POWERS", [])
        some, seen = [t for _, t, *_ in texts()], {}
        for t, h in zip(some, common.word_hashes(pa.array(some), lower=True), strict=True):
            words = t.encode().lower().split() if t is not None else []
            assert (h is None) == (t is None) and len(words) == (0 if h is None else len(h))
            for w, x in zip(words, () if h is None else h.tolist(), strict=True):
                assert len(w) > stretch or seen.setdefault(w, x) == x
        assert len(set(seen.values())) == len(seen)


def test_packing_is_gapless_and_tight(spark, docs):
    with Scratch(spark, "t") as s:
        made = s.table(packing.pieces(docs, "byte_bpe_50k.json", 0, 2048, with_ids=True), "p")
        rows = packing.pack(made, 2048, s).collect()
    bins = {}
    for x in rows:
        assert len(x.ids) == 4 * x.length and zlib.crc32(x.ids) == x.ids_crc32
        bins.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 2048
    total = sum(x.length for x in rows)
    assert len(bins) <= -(-total // 2048) * 1.1 + 1
    assert sum(x.piece == 0 for x in rows) == docs.count()


def test_token_store_round_trip(spark, docs, tmp_path):
    with Scratch(spark, "t") as s:
        folder = f"file://{tmp_path}/store"
        m = tokens.write_token_store(docs, folder, "word_bpe_49k.json", 1, s)
        rows = sorted(tokens.read_token_store(m, folder).collect(), key=lambda r: r.start)
        assert len(rows) == docs.count() and [r.doc_id is None for r in rows][:2] == [True, True]
        at, e = 0, tokens.encoder(common.tokenizer_path("word_bpe_49k.json")).tokenizer
        want = {d: e.encode(t or "", add_special_tokens=False).ids + [1] for d, t, *_ in texts() if d is not None}
        for r in rows:
            assert r.start == at and zlib.crc32(r.ids) == r.ids_crc32
            at += r.n_tokens
            assert r.doc_id is None or np.frombuffer(r.ids, "<u4").tolist() == want[r.doc_id]
        assert {r.doc_id for r in tokens.read_token_store(m, folder, frozenset({5, 7})).collect()} == {5, 7}
        empty = tokens.write_token_store(docs.limit(0), folder + "0", "word_bpe_49k.json", 1, s)
        assert tokens.read_token_store(empty, folder).count() == 0


def test_mix_meets_targets(spark, docs):
    with Scratch(spark, "t") as s:
        sized = s.table(docs.select("doc_id", "source", mixing.n_words(docs.text).alias("size")), "z")
        rows = mixing.with_taken(sized, mixing.cuts(sized, (3, 1, 2), 1.5, 2.0, s)).collect()
        words = sum(len((r.text or "").split()) for r in mixing.mixed_documents(docs.withColumn("size", docs.n_chars), (3, 1, 2), 1.5, 2.0, s).collect())
    size = {k: sum(r["size"] for r in rows if r.source == k) for k in {r.source for r in rows}}
    order = sorted((k for k in size if k is not None)) + [None]
    weight, fixed = {k: (3, 1, 2)[i % 3] for i, k in enumerate(order)}, {}
    while True:
        rest, w = 1.5 * sum(size.values()) - sum(fixed.values()), sum(weight[k] for k in order if k not in fixed)
        over = [k for k in order if k not in fixed and rest * weight[k] / w > 2 * size[k]]
        if not over:
            break
        fixed |= {k: 2.0 * size[k] for k in over}
    for k in order:
        target = fixed.get(k, rest * weight[k] / w)
        mine = [r for r in rows if r.source == k]
        assert all(abs(r.target - target) < 1e-6 and r.taken <= 2 * r["size"] and r.source_size == size[k] for r in mine)
        assert target - 5 <= sum(r.taken for r in mine) <= target
    assert words == sum(r.taken for r in rows)


def test_quality_counts(spark, docs):
    got = {(r.doc_id, r.text): r for r in quality.measured(docs).collect()}
    for d, t, *_ in texts():
        w = [x.decode() for x in (t or "").encode().split()]
        tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        n = {x: tri.count(x) for x in set(tri)} if len(w) < 4000 else {x: 2 for x in tri}
        rep = {i + o for i, x in enumerate(tri) if n[x] > 1 for o in range(3)}
        r = got[(d, t)]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(map(len, w)), len(rep))


def test_binomial_tail(spark):
    from math import comb

    from pyspark.sql import functions as F

    for n, k, p in ((50, 0, 0.05), (200, 3, 0.05), (1000, 9, 0.02)):
        want = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        got = spark.range(1).select(quality.binomial_tail(F.lit(n).cast("long"), F.lit(k).cast("long"), p)).first()[0]
        assert abs(got - want) < 1e-9


def brute_components(rows, k, num, den):
    def grams(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()

    sets = [grams(t) for _, t, *_ in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                up[root(i)] = root(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[root(i)] = min(low.get(root(i), r[0]), r[0])
    return [(r[0], len(s), low.get(root(i), r[0]) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets, strict=True))]


@pytest.mark.parametrize(("k", "num", "small"), [(4, 85, 10**6), (5, 80, 0)])
def test_ngram_join_is_exact(spark, docs, monkeypatch, k, num, small):
    monkeypatch.setattr(common, "SMALL_EDGES", small)
    with Scratch(spark, "t") as s:
        got = ngram_join.components(ngram_join.plain(docs), k, num, 100, s).select("doc_id", "n_shingles", "component_id").collect()
        kept = ngram_join.representatives(docs.withColumn("row", docs.n_chars), k, num, 100, s).collect()
    want = brute_components(texts(), k, num, 100)
    order = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)
    assert sorted(r.doc_id for r in kept if r.text and r.text.split()) == sorted({c for _, n, c in want if n and c is not None})


def test_ngram_join_looks_past_a_nearest_partner_that_failed(spark):
    """Parities of x and p differ least, but only x and q link; p is the pivot, so x-p and q-p are tested (and fail) first."""
    import pyarrow as pa

    words = [f"w{i}" for i in range(20_000)]
    hashed = [int(ngram_join.shingles(h, 1)[0]) for h in common.word_hashes(pa.array(words), lower=True)]
    low = [w for w, h in zip(words, hashed, strict=True) if h < 2**62]
    bit = {b: [w for w, h in zip(words, hashed, strict=True) if h >= 2**63 and h % 64 == b] for b in range(9)}
    core, a, b = low[:50], [bit[i][0] for i in range(5)], [bit[i][1] for i in range(5)]
    x = core + a + [bit[5][0]]
    p = core + b + [bit[5][1], bit[6][1]]
    q = core + a + [bit[6][0], bit[7][0], bit[8][0]]
    other = [f"z{i}" for i in range(500)] + b + p[-2:]  # makes all of p shared
    rows = [(i, " ".join(d)) for i, d in enumerate((x, p, q, other))]
    with Scratch(spark, "t") as s:
        got = ngram_join.components(ngram_join.plain(spark.createDataFrame(rows, "doc_id long, text string")), 1, 85, 100, s).select("doc_id", "n_shingles", "component_id").collect()
    want = brute_components(rows, 1, 85, 100)
    assert [c for _, _, c in want] == [0, 1, 0, 3]
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("popular", [1, 20_000])
def test_substring_dedup_is_exact(spark, docs, monkeypatch, popular):
    monkeypatch.setattr(substring, "POPULAR", popular)
    with Scratch(spark, "t") as s:
        d = ngram_join.plain(docs)
        got = substring.digests(d, s.table(substring.repeats(d, 13, s), "f"), 13).collect()
    rows, low = texts(), {}
    for i, t, *_ in rows:
        w = (t or "").split()
        if i is not None:
            for j in range(len(w) - 12):
                low[tuple(w[j : j + 13])] = min(low.get(tuple(w[j : j + 13]), i), i)
    want = []
    for i, t, *_ in rows:
        w, gone = (t or "").split(), set()
        if i is not None:
            gone = {j + o for j in range(len(w) - 12) if low[tuple(w[j : j + 13])] < i for o in range(13)}
        want.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_fm_index_matching_statistics():
    r = random.Random(2)
    held = [np.array([r.randint(1, 4) for _ in range(r.randint(0, 30))], np.uint64) for _ in range(20)]
    fm, text = substring.FmIndex(held), np.array([r.randint(1, 5) for _ in range(200)], np.uint64)
    runs = {tuple(h[i:j].tolist()) for h in held for i in range(len(h)) for j in range(i + 1, min(len(h), i + 12) + 1)}
    want = [max((k for k in range(1, 13) if k <= e + 1 and tuple(text[e + 1 - k : e + 1].tolist()) in runs), default=0) for e in range(200)]
    assert fm.matching_statistics(text, 12).tolist() == want


def test_vectors(spark):
    g = np.random.default_rng(1)
    base = g.standard_normal((40, 16))
    x = np.concatenate([base, base[:20] + 0.05 * g.standard_normal((20, 16)), np.repeat(base[:1], 30, 0)])
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [None] * 16), (905, [1.0, 2.0]), (None, x[0].tolist())]
    with Scratch(spark, "t") as s:
        got = {r.vec_id: r for r in vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 0.9, s).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    assert sum(got[i].n_links for i in range(len(x))) >= 0.9 * (near.sum() - len(x))
    assert all(got[i].n_links <= near[i].sum() - 1 for i in range(len(x)))
    assert all(got[i].n_links == 0 and got[i].kept for i in range(900, 906)) and got[60].component_id == 0


def test_vectors_in_a_cone(spark):
    """A third of all vectors within a cone of mutual cosine 0.75, and pairs at cosine 0.91 planted everywhere."""
    g, dim, n, cos = np.random.default_rng(5), 64, 9000, 0.91
    turn = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    centre = turn(g.standard_normal((1, dim)))
    u = turn(g.standard_normal((n, dim)))
    off = u[: n // 3] - (u[: n // 3] @ centre.T) * centre
    u[: n // 3] = np.sqrt(0.75) * centre + 0.5 * turn(off)
    picked = g.choice(n // 3, 400, replace=False)
    side = g.standard_normal((400, dim))
    side = turn(side - (side * u[picked]).sum(1, keepdims=True) * u[picked])
    v = np.concatenate([u, cos * u[picked] + np.sqrt(1 - cos**2) * side])
    with Scratch(spark, "t") as s:
        got = {r.vec_id: r.component_id for r in vectors.near_duplicates(spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "vec_id long, embedding array<double>"), 0.9, s).collect()}
    assert np.mean([got[n + i] == got[int(p)] for i, p in enumerate(picked)]) >= 0.99


def test_passes_follow_crowding():
    even, cone = np.zeros(65), np.zeros(65)
    even[10], cone[[10, 28]] = 1, (2, 1)
    assert vectors.passes_for(even, 0.9) < 30 < 100 < vectors.passes_for(cone, 0.9)


def test_language_and_toxicity(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    rows = langid.op8_language_id(spark, d).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 3!"), (None, "abc")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in langid.predict(odd, langid.train(docs)).collect() if r.doc_id} == {1: "und", 2: "und", 3: "und"}
    assert langid.train(docs.limit(0)) is None and toxicity.train(docs, labels.limit(0)) is None
    crf = toxicity.train(docs.select("doc_id", "text"), labels)
    got = toxicity.score(docs.select("doc_id", "text"), crf).join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.toxic for r in got]) > 0.9
    assert all(s.start < s.end for r in got for s in r.spans) and all(0 <= r.score <= 1 for r in toxicity.score(odd, crf).collect())


def test_crf_marginals_against_enumeration():
    from itertools import product

    g = np.random.default_rng(3)
    u, trans, start = g.standard_normal(5), g.standard_normal((2, 2)), 0.3
    m, pairs, z = toxicity.Chains(np.array([True, False, False, True, False])).marginals(u, trans, start)
    for a, b in ((0, 3), (3, 5)):
        w = {y: np.exp(y[0] * start + sum(u[a + i] * v for i, v in enumerate(y)) + sum(trans[y[i], y[i + 1]] for i in range(len(y) - 1))) for y in product((0, 1), repeat=b - a)}
        for i in range(b - a):
            assert abs(m[a + i] - sum(v for y, v in w.items() if y[i]) / sum(w.values())) < 1e-9


def test_pages():
    page = '<body><header><h1>Site</h1></header><nav><a href=a>x</a></nav><div class="content"><h2>T &amp; x</h2><p>Hello\n <a href=q>link</a>  world, a longer text.<p>Two</div><div class="comments"><p>bad</p></div><aside>s</aside><form>f</form><script>var a="</p>"</script><footer>foot'
    assert main_text(page) == "T & x\n\nHello link world, a longer text.\n\nTwo"
    assert [main_text(x) for x in (None, "", "<!-- a", "x < y", "<p>" * 20_000 + "z")] == ["", "", "", "x < y", "z"]


def test_pipeline_runs_on_odd_rows(spark, docs, tmp_path):
    spark.createDataFrame([(0, 1, 0), (1, 0, 1), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert rows and all(r.length <= 2048 for r in rows)


@pytest.mark.parametrize("outer", ["<article>", "<main><div>", '<div id="x1">', "<div><div>", ""])
def test_pages_keep_all_parts_of_the_article(outer):
    def p(name, size=250):
        return f"{name} " + "abcd " * (size // 4 - 2)

    def text(*blocks):
        return "\n\n".join(" ".join(b.split()) for b in blocks)

    ps, lis, short = [p(f"p{i}") for i in range(5)], [p(f"l{i}", 200) for i in range(10)], "Short one."
    nav = "<nav><a href=a>x</a> <a href=b>y</a></nav>"
    page = f"<body>{nav}{outer}<h1>Head</h1>" + "".join(f"<p>{x}</p>" for x in ps) + "<ul>" + "".join(f"<li>{x}</li>" for x in lis) + f"</ul><p>{short}</p>"
    assert main_text(page) == text("Head", *ps, *lis, short)
    one, two = [p(f"a{i}") for i in range(10)], [p(f"b{i}") for i in range(7)]
    parts = ["".join(f"<p>{x}</p>" for x in xs) for xs in (one, [*two, short])]
    assert main_text(f"<body>{nav}{outer}<h1>Head</h1><section>{parts[0]}</section><section><h2>Sub</h2>{parts[1]}</section>") == text("Head", *one, "Sub", *two, short)
    assert main_text(f"<body>{nav}{outer}<h1>Head</h1><div>{parts[0]}</div><div><h2>Sub</h2>{parts[1]}</div>") == text("Head", *one, "Sub", *two, short)
    assert main_text(f"<body>{nav}{outer}<p>{short}</p><p>{ps[0]}</p>bare {ps[1]}<blockquote>{parts[0]}</blockquote><p>{ps[2]}</p>") == text(short, ps[0], f"bare {ps[1]}", *one, ps[2])


def test_pages_leave_sparse_parts_beside_the_article():
    p = "<p>" + "abcd " * 60 + "</p>"
    page = f"<body><div><div>Tagline</div><div>{p * 6}</div><div><span>All</span> <b>rights</b> <i>reserved</i></div></div>"
    assert main_text(page) == "\n\n".join([" ".join(["abcd"] * 60)] * 6)
