"""Paths that only large or odd tables take, against brute force; and every operator and stage on empty tables and clashing columns."""

import hashlib
import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from isthmus.llm import common, html, langid, mixing, ngram_join, packing, quality, queries, substring, tokens, toxicity, vectors
from isthmus.llm.common import Scratch
from test_llm import SCHEMA, brute_components, texts


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(texts(), SCHEMA).repartition(3)


# ---------------------------------------------------------------- census, n-gram join, substrings


def test_census_marks_what_is_over_a_bound(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i, 400, 7))) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")

    def hashes(batch):
        for h in common.word_hashes(batch.column(1)):
            yield common.distinct(h)

    with Scratch(spark, "t") as s:
        picked = []
        maps = common.census(df, hashes, (1, 2, 4, 8), s, choose=lambda counts: picked.append(counts) or [1, 4])
        wide = common.census(df, hashes, (1,), s, common.WIDE_BITS)
    seen = Counter(w for _, t in rows for w in t.split())
    assert picked[0] == {b: sum(n > b for n in seen.values()) for b in (1, 2, 4, 8)}
    import pyarrow as pa

    words = sorted(seen)
    each = np.concatenate(list(common.word_hashes(pa.array(words))))
    for m, bound in ((maps[0], 1), (maps[1], 4), (wide[0], 1)):
        marked = common.in_bitmap(np.frombuffer(m, np.uint8), each)
        assert all(marked[i] for i, w in enumerate(words) if seen[w] > bound)
        assert sum(marked) <= sum(n > bound for n in seen.values()) + 2


@pytest.mark.parametrize("over", [(2, 4, 8), (1 << 15,) * 3])
def test_ngram_join_with_bounds_of_a_larger_corpus(spark, docs, monkeypatch, over):
    """However few shingles the bitmaps mark: the first bound says whether what they leave out may be shared."""
    monkeypatch.setattr(ngram_join, "bounds", lambda counts: list(over))
    with Scratch(spark, "t") as s:
        got = ngram_join.components(ngram_join.plain(docs), 4, 85, 100, s).select("doc_id", "n_shingles", "component_id").collect()
    order = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(map(tuple, got), key=order) == sorted(brute_components(texts(), 4, 85, 100), key=order)


def test_ngram_join_with_full_bitmaps_and_small_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "BITMAP_BITS", 8)
    monkeypatch.setattr(ngram_join, "FILL", 0)
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    monkeypatch.setattr(ngram_join, "SHARE", 2)
    with Scratch(spark, "t") as s:
        got = ngram_join.components(ngram_join.plain(docs), 5, 80, 100, s).select("doc_id", "n_shingles", "component_id").collect()
    order = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(map(tuple, got), key=order) == sorted(brute_components(texts(), 5, 80, 100), key=order)


def test_bounds_rise_with_the_corpus():
    few = dict.fromkeys(ngram_join.LADDER, 1000)
    many = {b: 2**32 // b for b in ngram_join.LADDER}
    assert ngram_join.bounds(few) == [1, 8, 128]
    assert ngram_join.bounds(many) == [256, 2048, 32768] and many[256] * common.FILL <= 2**common.BITMAP_BITS


def test_overlap_counts(spark):
    a, b = "a b c d e f g h i j", "a b c d e f x h i j"
    df = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    import pyarrow as pa

    ids = [ngram_join.class_id(ngram_join.shingles(h, 2)) for h in common.word_hashes(pa.array([a, b]), lower=True)]
    with Scratch(spark, "t") as s:
        rows = ngram_join.overlaps(ngram_join.plain(df), spark.createDataFrame([tuple(ids)], "a long, b long"), 2, s).collect()
        assert [(r.n, r.m, r.overlap) for r in rows] == [(9, 9, 7)]
        ok = [ngram_join.linked(spark.createDataFrame(rows, "a long, b long, n long, m long, overlap long"), num, 100).first().ok for num in (63, 64)]
    assert ok == [True, False]  # 7 of 11


def brute_windows(rows, window):
    low, out = {}, {}
    for i, t, *_ in rows:
        w = (t or "").split()
        if i is not None:
            for j in range(len(w) - window + 1):
                x = tuple(w[j : j + window])
                low[x] = min(low.get(x, i), i)
    for k, (i, t, *_) in enumerate(rows):
        w = (t or "").split()
        out[k] = set() if i is None else {j + o for j in range(len(w) - window + 1) if low[tuple(w[j : j + window])] < i for o in range(window)}
    return out


@pytest.mark.parametrize(("popular", "broadcast", "bits"), [(1, 0, 30), (1, 10**6, 8), (3, 0, 20)])
def test_substring_dedup_of_popular_windows(spark, docs, monkeypatch, popular, broadcast, bits):
    monkeypatch.setattr(substring, "POPULAR", popular)
    monkeypatch.setattr(substring, "BROADCAST_LOWS", broadcast)
    monkeypatch.setattr(substring, "WIDE_BITS", bits)  # 8: every bit is set
    with Scratch(spark, "t") as s:
        d = ngram_join.plain(docs)
        got = substring.digests(d, s.table(substring.repeats(d, 13, s), "f"), 13).collect()
    rows = texts()
    want = []
    for k, gone in brute_windows(rows, 13).items():
        w = (rows[k][1] or "").split()
        want.append((rows[k][0], len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_statistics_give_the_interval_of_the_longest_repeated_run():
    r = random.Random(5)
    held = [np.array([r.randint(1, 3) for _ in range(r.randint(5, 40))], np.uint64) for _ in range(12)]
    fm = substring.FmIndex(held)
    ends = np.concatenate([s + np.arange(len(h)) for s, h in zip(fm.starts, held, strict=True)])
    length, low, high = fm.statistics(fm.text, ends, 8, rows=2)
    where = Counter(tuple(h[i:j].tolist()) for h in held for i in range(len(h)) for j in range(i + 1, min(len(h), i + 8) + 1))
    k = 0
    for h in held:
        for e in range(len(h)):
            best = max((n for n in range(1, 9) if n <= e + 1 and where[tuple(h[e + 1 - n : e + 1].tolist())] > 1), default=0)
            assert length[k] == best
            assert best == 0 or high[k] - low[k] == where[tuple(h[e + 1 - best : e + 1].tolist())]
            k += 1


# ---------------------------------------------------------------- vectors


def planted(n, dim=32, pairs=300, cos=0.91, cone=0.0, seed=3):
    g = np.random.default_rng(seed)
    turn = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    u = turn(g.standard_normal((n, dim)))
    if cone:
        centre = turn(g.standard_normal((1, dim)))
        u[: n // 3] = np.sqrt(cone) * centre + np.sqrt(1 - cone) * turn(u[: n // 3] - (u[: n // 3] @ centre.T) * centre)
    picked = g.choice(n, pairs, replace=False)
    side = g.standard_normal((pairs, dim))
    side = turn(side - (side * u[picked]).sum(1, keepdims=True) * u[picked])
    return np.concatenate([u, cos * u[picked] + np.sqrt(1 - cos**2) * side]).astype(np.float32)


def brute_links(x, threshold=0.9):
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= threshold
    np.fill_diagonal(near, False)
    low = np.arange(len(x))
    while True:
        new = np.minimum(low, np.where(near, low[None], len(x)).min(1))
        if (new == low).all():
            return near.sum(1), low
        low = new


@pytest.mark.parametrize(("rows", "window"), [(2**17, 256), (0, 64)])
def test_projection_passes_recall(spark, monkeypatch, rows, window):
    """The passes alone, whole in a task and by ranges, on 5000 vectors: far more than a window."""
    for k, v in {"EXACT": 0, "PER_PASS": 0, "PASS_ROWS": rows}.items():
        monkeypatch.setattr(vectors, k, v)
    x = planted(4700)
    links = vectors.links
    monkeypatch.setattr(vectors, "links", lambda *a: links(*a, window=window))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>").repartition(4)
    with Scratch(spark, "t") as s:
        got = {r.vec_id: r for r in vectors.near_duplicates(df, 0.9, s).collect()}
    n, low = brute_links(x)
    linked = [i for i in range(len(x)) if n[i]]
    assert len(linked) >= 600
    assert np.mean([got[i].component_id == low[i] for i in linked]) >= 0.97
    assert all(got[i].n_links <= n[i] for i in range(len(x))) and sum(got[i].n_links for i in linked) >= 0.97 * n.sum()


def test_blocks_are_exact(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 256)
    x = np.concatenate([planted(900, pairs=200, cone=0.9), planted(100, pairs=10)[:50].repeat(3, 0)])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    with Scratch(spark, "t") as s:
        got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(df, 0.9, s).collect()}
    n, low = brute_links(x)
    assert got == {i: (n[i], low[i]) for i in range(len(x))}


def sql_cosine(x, y):
    dot = a = b = 0.0
    for p, q in zip(x, y, strict=True):
        dot, a, b = dot + p * q, a + p * p, b + q * q
    return dot / np.sqrt(a * b)


@pytest.mark.parametrize("n", [2000, 6000])
def test_no_link_depends_on_the_number_of_vectors(spark, n):
    """Pairs barely over the threshold, in tables below and above the size from which passes alone once decided."""
    x = planted(n, pairs=n // 2, cos=0.9005, seed=4)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>").repartition(4)
    with Scratch(spark, "t") as s:
        got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(df, 0.9, s).collect()}
    links, low = brute_links(x)
    assert got == {i: (links[i], low[i]) for i in range(len(x))}


def test_exact_check_finds_what_no_window_holds(spark, monkeypatch):
    """A window of one row, blocks smaller than the table in several files, vectors of two lengths, and a chain through all of them."""
    monkeypatch.setattr(vectors, "BLOCK", 64)
    links = vectors.links
    monkeypatch.setattr(vectors, "links", lambda *a: links(*a, window=1))
    x, t = planted(500, pairs=120), np.arange(150) * 0.4
    chain = np.stack([np.cos(t), np.sin(t), t * 0.05, np.ones(150)], 1).astype(np.float32)
    rows = [(i, v) for i, v in enumerate(x.tolist())] + [(1000 + i, v) for i, v in enumerate(chain.tolist())]
    with Scratch(spark, "t") as s:
        got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 0.9, s).collect()}
    (n, low), (m, down) = brute_links(x), brute_links(chain)
    assert got == {i: (n[i], low[i]) for i in range(len(x))} | {1000 + i: (m[i], 1000 + down[i]) for i in range(150)}


def test_ties_at_the_threshold_are_sqls(spark):
    """Cosines within a few roundings of 0.9: links, counts and the sum in order agree, whatever stands beside a pair."""
    g = np.random.default_rng(8)
    pairs, sides = [], set()
    while len(pairs) < 40:
        u, v = np.zeros((2, 8))
        u[:] = g.standard_normal(8)
        side = g.standard_normal(8)
        side -= side @ u / (u @ u) * u
        v[:] = 0.9 * u / np.linalg.norm(u) + np.sqrt(0.19) * side / np.linalg.norm(side)
        pairs += [u, v]
        sides.add(sql_cosine(u.tolist(), v.tolist()) >= 0.9)
    x = np.array(pairs)
    assert sides == {True, False}
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    with Scratch(spark, "t") as s:
        got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 0.9, s).collect()}
    near = np.array([[a != b and sql_cosine(u, v) >= 0.9 for b, v in enumerate(x.tolist())] for a, u in enumerate(x.tolist())])
    low = np.arange(len(x))
    for _ in x:
        low = np.minimum(low, np.where(near, low[None], len(x)).min(1))
    assert got == {i: (near[i].sum(), low[i]) for i in range(len(x))}


def test_codes_are_within_their_error():
    g = np.random.default_rng(1)
    for dim in (1, 3, 64, 77):
        x, fine = vectors.units(g.standard_normal((300, dim)) * 10.0 ** g.integers(-200, 200, (300, 1)))
        y, error = vectors.decoded(vectors.coded(x))
        assert fine.all() and (np.linalg.norm(x - y[:, :dim], axis=1) <= error).all() and not y[:, dim:].any()


# ---------------------------------------------------------------- quality rules


def labelled_corpus(n=4000):
    """Clean and shouting documents, with labels; enough of them that cutoffs are certified in one language."""
    r, rows, labels = random.Random(9), [], []
    for i in range(n):
        words = [f"w{r.randint(0, 5000)}" for _ in range(60)]
        bad = i % 5 == 0
        if bad:
            for k in range(0, 60, 2):
                words[k] += r.choice(["!!", "#", "!"])
        rows.append((i, " ".join(words), ("en", "de", None)[0 if i % 50 else r.randint(0, 2)], "s", 0))
        if i % 10 != 3:
            labels.append((i, int(not bad), 0))
    return rows, labels + [(0, 1, 0), (None, 1, 0), (n + 5, 1, 0), (7, None, 0)]


def test_quality_thresholds_certify_and_reject(spark, tmp_path):
    rows, labels = labelled_corpus()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = quality.op5_quality_rules(spark, str(tmp_path)).collect()
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    cols = ", ".join(quality.OUT)
    assert sorted(map(tuple, got)) == sorted(con.execute(f"SELECT {cols} FROM ({quality.OP5_SQL})").fetchall())
    rejected = [r.doc_id for r in got if not r.base_failed and not r.kept]
    assert len(rejected) > 700 and all(i % 5 == 0 for i in rejected)  # kept differs from not base_failed, and no clean document goes


def test_quality_thresholds_against_brute_force(spark):
    g = np.random.default_rng(2)
    seen = []
    for stratum, n in (("a", 3000), ("b", 3000), ("c", 40)):
        for i in range(n):
            good = i % 4 != 0
            seen.append((stratum, good, *(float(v) for v in g.beta(1, 40 if good else 4, len(quality.GRID)) * (3 if stratum == "b" and good else 1))))
    df = spark.createDataFrame(seen, "stratum string, good boolean, " + ", ".join(f"{m} double" for m in quality.GRID))
    got = {r.stratum: r.cutoffs for r in quality.thresholds(df, 0.06).collect()}
    want, tests = {}, sum(map(len, quality.GRID.values()))
    for s in "abc":
        mine = [r for r in seen if r[0] == s]
        for j, (m, grid) in enumerate(quality.GRID.items()):
            best = None
            for c in grid:
                n, k = sum(r[1] for r in mine), sum(r[1] and r[2 + j] > c for r in mine)
                bad, caught = len(mine) - n, sum(not r[1] and r[2 + j] > c for r in mine)
                p = 0.06 / len(quality.GRID)
                tail = 1.0 if k >= n * p else sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log(1 - p)) for i in range(k + 1))
                gain = caught / bad - 10 * k / n
                if tail <= quality.ERROR / (tests * 3) and gain > 0 and (best is None or (gain, c) > best):
                    best = (gain, c)
            if best:
                want.setdefault(s, {})[m] = best[1]
    assert got == want and want["a"] and "c" not in want


def test_quality_counts_of_symbols_and_lines(spark, docs):
    got = {(r.doc_id, r.text): r for r in quality.measured(docs.withColumn("n_words", F.lit("clash"))).collect()}
    for d, t, *_ in texts():
        lines = [x for x in (t or "").split("\n") if x.encode().split()]
        r = got[(d, t)]
        assert (r.n_symbols, r.n_dup_lines) == (sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)))
    few = spark.createDataFrame([(1, "a #b\n\n a\na #b\n|<>&%$*#\na #b", "en")], "doc_id long, text string, lang string")
    r = quality.measured(few).first()
    assert (r.n_symbols, r.n_dup_lines, r.n_lines) == (11, 2, 5)


# ---------------------------------------------------------------- packing and mixing


def test_pieces_are_those_of_the_tokenizer(spark, docs):
    """Every piece against the library, and the rule that only the first may be shorter."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(common.tokenizer_path("byte_bpe_50k.json"))
    by_doc = {}
    for r in packing.pieces(docs.filter("doc_id is not null").dropDuplicates(["doc_id"]), "byte_bpe_50k.json", 0, 64, with_ids=True).collect():
        by_doc.setdefault(r.doc_id, []).append(r)
    for d, text in {d: t for d, t, *_ in texts() if d is not None}.items():
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        parts = sorted(by_doc[d], key=lambda r: r.piece)
        assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in parts]).tolist() == ids
        at = 0
        for k, r in enumerate(parts):
            assert (r.piece, r.start, r.ids_crc32) == (k, at, zlib.crc32(r.ids)) and (k == 0 or r.length == 64)
            at += r.length
        assert len(parts) == -(-len(ids) // 64)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit_decreasing(seed):
    """As many sequences as best-fit decreasing over single pieces, slots that do not overlap, and every rank once."""
    r = random.Random(seed)
    lengths = [r.choice([r.randint(1, 100), r.randint(1, 20), 50, 33]) for _ in range(400)]
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [x for x in rooms if x >= n]
        if fits:
            rooms[rooms.index(min(fits))] -= n
        else:
            rooms.append(100 - n)
    places, ranks = {}, Counter()
    for length, lo, hi, first, k, at in packing.plan_bins(dict(Counter(lengths)), 100):
        for rank in range(lo, hi):
            ranks[length, rank] += 1
            places.setdefault(first + (rank - lo) // k, []).append((at + (rank - lo) % k * length, length))
    assert ranks == Counter((n, i) for n, c in Counter(lengths).items() for i in range(c))
    for b in places.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 100
    assert len(places) <= len(rooms) * 1.02 + 1


def test_taken_against_brute_force(spark, docs):
    """Each row's words: whole passes over its source in the order of the key, and a last one that ends at the budget."""
    with Scratch(spark, "t") as s:
        sized = s.table(docs.select("doc_id", "source", mixing.n_words(docs.text).alias("size")), "z")
        rows = mixing.with_taken(sized, mixing.cuts(sized, (3, 1, 2), 1.5, 2.0, s)).withColumn("key", mixing.key()).collect()
    for source in {r.source for r in rows}:
        mine = [r for r in rows if r.source == source]
        left = math.floor(mine[0].target + 1e-9)
        epochs, left = divmod(left, sum(r["size"] for r in mine))
        groups = {}
        for r in mine:
            groups.setdefault((r.key, r.doc_id is not None, r.doc_id or 0, r["size"]), []).append(r)
        for (_, _, _, size), same in sorted(groups.items()):
            more = min(size, left // len(same))
            assert all(r.taken == epochs * size + more for r in same)
            left -= size * len(same) if left >= size * len(same) else left


# ---------------------------------------------------------------- language, toxicity, pages


def test_features_against_a_step_per_word():
    some = ["Ab cd  ab\nÉtude 3x x3 !! a", "", "ЖЖ ß ǅ", "one-two l'eau ١ \U0001d400b"]
    f = langid.Features([t.lower() for t in some])
    plain = [[w for w in ("".join(c for c in w if c.isalpha()) for w in t.lower().split()) if w] for t in some]
    assert np.bincount(f.text, minlength=len(some)).tolist() == [len(w) for w in plain]
    words = [w for ws in plain for w in ws]
    assert len({(w, int(i)) for w, i in zip(words, f.word, strict=True)}) == len(set(words)) == len(f.size)
    grams = {w: {f"<{w}>"[i : i + k] for k in (2, 3, 4) for i in range(len(w) + 3 - k)} for w in words}
    for w, i in zip(words, f.word.tolist(), strict=True):
        assert f.count()[i] == 1 + len(w) + sum(max(len(w) + 3 - k, 0) for k in (2, 3, 4))
        assert len(grams[w]) <= f.count()[i]
    rows = np.random.default_rng(1).standard_normal((langid.BUCKETS, 3)).astype(np.float32)
    mean, n = langid.averages(some, rows)
    for t, x, k in zip(some, mean, n, strict=True):
        found = langid.bag(t)
        assert (found is None) == (k == 0) and (found is None or np.allclose(found[1] @ rows[found[0]], x, atol=1e-5))


def test_language_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(langid, "STRETCH", 64)
    rows = np.random.default_rng(1).standard_normal((langid.BUCKETS, 2)).astype(np.float32)
    some = ["alpha beta gamma delta " * 40, None, "x" * 500, "alpha beta gamma delta"]
    mean, n = langid.averages(some, rows)
    assert n.tolist() == [160, 0, 8, 4] and np.allclose(mean[0], mean[3])


def test_language_and_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    held = [r for r in langid.op8_language_id(spark, d).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect() if r.lang]
    assert len(held) > 3000 and np.mean([r.lang == r.lang_pred for r in held]) > 0.985
    rows = toxicity.op2_toxicity_crf(spark, d).filter("held_out").join(labels.filter("toxic is not null"), "doc_id").join(docs.select("doc_id", "text"), "doc_id").collect()
    caught = [r.predicted for r in rows if r.toxic]
    # about one label in nine says toxic of a text in which nothing is
    assert len(caught) > 50 and np.mean(caught) > 0.75 and np.mean([r.predicted for r in rows if not r.toxic]) < 0.01
    assert np.mean([r.predicted for r in rows if r.toxic and r.toxic_words > 1.5]) > 0.98
    assert all(r.spans for r in rows if r.predicted)
    words = Counter(r.text[s.start : s.end].strip(".,!?").lower()[:4] for r in rows for s in r.spans)
    assert all(len(r.text[s.start : s.end].split()) == 1 for r in rows for s in r.spans) and len(words) < 200


def test_toxicity_of_long_texts_and_offsets(spark, monkeypatch):
    crf = toxicity.Crf()
    own, neighbour = zip(*(toxicity.features(w) for w in (b"bad", b"good")), strict=True)
    crf.w[0][own[0]] = 3.0
    crf.head = np.array([1.0, 1.0, -2.0])
    monkeypatch.setattr(toxicity, "STRETCH", 50)
    text = "é good bad " * 30 + "good " * 600 + "bad"
    parts = list(toxicity.stretches([text.encode(), b"", b"z" * 200]))
    assert b"".join(p for some in parts for i, _, p in some if i == 0) == text.encode() and all(len(some) == 1 or sum(len(p) for *_, p in some) <= 50 for some in parts)
    starts = toxicity.chain_starts(np.zeros(1000, np.bool_), np.array([0, 300]))
    assert np.flatnonzero(starts).tolist() == [0, 256, 300, 556, 812]
    monkeypatch.undo()
    got = toxicity.score(spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string"), crf).orderBy("doc_id").collect()
    assert [text[s.start : s.end] for s in got[0].spans] == ["bad"] * 31 and got[1].spans == [] and got[1].score == got[2].score


def naive_density(node):
    """c, t, lc, lt of a node by recursion over nested lists (tag, children or text)."""
    c = t = lc = lt = 0
    for x in node[1]:
        if isinstance(x, str):
            c += len(x.replace(" ", ""))
        else:
            a = naive_density(x)
            c, t, lc, lt = c + a[0], t + a[1], lc + a[2], lt + a[3]
    if node[0] == "a":
        lc, lt = c, lt + 1
    return c, t + 1, lc, lt


@pytest.mark.parametrize("seed", range(8))
def test_densities_against_recursion(seed):
    r = random.Random(seed)

    def make(depth):
        if depth == 0 or r.random() < 0.3:
            return ("p", [" ".join("abcd" for _ in range(r.randint(1, 40))), *([("a", ["link text"])] if r.random() < 0.4 else [])])
        return ("div", [make(depth - 1) for _ in range(r.randint(1, 4))])

    page = ("div", [make(3) for _ in range(3)])
    show = lambda n: n if isinstance(n, str) else f"<{n[0]}>{''.join(map(show, n[1]))}</{n[0]}>"
    root = html.tree(f"<body>{show(page)}")
    order = html.measure(root)
    c, t, lc, lt = naive_density(page)
    share, found = lc / c, {}

    def walk(n, path=()):
        c, t, lc, lt = naive_density(n)
        d = c / t
        base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
        if base > 1 + 1e-9:
            d *= math.log(max(c / max(lc, 1) * t / max(lt, 1), 1.0)) / math.log(base)
        found[path] = d
        for i, x in enumerate(y for y in n[1] if not isinstance(y, str) and y[0] != "a"):
            walk(x, (*path, i))

    walk(page)
    mine = {}

    def number(x, path):
        mine[path] = x.density
        for i, y in enumerate(z for z in x.items if not isinstance(z, str)):
            number(y, (*path, i))

    number(root.items[0], ())
    assert mine.keys() == found.keys() and all(abs(mine[k] - found[k]) < 1e-9 for k in mine)
    best = html.densest(order)
    assert all(html.density_sum(x) <= html.density_sum(best) for x in order)


def test_pages_drop_what_says_it_is_no_article_and_nothing_else(spark):
    p, q = ("<p>" + "abcd " * 60 + x + "</p>" for x in "pq")
    wrap = lambda x: html.main_text(f"<body><nav><a href=a>x</a></nav><article><h1>H</h1>{p}{x}{q}</article>").replace("abcd ", "").split("\n\n")
    for gone in ('<p class="advert">x', '<p class="cookie-notice">x', "<p hidden>x", '<div class="comments"><p>x</p></div>', "<form>x</form>", '<div id="sidebar">x</div>', "<aside>x</aside>"):
        assert wrap(gone) == ["H", "p", "q"], gone
    for kept in ('<div class="legal">x</div>', "<section><p>x</p></section>", '<ul><li>x</ul>', "<blockquote>x</blockquote>"):
        assert wrap(kept) == ["H", "p", "x", "q"], kept
    assert wrap("<ul><li><a href=a>one</a><li><a href=b>two</a></ul>") == ["H", "p", "one", "two", "q"]
    long = "<p>" + "word &amp; " * 200_000
    rows = html.extract(spark.createDataFrame([(1, "u", None), (2, None, ""), (None, "v", long), (3, "w", "<div>" * 3000 + "deep")], "page_id long, url string, html string")).collect()
    by = {r.page_id: r for r in rows}
    assert (by[1].text, by[2].text, by[2].n_chars, by[3].text) == ("", "", 0, "deep") and by[None].n_chars == 200_000 * 7 - 1


# ---------------------------------------------------------------- empty tables, clashing columns, the pipeline

CLASH = "_h _row _cut __h __d __n h d none row doc document text2 words lines counts n_words size key bucket salt rank lo hi first k at copy rest packed windows cid comp".split()


def test_every_operator_on_an_empty_table(spark, tmp_path):
    e = f"{tmp_path}/e"
    schemas = {"documents": SCHEMA, "labels": "doc_id long, quality int, toxic int", "embeddings": "vec_id long, embedding array<float>, label int", "pages": "page_id long, url string, html string"}
    for t, schema in schemas.items():
        spark.createDataFrame([], schema).write.parquet(f"{e}/{t}.parquet")
    for name, query in {**queries.QUERIES, "pipeline": corpus_pipeline.run}.items():
        assert query(spark, e).count() == 0, name


def test_stages_keep_clashing_columns(spark, docs, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    odd = docs.withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id"), F.lit(-1)).cast("string")) for c in CLASH})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, str(tmp_path))
        if name != "best_fit_packing":
            assert out.columns == odd.columns, name
            rows = out.collect()
            assert rows and all(r[c] == f"{c}{-1 if r.doc_id is None else r.doc_id}" for r in rows for c in CLASH), name
        else:
            assert out.count() >= docs.count()


def test_operators_ignore_clashing_columns(spark, docs, tmp_path):
    odd = docs.withColumns({c: F.lit(c) for c in CLASH})
    with Scratch(spark, "t") as s:
        for df in (docs, odd):
            assert toxicity.score(df, None).count() == langid.predict(df, None).count() == packing.pieces(df, "byte_bpe_50k.json", 0, 10**6).count() == docs.count()
            assert ngram_join.components(ngram_join.plain(df), 4, 85, 100, s).count() == docs.count()
            store = tokens.write_token_store(df, f"file://{tmp_path}/s{len(df.columns)}", "word_bpe_49k.json", 1, s)
            assert tokens.read_token_store(store, f"file://{tmp_path}/s{len(df.columns)}").count() == docs.count()


def test_pipeline_against_brute_force(spark, docs, tmp_path):
    """Each stage on what the one before kept, against a plain computation of it."""
    from tokenizers import Tokenizer

    spark.createDataFrame([(0, 1, 0), (1, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    d, (first, near, cut, mix, pack) = str(tmp_path), (f for _, f in corpus_pipeline.STAGES)
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    with Scratch(spark, "t") as s:
        one = s.table(first(spark, docs, d), "1")
        rows = sorted(map(tuple, one.collect()), key=key)

        def fine(t):
            w = (t or "").split()
            tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
            n = Counter(tri)
            return len(w) >= 50 and 2 * len({i + o for i, x in enumerate(tri) if n[x] > 1 for o in range(3)}) <= len(w)

        assert rows == sorted((r for r in texts() if fine(r[1])), key=key)
        two = s.table(near(spark, one, d), "2")
        want = {c for _, n, c in brute_components(rows, 5, 80, 100) if n and c is not None}
        kept = sorted(map(tuple, two.collect()), key=key)
        assert sorted(r[0] for r in kept) == sorted(want) and set(kept) <= set(rows)
        three = s.table(cut(spark, two, d), "3")
        got = {r.doc_id: (r.text.split(), r.n_chars) for r in three.collect()}
        for k, gone in brute_windows(kept, 13).items():
            w = [x for j, x in enumerate(kept[k][1].split()) if j not in gone]
            assert got[kept[k][0]][0] == w
        four = s.table(mix(spark, three, d), "4")
        sized = three.select("doc_id", "source", mixing.n_words(F.col("text")).alias("size"))
        taken = {r.doc_id: r.taken for r in mixing.with_taken(sized, mixing.cuts(s.table(sized, "z"), (3, 1, 2), 1.5, 2.0, s)).collect()}
        words = Counter()
        for r in four.collect():
            words[r.doc_id] += len(r.text.split())
        assert words == Counter({k: v for k, v in taken.items() if v})
        five = pack(spark, four, d).collect()
        t = Tokenizer.from_file(common.tokenizer_path("byte_bpe_50k.json"))
        assert sum(r.length for r in five) == sum(len(t.encode(r.text, add_special_tokens=False).ids) + 1 for r in four.collect())
        fill = {}
        for r in five:
            fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert all(sum(n for _, n in b) == max(o + n for o, n in b) <= 2048 for b in fill.values())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    d, con = "/root/testdata/sf0.01", duckdb.connect()
    for t in ("documents", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    df = queries.QUERIES[name](spark, d)
    cols = sorted(df.columns)
    assert Counter(map(tuple, df.select(cols).collect())) == Counter(con.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLE[name]})").fetchall())


def test_a_cluster_without_a_shared_folder_is_an_error(spark, monkeypatch):
    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda *_: None)

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            getConf = staticmethod(lambda: {})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_folder(Session())


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_of_texts_with_special_strings(name):
    from tokenizers import Tokenizer

    path = common.tokenizer_path(name)
    plain, e = Tokenizer.from_file(path), tokens.Encoder(path)
    for t in ("a <|endoftext|> b", "<|startoftext|>A<|ENDOFTEXT|>", "x <| y |> <", "<|endoftext|>" * 3, "no such string"):
        assert np.frombuffer(e.ids(t), "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids


def test_an_idle_encoder_forgets(monkeypatch):
    import time

    import pyarrow as pa

    monkeypatch.setattr(tokens, "IDLE_S", 0.2)
    path = common.tokenizer_path("byte_bpe_50k.json")
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["one two three", None])], ["doc_id", "text"])
    first, enc = list(tokens.encoded(batch, path, 0)), tokens.encoder(path)
    assert len(enc.cuts)
    time.sleep(1)
    assert not len(enc.cuts) and not len(enc.pieces) and list(tokens.encoded(batch, path, 0)) == first


def test_kept_tables_can_be_dropped(spark, tmp_path):
    since = len(Scratch.left)
    with Scratch(spark, "t") as s:
        s.table(spark.range(3), "a", keep=True)
        path = f"{s.root}/{s.names[0]}"
    assert spark.read.parquet(path).count() == 3
    common.drop_kept(spark, since)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
