"""Toxicity by a linear-chain conditional random field (operator 2).

Labels mark documents, so tokens are labelled first: a greedy cover finds the few words and beginnings of words, rare in clean
training documents, that explain the toxic ones; tokens of toxic documents that match them are toxic. A two-state chain per sentence
(or CHAIN words of a longer one) is then trained on these labelled tokens by gradient ascent on its likelihood, with features of the
word, its prefixes and suffix, and both neighbours. Forward-backward marginals give each word a probability; a logistic function of their
sum and their maximum, fitted on documents that the chain was not trained on, gives the document's score, and words above one half its
offending offsets.

Null and empty texts have the score of a text without words. Without labelled rows of both kinds every score is 0. A document labelled
twice counts as toxic if it once was; null labels and ids teach nothing. Repeated rows are scored each.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isthmus.llm.common import crc_not_held, dealt, raw, read, tidy

#: Bounds of the training sample: rows of either label, and characters of a text that it may hold. The driver gets no more.
N_TOXIC, N_CLEAN, MAX_CHARS = 900, 1800, 20_000
#: Words of a chain, and bytes of text scored at once; a sentence over such an end is two.
CHAIN, STRETCH = 256, 1 << 20
BUCKETS = 2**18
CACHE = 200_000
THRESHOLD = 0.7
WORD, SPACES = re.compile(rb"[^\x20\x09-\x0D]+"), re.compile(rb"[\x20\x09-\x0D]+")
EDGE = b".,!?;:\"'()[]{}#*$%&|<>"


def features(word: bytes) -> tuple[list[int], int]:
    """Buckets of a word's own features, and of its identity as a neighbour."""
    w = word.strip(EDGE).decode("utf-8", "replace").lower()
    own = [f"w{w}", f"3{w[:3]}", f"4{w[:4]}", f"5{w[:5]}", f"s{w[-3:]}"]
    return [zlib.crc32(x.encode()) % BUCKETS for x in own], zlib.crc32(f"n{w}".encode()) % BUCKETS


def ends_sentence(word: bytes) -> bool:
    return word[-1] in b".!?"


def chain_starts(ends: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True where a chain begins: at the words in ``first``, after a word that ends a sentence, and after every CHAIN words."""
    starts = np.r_[True, ends[:-1]] if len(ends) else np.empty(0, np.bool_)
    starts[first] = True
    at = np.flatnonzero(starts)
    since = np.arange(len(starts)) - np.repeat(at, np.diff(np.r_[at, len(starts)]))
    return since % CHAIN == 0


def sentence_starts(words: list[bytes]) -> np.ndarray:
    return chain_starts(np.fromiter(map(ends_sentence, words), np.bool_, len(words)), np.empty(0, np.int64))


class Chains:
    """Two-state forward-backward over many chains at once, longest first; state 0 has no emission."""

    def __init__(self, starts: np.ndarray) -> None:
        first = np.flatnonzero(starts)
        size = np.diff(np.r_[first, len(starts)])
        order = np.argsort(-size, kind="stable")
        self.first, self.size, self.n = first[order], size[order], len(starts)
        self.steps = int(self.size[0]) if len(size) else 0
        self.active = np.searchsorted(-self.size, -np.arange(1, self.steps + 1), side="right")  # chains with more than t words

    def marginals(self, u: np.ndarray, trans: np.ndarray, start: float) -> tuple[np.ndarray, np.ndarray, float]:
        """Marginals of state 1, expected transitions (2, 2), log partition. u: state 1's emission score of each word."""
        a, t = np.zeros(self.n), np.exp(trans)
        total = 0.0
        for k in range(self.steps):
            at = self.first[: self.active[k]] + k
            e = np.exp(np.minimum(u[at], 60))
            if k == 0:
                x0, x1 = np.ones(len(at)), np.exp(start) * e
            else:
                p = a[at - 1]
                x0, x1 = (1 - p) * t[0, 0] + p * t[1, 0], ((1 - p) * t[0, 1] + p * t[1, 1]) * e
            a[at] = x1 / (x0 + x1)
            total += np.log(x0 + x1).sum()
        m, pairs = a.copy(), np.zeros((2, 2))
        for k in range(self.steps - 2, -1, -1):
            at = self.first[: self.active[k + 1]] + k  # chains that go on
            f, q = a[at], m[at + 1]
            to0, to1 = (1 - f) * t[0, 0] + f * t[1, 0], (1 - f) * t[0, 1] + f * t[1, 1]
            from1 = (1 - q) * f * t[1, 0] / to0, q * f * t[1, 1] / to1
            m[at] = from1[0] + from1[1]
            pairs += [[((1 - q) - from1[0]).sum(), (q - from1[1]).sum()], [from1[0].sum(), from1[1].sum()]]
        return m, pairs, total


class Crf:
    def __init__(self) -> None:
        self.w = np.zeros((3, BUCKETS))  # own features, word before, word after
        self.bias, self.trans, self.start = -3.0, np.zeros((2, 2)), 0.0
        self.head = np.array([0.0, 0.0, -10.0])  # of log(1 + sum), max, bias

    def scores(self, own: np.ndarray, as_neighbour: np.ndarray) -> np.ndarray:
        """Per word type: own score, what it gives to the word after it, and to the word before it."""
        return np.stack([self.w[0][own].sum(1) + self.bias, self.w[1][as_neighbour], self.w[2][as_neighbour]], 1)

    @staticmethod
    def emissions(s: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        x = s[ids]
        u = x[:, 0].copy()
        inner = ~starts[1:]
        u[1:] += x[:-1, 1] * inner
        u[:-1] += x[1:, 2] * inner
        return u

    def fit(self, ids: np.ndarray, starts: np.ndarray, y: np.ndarray, own: np.ndarray, neighbour: np.ndarray, rounds: int = 60, rate: float = 0.5, decay: float = 1e-4) -> None:
        chains, grads = Chains(starts), [np.full_like(self.w, 1e-6), np.full((2, 2), 1e-6), 1e-6, 1e-6]
        inner = ~starts[1:]
        a, b = y[:-1][inner], y[1:][inner]
        real = np.array([[((a == i) & (b == j)).sum() for j in (0, 1)] for i in (0, 1)], float)
        types = len(own)
        for _ in range(rounds):
            m, pairs, _ = chains.marginals(self.emissions(self.scores(own, neighbour), ids, starts), self.trans, self.start)
            d = y - m
            g = np.zeros_like(self.w)
            per = np.bincount(ids, d, types)
            for j in range(own.shape[1]):
                g[0] += np.bincount(own[:, j], per, BUCKETS)
            g[1] += np.bincount(neighbour, np.bincount(ids[:-1], d[1:] * inner, types), BUCKETS)
            g[2] += np.bincount(neighbour, np.bincount(ids[1:], d[:-1] * inner, types), BUCKETS)
            g -= decay * self.w
            gt, gb, gs = real - pairs - decay * self.trans, d.sum(), d[starts].sum()
            grads[0] += g * g
            grads[1] += gt * gt
            grads[2] += gb * gb
            grads[3] += gs * gs
            self.w += rate * g / np.sqrt(grads[0])
            self.trans += rate * gt / np.sqrt(grads[1])
            self.bias += rate * gb / np.sqrt(grads[2])
            self.start += rate * gs / np.sqrt(grads[3])


def document_features(m: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """log(1 + sum) and maximum of the marginals, per document."""
    top = np.zeros(n)
    np.maximum.at(top, doc, m)
    return np.stack([np.log1p(np.bincount(doc, m, n)), top, np.ones(n)], 1)


def fit_head(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression with a small ridge, by Newton's method."""
    h = np.zeros(3)
    ridge = np.diag([1e-2, 1e-2, 1e-4])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ h, -40, 40)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (y - p)) - ridge @ h)
        h = h + step
        if np.abs(step).max() < 1e-6:
            break
    return h


def toxic_keys(docs: list[set[str]], toxic: np.ndarray, cover: int = 3) -> set[str]:
    """Few keys that explain the toxic documents: greedily, the key found in most toxic documents that are not yet covered
    ``cover`` times, among keys at over ten times the clean rate; ends when a key adds less than one in a hundred, or three."""
    df0: Counter = Counter()
    where: dict[str, list[int]] = {}
    for i, (keys, y) in enumerate(zip(docs, toxic, strict=True)):
        if y:
            for k in keys:
                where.setdefault(k, []).append(i)
        else:
            df0.update(keys)
    n1, n0 = max(1, int(toxic.sum())), max(1, int((1 - toxic).sum()))
    sets = {k: np.array(v) for k, v in where.items() if len(v) >= 3 and (len(v) + 0.5) / n1 > 10 * (df0[k] + 0.5) / n0}
    need, least, chosen = np.full(len(docs), cover), max(3, n1 // 100), set()
    while sets:
        gain = {k: int((need[v] > 0).sum()) for k, v in sets.items()}
        best = max(gain, key=lambda k: (gain[k], -len(k), k))
        if gain[best] < least:
            break
        chosen.add(best)
        need[sets.pop(best)] -= 1
        sets = {k: v for k, v in sets.items() if gain[k] >= least}  # gains only fall
    return chosen


def keys_of(word: bytes) -> tuple[str, ...]:
    """The word and its first letters, as candidates for what makes a token toxic."""
    w = word.strip(EDGE).decode("utf-8", "replace").lower()
    return (f"w{w}", *(f"{k}{w[:k]}" for k in (3, 4, 5) if len(w) > k))


def train(docs: DataFrame, labels: DataFrame, n_toxic: int = N_TOXIC, n_clean: int = N_CLEAN) -> Crf | None:
    """None if labelled rows of either kind are missing."""
    seen = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & crc_not_held()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    totals = {int(t > 0): n for t, n in seen.groupBy("toxic").count().collect()}
    # twice the rows are drawn, as some texts may be too long; both limits are total orders, so reruns agree
    drawn = seen.filter("toxic > 0").orderBy(F.xxhash64("doc_id", F.lit(2)), "doc_id").limit(2 * n_toxic).unionAll(seen.filter("toxic <= 0").orderBy(F.xxhash64("doc_id", F.lit(2)), "doc_id").limit(2 * n_clean))
    fit = docs.filter(F.length("text") <= MAX_CHARS).join(F.broadcast(drawn), "doc_id").select("doc_id", F.col("text").cast("string").alias("text"), (F.col("toxic") > 0).cast("int").alias("toxic"))
    order = (F.xxhash64("doc_id", "text", F.lit(2)), "doc_id", "text")
    rows = fit.filter("toxic = 1").orderBy(*order).limit(n_toxic).unionAll(fit.filter("toxic = 0").orderBy(*order).limit(n_clean)).collect()
    rows = sorted(((d, t.encode().split(), y) for d, t, y in rows if t), key=lambda r: (zlib.crc32(str(r[0]).encode()[::-1]), r[0]))
    rows = list({(tuple(r[1]), r[2]): r for r in rows if r[1]}.values())  # copies teach nothing
    toxic = np.array([r[2] for r in rows])
    if len(set(toxic.tolist())) < 2:
        return None
    index: dict[bytes, int] = {}
    ids = [np.array([index.setdefault(w, len(index)) for w in r[1]], np.int64) for r in rows]
    keys = [keys_of(w) for w in index]
    feats = [features(w) for w in index]
    own, neighbour = np.array([f[0] for f in feats]), np.array([f[1] for f in feats])
    fitted = np.arange(len(rows)) % 10 < 7
    if len(set(toxic[fitted].tolist())) < 2 or len(set(toxic[~fitted].tolist())) < 2:
        fitted[:] = True
    pick = np.flatnonzero(fitted)
    marked = toxic_keys([{x for i in np.unique(ids[k]) for x in keys[i]} for k in pick], toxic[pick])
    bad = np.array([any(x in marked for x in ks) for ks in keys])
    y = [(bad[ids[k]] & bool(toxic[k])).astype(float) for k in pick]
    starts = [sentence_starts(r[1]) for r in rows]
    crf = Crf()
    crf.fit(np.concatenate([ids[k] for k in pick]), np.concatenate([starts[k] for k in pick]), np.concatenate(y), own, neighbour)
    rest = np.flatnonzero(~fitted) if not fitted.all() else pick
    all_ids, all_starts = np.concatenate([ids[k] for k in rest]), np.concatenate([starts[k] for k in rest])
    m, _, _ = Chains(all_starts).marginals(crf.emissions(crf.scores(own, neighbour), all_ids, all_starts), crf.trans, crf.start)
    x = document_features(m, np.repeat(np.arange(len(rest)), [len(ids[k]) for k in rest]), len(rest))
    yr = toxic[rest]
    weight = np.where(yr == 1, totals.get(1, 1) / max(1, (toxic == 1).sum()), totals.get(0, 1) / max(1, (toxic == 0).sum()))
    crf.head = fit_head(x, yr, weight * len(weight) / weight.sum())
    return crf


class Types(dict):
    """Row of a word type in a growing table: scores, and whether it ends a sentence."""

    def __init__(self, crf: Crf) -> None:
        super().__init__()
        self.crf, self.rows, self.n = crf, np.zeros((1024, 4)), 0

    def __missing__(self, word: bytes) -> int:
        own, neighbour = features(word)
        if self.n == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        w = self.crf.w
        self.rows[self.n] = w[0][own].sum() + self.crf.bias, w[1][neighbour], w[2][neighbour], ends_sentence(word)
        self[word] = self.n
        self.n += 1
        return self.n - 1


def stretches(texts: list[bytes]):
    """Lists of (number, first byte, part) of at most STRETCH bytes together; a longer text comes in parts cut at white space."""
    some, size = [], 0
    for i, t in enumerate(texts):
        at = 0
        while at < len(t):
            end = len(t)
            if end - at > STRETCH:
                end = max(t.rfind(c, at, at + STRETCH) for c in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f")) + 1
                if end <= at:  # a longer word is not cut
                    m = SPACES.search(t, at + STRETCH)
                    end = m.end() if m else len(t)
            if some and size + end - at > STRETCH:
                yield some
                some, size = [], 0
            some.append((i, at, t[at:end]))
            size += end - at
            at = end
    if some:
        yield some


def offsets(part: bytes, bad: np.ndarray):
    """(start, end) of the bad words of a part, in characters."""
    at = chars = 0
    for k, w in enumerate(WORD.finditer(part)):
        if bad[k]:
            start = chars + len(part[at : w.start()].decode())
            at, chars = w.end(), start + len(w.group().decode())
            yield start, chars


SCHEMA = "doc_id long, held_out boolean, score double, predicted int, toxic_words double, spans array<struct<start:int,end:int>>"


def score(docs: DataFrame, crf: Crf | None) -> DataFrame:
    """docs (doc_id, text) with score, predicted, the expected number of toxic words and the offending spans as character offsets."""
    sent = docs.sparkSession.sparkContext.broadcast(crf)  # BUCKETS * 3 weights

    def marks(texts: list[bytes], model: Crf, types: Types):
        """Per text the expected number of toxic words, the greatest marginal, and the spans."""
        total, top, found = np.zeros(len(texts)), np.zeros(len(texts)), [[] for _ in texts]
        for some in stretches(texts):
            if len(types) > CACHE:
                types.clear()
                types.n = 0
            words = [part.split() for _, _, part in some]
            size = np.array([len(w) for w in words])
            ids = np.fromiter((types[w] for ws in words for w in ws), np.int64, int(size.sum()))
            if not len(ids):
                continue
            first = np.cumsum(size) - size
            starts = chain_starts(types.rows[ids, 3] > 0, first[size > 0])
            m = Chains(starts).marginals(model.emissions(types.rows, ids, starts), model.trans, model.start)[0]
            doc = np.repeat([i for i, _, _ in some], size)
            total += np.bincount(doc, m, len(texts))
            np.maximum.at(top, doc, m)
            piece = np.repeat(np.arange(len(some)), size)
            for k in np.unique(piece[m > 0.5]).tolist():
                i, at, part = some[k]
                before = len(texts[i][:at].decode()) if at else 0
                found[i] += [{"start": before + a, "end": before + b} for a, b in offsets(part, m[first[k] : first[k] + size[k]] > 0.5)]
        return total, top, found

    @tidy
    def run(batches):
        model = sent.value
        types = Types(model) if model else None
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                n = batch.num_rows
                p, expect, found = np.zeros(n), np.zeros(n), [[] for _ in range(n)]
                if model:
                    expect, top, found = marks([t or b"" for t in raw(batch.column(1))], model, types)
                    x = np.stack([np.log1p(expect), top, np.ones(n)], 1)
                    p = 1 / (1 + np.exp(-np.clip(x @ model.head, -40, 40)))
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32)), pa.array(np.asarray(expect, float)), pa.array(found, kind)], ["doc_id", "held_out", "score", "predicted", "toxic_words", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), (~crc_not_held()).alias("held_out")).mapInArrow(run, SCHEMA)


def op2_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, by a model of the labelled rows whose crc32(doc_id) mod 3 is not 1, with the offending spans."""
    docs = read(spark, sf_dir, "documents")
    return score(dealt(docs), train(docs.select("doc_id", "text"), read(spark, sf_dir, "labels").select("doc_id", "toxic")))
