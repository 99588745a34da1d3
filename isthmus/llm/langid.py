"""Language identification (operator 8).

A document is the average, over its words, of averaged hashed subword embeddings (fastText's bag: 1- to 4-grams of a word's letters with
its ends, and the word), followed by a linear softmax; embeddings and softmax are trained by stochastic gradient descent in numpy on a
bounded sample. The softmax's temperature is fitted, and the score below which a prediction is marked as rejected chosen, on a fifth of
the sample that training does not see. Tasks turn texts into features many at a time, without a step per word: the distinct words of a
stretch are found by hash, their n-grams hashed by shifted arrays, and, as all is linear up to the softmax, rows of the model summed.

Null texts and texts without a letter are `und` with score 0, as is every text where there is no labelled row to learn from. Ties between
languages go to the first in code-point order. Repeated rows are predicted each; rows without an id may not teach (their id counts as '').
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isthmus.llm import common
from isthmus.llm.common import crc_not_held, dealt, mix, read, tidy

BUCKETS, DIM, GRAMS = 2**17, 16, (1, 2, 3, 4)
#: Training sample: rows a language, rows in all (a language of very many has fewer, but one at least), and features of a row, the
#: heaviest. Texts stay on the executors; the driver gets at most TRAIN_ROWS * BAG * 8 bytes, or a row for each language.
PER_LANG, TRAIN_ROWS, BAG = 800, 8000, 4096
UNKNOWN = "und"
#: Characters whose features are made at once; a longer word counts as several.
STRETCH = 1 << 18

_OTHER, _LETTER, _SPACE, _NEW = 0, 1, 2, 3
_KIND = np.full(0x110000, _NEW, np.uint8)
_KIND[[32, 9, 10, 11, 12, 13]] = _SPACE


def kinds(codes: np.ndarray) -> np.ndarray:
    """Letter, white space or other, for each code point."""
    kind = _KIND[codes]
    if (new := kind == _NEW).any():
        for c in np.unique(codes[new]).tolist():
            _KIND[c] = _LETTER if chr(c).isalpha() else _OTHER
        kind = _KIND[codes]
    return kind


class Features:
    """The words of up to STRETCH characters of texts in lower case: the text of each word, which distinct word it is, and the
    distinct words' n-grams as buckets with their place among the words."""

    def __init__(self, texts: list[str]) -> None:
        codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        ends = np.cumsum([len(t) + 1 for t in texts])
        kind = kinds(codes)
        at = np.flatnonzero(kind == _LETTER)
        letters = codes[at].astype(np.uint64)
        word = np.cumsum(kind == _SPACE, dtype=np.int32)[at]  # white space before: other characters are left out of words
        start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(at) else np.empty(0, np.int64)
        size = np.diff(np.r_[start, len(at)])
        self.text = np.searchsorted(ends, at[start], side="right")
        up, down = common._powers()
        sums = np.zeros(len(at) + 1, np.uint64)
        np.cumsum((letters * np.uint64(0x9FB21C651E98DF25) ^ np.uint64(0x2545F4914F6CDD1D)) * up[: len(at)], out=sums[1:])
        hashed = mix((sums[start + size] - sums[start]) * down[start] + size.astype(np.uint64))
        self.hashes, first, self.word = np.unique(hashed, return_index=True, return_inverse=True)
        self.size, begin = size[first], start[first]
        # the distinct words, each between two ends
        self.first = np.cumsum(self.size + 2) - self.size - 2
        n = int((self.size + 2).sum())
        self.last = np.repeat(self.first + self.size + 2, self.size + 2)
        inside = np.arange(n) - np.repeat(self.first, self.size + 2)
        self.chars = np.empty(n, np.uint64)
        edge = (inside == 0) | (inside == np.repeat(self.size + 1, self.size + 2))
        self.chars[~edge] = letters[(np.repeat(begin, self.size + 2) + inside - 1)[~edge]]
        self.chars[inside == 0], self.chars[self.first + self.size + 1] = ord("<"), ord(">")
        self.edge = edge

    def grams(self):
        """For each length, and last the whole word: (bucket, whether it is one, first place of each word, last place)."""
        n, h = len(self.chars), np.zeros(len(self.chars), np.uint64)
        for k in range(1, max(GRAMS) + 1):
            m = max(0, n - k + 1)
            h = h[:m] * np.uint64(0xD6E8FEB86659FD93) + self.chars[k - 1 :]
            fine = np.arange(m) + k <= self.last[:m] if k > 1 else ~self.edge
            yield bucket(h, k), fine, np.minimum(self.first, m), np.minimum(self.first + self.size + 2, m)
        places = np.arange(len(self.size))
        yield bucket(self.hashes, 0), np.ones(len(places), np.bool_), places, places + 1

    def count(self) -> np.ndarray:
        """Features of each distinct word."""
        return 1 + self.size + sum(np.maximum(self.size + 3 - k, 0) for k in GRAMS if k > 1)

    def word_means(self, rows: np.ndarray) -> np.ndarray:
        """The average row of each distinct word's features."""
        out = np.zeros((len(self.size), rows.shape[1]))
        for b, fine, low, high in self.grams():
            upto = np.zeros((len(b) + 1, rows.shape[1]))
            np.cumsum(rows[b] * fine[:, None], axis=0, out=upto[1:])
            out += upto[high] - upto[low]
        return out / self.count()[:, None]


def bucket(h: np.ndarray, k: int) -> np.ndarray:
    return (mix(h + np.uint64(0x9E3779B97F4A7C15 * (k + 1) % 2**64)) & np.uint64(BUCKETS - 1)).astype(np.int64)


def stretches(texts: list[str | None]):
    """(numbers, texts) of at most STRETCH characters together, or so; longer texts come in several parts, cut at white space."""
    numbers, some, size = [], [], 0
    for i, t in enumerate(texts):
        low = (t or "").lower()
        while low:
            part, low = low, ""
            if len(part) > STRETCH:
                cut = max(part.rfind(c, 0, STRETCH) for c in " \n\t\r\v\f")
                part, low = part[: cut if cut > 0 else STRETCH], part[cut if cut > 0 else STRETCH :]
            if some and size + len(part) > STRETCH:
                yield numbers, some
                numbers, some, size = [], [], 0
            numbers.append(i)
            some.append(part)
            size += len(part) + 1
    if some:
        yield numbers, some


def averages(texts: list[str | None], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text the average, over its words, of its words' average rows; and how many words it has."""
    total, words = np.zeros((len(texts), rows.shape[1])), np.zeros(len(texts), np.int64)
    for numbers, some in stretches(texts):
        f = Features(some)
        mean = f.word_means(rows)[f.word]
        upto = np.zeros((len(mean) + 1, rows.shape[1]))
        np.cumsum(mean, axis=0, out=upto[1:])
        edges = np.searchsorted(f.text, np.arange(len(some) + 1))
        np.add.at(total, numbers, upto[edges[1:]] - upto[edges[:-1]])
        np.add.at(words, numbers, np.diff(edges))
    return total / np.maximum(words, 1)[:, None], words


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Buckets and their weights in the document's average; None without a letter."""
    total, n = np.zeros(BUCKETS), 0
    for _, some in stretches([text]):
        f = Features(some)
        each = np.bincount(f.word, minlength=len(f.size)) / f.count()
        for b, fine, low, high in f.grams():
            owner = np.repeat(np.arange(len(f.size)), high - low)
            total += np.bincount(b[: len(owner)][fine[: len(owner)]], each[owner[fine[: len(owner)]]], BUCKETS)
        n += len(f.word)
    b = np.flatnonzero(total)
    return (b, total[b] / n) if n else None


class Model:
    def __init__(self, langs: list[str]) -> None:
        rng = np.random.default_rng(7)
        self.langs, self.temperature, self.floor = langs, 1.0, 0.0
        self.embed = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
        self.out = np.zeros((DIM, len(langs)))

    def train(self, bags: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = 6, rate: float = 1.0) -> None:
        rng = np.random.default_rng(11)
        for epoch in range(epochs):
            step = rate * (1 - epoch / epochs)
            for i in rng.permutation(len(bags)):
                b, w = bags[i]
                x = w @ self.embed[b]
                p = softmax(x @ self.out)
                p[y[i]] -= 1
                self.embed[b] -= step * w[:, None] * (self.out @ p)
                self.out -= step * np.outer(x, p)

    def calibrate(self, logits: np.ndarray, y: np.ndarray, precision: float = 0.99) -> None:
        """Temperature of least log loss; the least score above which predictions are right at the given rate."""
        if not len(y):
            return
        grid = np.geomspace(0.05, 20, 60)
        loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
        self.temperature = float(grid[int(np.argmin(loss))])
        p = softmax(logits / self.temperature)
        best, right = p.max(1), p.argmax(1) == y
        order = np.argsort(-best)
        good = np.flatnonzero(np.cumsum(right[order]) >= precision * np.arange(1, len(y) + 1))
        self.floor = float(best[order][good[-1]]) if len(good) else 1.0

    def sent(self) -> tuple:
        """What tasks need: logits of each bucket, or its embedding and the softmax's weights where there are more languages than DIM."""
        out = self.out / self.temperature
        few = len(self.langs) <= DIM
        return (self.embed @ out if few else self.embed).astype(np.float32), np.eye(len(self.langs)) if few else out, self.langs, self.floor


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def sample(docs: DataFrame, per_lang: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(lang, buckets, weights) of about per_lang rows of each language that labels may be learnt from, spread by a hash of the row and
    in the order of that hash, so that reruns agree."""
    seen = docs.filter(crc_not_held() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.xxhash64("doc_id", "text", F.lit(8)).alias("h"))
    counts = seen.groupBy("lang").agg(F.count("*").alias("n"))
    langs = counts.count()  # the model has a class for each, so what is broadcast here is smaller than it
    mine = max(1, min(per_lang, TRAIN_ROWS // max(1, langs)))
    share = F.least(F.lit(1.0), F.lit(float(mine)) / F.col("n"))
    chosen = seen.join(F.broadcast(counts), "lang").filter((F.pmod("h", F.lit(1_000_000)) / 1e6 < share)).select("text", "lang", "h")

    @tidy
    def run(batches):
        for batch in batches:
            out = []
            for text, lang, h in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if found := bag(text):
                    b, w = found
                    if len(b) > BAG:
                        b, w = (x[np.sort(np.argsort(-w, kind="stable")[:BAG])] for x in (b, w))
                    out.append((lang, h, b.astype("<i4").tobytes(), w.astype("<f4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.string(), pa.int64(), pa.binary(), pa.binary()))], ["lang", "h", "b", "w"])

    rows = chosen.mapInArrow(run, "lang string, h long, b binary, w binary").orderBy("h", "lang", "b").limit(2 * mine * langs + 100).collect()
    return [(r.lang, np.frombuffer(r.b, "<i4").astype(np.int64), np.frombuffer(r.w, "<f4").astype(np.float64)) for r in rows]


def train(docs: DataFrame, per_lang: int = PER_LANG) -> Model | None:
    """None if there is no labelled row to learn from."""
    rows = sample(docs, per_lang)
    if not rows:
        return None
    model = Model(sorted({r[0] for r in rows}))
    y = np.array([model.langs.index(r[0]) for r in rows])
    held = np.arange(len(rows)) % 5 == 4
    model.train([r[1:] for r, h in zip(rows, held, strict=True) if not h], y[~held])
    model.calibrate(np.array([w @ model.embed[b] @ model.out for (_, b, w), h in zip(rows, held, strict=True) if h]).reshape(-1, len(model.langs)), y[held])
    return model


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs (doc_id, text) with held_out, lang_pred, score and rejected."""
    sent = docs.sparkSession.sparkContext.broadcast(model and model.sent())  # BUCKETS * min(languages, DIM)

    @tidy
    def run(batches):
        rows, out, langs, floor = sent.value or (np.zeros((BUCKETS, 1), np.float32), np.eye(1), [UNKNOWN], 0.0)
        names = np.array([*langs, UNKNOWN], object)
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                batch = whole.slice(lo, 1000)
                x, n = averages(batch.column(1).to_pylist(), rows)
                p = softmax(x @ out)
                known = (n > 0) & (sent.value is not None)
                best = np.where(known, p.argmax(1), len(langs))
                score = np.where(known, p.max(1), 0.0)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(names[best], pa.string()), pa.array(score), pa.array(score < floor)], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), (~crc_not_held()).alias("held_out")).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, by a model of the rows whose crc32(doc_id) mod 3 is not 1."""
    docs = read(spark, sf_dir, "documents")
    return predict(dealt(docs), train(docs.select("doc_id", "text", "lang")))
