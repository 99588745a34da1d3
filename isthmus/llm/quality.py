"""Quality rules with risk-controlled thresholds (operator 5), in DataFrame functions only.

Six measures of a text grow with its faults. For each language (stratum), measure and cutoff of a fixed grid, the labelled good
documents that the cutoff would reject are counted, and an exact binomial test asks whether the rate of false rejections is below
RISK / measures: P(Bin(n, risk) <= k) <= ERROR / (measures * cutoffs * strata), a Bonferroni correction over every test. Of the
cutoffs so certified in a stratum, the one is used that rejects most labelled bad documents net of false rejections (which
weigh tenfold), the most lenient of equals. Strata with too few labels certify nothing and reject nothing beyond the base.

A null text has no words and fails the base; a null language is the stratum '' (as an empty one is). Repeated rows are judged each, and
count each among the labelled; labels of documents that are not there count nowhere. Empty tables give none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isthmus.llm.common import SPACE, Scratch, dealt, read

RISK, ERROR = 0.02, 0.05
#: Fixed grids of cutoffs, from strict to lenient; a document is rejected above the cutoff.
GRID = {
    "symbol_rate": (0.05, 0.1, 0.2, 0.3, 0.5, 0.8),
    "dup_line_rate": (0.1, 0.2, 0.3, 0.4, 0.5, 0.7),
    "repeat_rate": (0.1, 0.15, 0.2, 0.3, 0.4, 0.45),
    "shout_rate": (0.05, 0.1, 0.2, 0.3, 0.5, 0.8),
    "upper_rate": (0.1, 0.2, 0.3, 0.4, 0.6, 0.8),
    "long_word_rate": (0.05, 0.1, 0.2, 0.3, 0.5, 0.8),
}


def let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Words in 3-word windows found twice or more. Most texts have none, which the number of distinct hashes of their windows tells. In
    the others a window's hash gives up its low bits to the window's place; after sorting, equal hashes are neighbours, and the words
    themselves are compared. Linear but for the sort, for texts of any length."""

    def covered(w: Column) -> Column:
        n = F.size(w) - 2
        mask = F.pow(F.lit(2.0), F.length(F.bin(n)).cast("int")).cast("long") - 1

        def places(s: Column, m: Column) -> Column:
            at = lambda i: F.element_at(s, i + 1).bitwiseAND(m)  # noqa: E731  i from 0
            word = lambda p, j: F.element_at(w, (p + j + 1).cast("int"))
            high = lambda i: F.element_at(s, i + 1).bitwiseAND(F.bitwise_not(m))
            same = lambda i, k: (high(i) == high(k)) & (word(at(i), 0) == word(at(k), 0)) & (word(at(i), 1) == word(at(k), 1)) & (word(at(i), 2) == word(at(k), 2))
            found = F.filter(s, lambda x, i: ((i > 0) & same(i, F.greatest(i - 1, F.lit(0)))) | ((i + 1 < F.size(s)) & same(i, F.least(i + 1, F.size(s) - 1))))
            return F.sort_array(F.transform(found, lambda x: x.bitwiseAND(m)))

        def counted(hashes: Column) -> Column:
            coded = lambda m: F.transform(hashes, lambda h, i: h.bitwiseAND(F.bitwise_not(m)).bitwiseOR(i.cast("long")))
            found = let(mask, lambda m: let(F.sort_array(coded(m)), lambda s: places(s, m)))
            start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
            step = lambda a, p: F.struct((a["n"] + p + 3 - F.greatest(p, a["end"])).alias("n"), (p + 3).alias("end"))
            return F.when(F.size(F.array_distinct(hashes)) < n, F.aggregate(found, start, step, lambda a: a["n"])).otherwise(F.lit(0).cast("long"))

        windows = F.transform(F.slice(w, F.lit(1), n), lambda x, i: F.xxhash64(x, F.element_at(w, i + 2), F.element_at(w, i + 3)))
        return F.when(n >= 2, let(windows, counted)).otherwise(F.lit(0).cast("long"))

    return let(words, covered)


def count_of(text: Column, pattern: str) -> Column:
    return (F.size(F.split(text, pattern)) - 1).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the counts behind the measures, in place of columns of
    these names. A null text counts as empty, with zeros."""
    string = F.col("text").cast("string")
    text = F.coalesce(string, F.lit(""))
    words = F.filter(F.split(text, SPACE + "+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    first = docs.select(F.struct("*").alias("doc"), string.alias("text"), words.alias("words"), lines.alias("lines"))
    text = F.coalesce(F.col("text"), F.lit(""))
    counts = {
        "n_words": F.size("words").cast("long"),
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_symbols": count_of(text, r"[#*$%&|<>]"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "n_repeat_words": repeated_words(F.col("words")),
        "n_lines": F.size("lines").cast("long"),
        "n_shouts": count_of(text, "!"),
        "n_upper": count_of(text, r"\p{Lu}"),
        "n_long_words": F.size(F.filter("words", lambda w: F.length(w) > 40)).cast("long"),
    }
    return first.select(*(F.col("doc").getField(c).alias(c) for c in docs.columns if c not in counts), *(c.alias(n) for n, c in counts.items()))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rates() -> dict[str, Column]:
    per = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    return {"symbol_rate": per("n_symbols", "n_words"), "dup_line_rate": per("n_dup_lines", "n_lines"), "repeat_rate": per("n_repeat_words", "n_words"), "shout_rate": per("n_shouts", "n_words"), "upper_rate": per("n_upper", "word_chars"), "long_word_rate": per("n_long_words", "n_words")}


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), term by term in logarithms; 1 where k is not below the mean, which no test here passes."""
    start = F.struct((n * F.log(F.lit(1 - p))).alias("l"), F.exp(n * F.log(F.lit(1 - p))).alias("s"))

    def step(a: Column, i: Column) -> Column:
        term = a["l"] + F.log((n - i + 1) / i) + F.log(F.lit(p / (1 - p)))
        return F.struct(term.alias("l"), (a["s"] + F.exp(term)).alias("s"))

    upto = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.aggregate(upto, start, step, lambda a: a["s"]))


def thresholds(seen: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """stratum and a map of measure to certified cutoff, from seen (stratum, measures, good): one labelled row each. The
    result has a row per stratum and measure at most."""
    each = F.array(*(F.struct(F.lit(m).alias("measure"), F.lit(c).alias("cutoff"), (F.col(m) > c).alias("hit")) for m, g in GRID.items() for c in g))
    counts = seen.select("stratum", "good", F.explode(each).alias("t")).groupBy("stratum", "t.measure", "t.cutoff").agg(
        F.count_if("good").alias("n"), F.count_if(F.col("good") & F.col("t.hit")).alias("k"), F.count_if(~F.col("good")).alias("bad"), F.count_if(~F.col("good") & F.col("t.hit")).alias("caught")
    )
    strata = seen.agg(F.greatest(F.count_distinct("stratum"), F.lit(1)).alias("strata"))  # one row
    tests = sum(map(len, GRID.values()))
    fine = counts.crossJoin(F.broadcast(strata)).filter(binomial_tail(F.col("n"), F.col("k"), risk / len(GRID)) <= F.lit(error) / (tests * F.col("strata")))
    gain = F.try_divide("caught", "bad") - 10 * F.try_divide("k", "n")
    best = fine.withColumn("gain", gain).filter("gain > 0").groupBy("stratum", "measure").agg(F.max(F.struct("gain", "cutoff")).alias("b"))
    return best.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("measure", "b.cutoff"))).alias("cutoffs"))


def verdicts(counted: DataFrame, labels: DataFrame) -> DataFrame:
    """counted (from measured, with doc_id and lang) with base_failed and kept. A document labelled twice counts once, as the
    worse; labels that are null, and of documents that are not there, do not count."""
    marked = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg((F.min("quality") > 0).alias("good"))
    measures = counted.withColumns({"base_failed": base_failed(), "stratum": F.coalesce(F.col("lang"), F.lit("")), **rates()})
    seen = measures.filter(~F.col("base_failed")).join(marked, "doc_id").select("stratum", "good", *GRID)
    cut = thresholds(seen)
    over = [F.coalesce(F.col(m) > F.try_element_at("cutoffs", F.lit(m)), F.lit(False)) for m in GRID]
    rejected = over[0]
    for x in over[1:]:
        rejected = rejected | x
    # at most one row per stratum with labels; a shuffle join where languages are too many to broadcast
    joined = measures.join(F.broadcast(cut) if cut.limit(10_001).count() <= 10_000 else cut, "stratum", "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~rejected).drop("stratum", "cutoffs", *GRID)


OUT = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def counted_documents(docs: DataFrame, scratch: Scratch, keep: bool = False) -> DataFrame:
    return scratch.table(measured(docs).drop("text"), "counted", keep)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table of documents, with all labels of quality as the holdout."""
    with Scratch(spark, "op5") as scratch:
        counted = counted_documents(dealt(read(spark, sf_dir, "documents")).select("doc_id", "lang", "text"), scratch, keep=True)
        return verdicts(counted, read(spark, sf_dir, "labels").select("doc_id", "quality")).select(*OUT)


def kept_documents(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of docs that the rules keep, unchanged. Rows are told apart by id, language and a hash of their text; columns may have any
    names, as they travel in a struct."""
    keyed = docs.select(F.struct("*").alias("document"), "doc_id", "lang", F.col("text").cast("string").alias("text")).withColumn("h", F.xxhash64("text"))
    counted = scratch.table(measured(keyed.select("doc_id", "lang", "text", "h")).drop("text"), "counted")
    bad = scratch.table(verdicts(counted, labels.select("doc_id", "quality")).filter(~F.col("kept")).select("doc_id", "lang", "h").distinct(), "rejected", keep=True)
    a, b = keyed.drop("text").alias("a"), bad.alias("b")
    left = a.join(b, F.expr("a.h = b.h and a.doc_id <=> b.doc_id and a.lang <=> b.lang"), "left_anti")
    return left.select(*(F.col("document").getField(c).alias(c) for c in docs.columns))


def _sql() -> str:
    """The query in DuckDB SQL."""
    grid = ", ".join(f"('{m}', {c}::double)" for m, g in GRID.items() for c in g)
    tests, p = sum(map(len, GRID.values())), RISK / len(GRID)
    per = lambda a, b: f"coalesce({a}::double / nullif({b}, 0)::double, 0.0)"
    rate = {"symbol_rate": per("n_symbols", "n_words"), "dup_line_rate": per("n_dup_lines", "n_lines"), "repeat_rate": per("n_repeat_words", "n_words"), "shout_rate": per("n_shouts", "n_words"), "upper_rate": per("n_upper", "word_chars"), "long_word_rate": per("n_long_words", "n_words")}
    return f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text, row_number() OVER () AS id FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
g AS (SELECT id, i AS p, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t FROM (SELECT id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) > 2)),
r AS (SELECT id, p FROM (SELECT id, p, count(*) OVER (PARTITION BY id, t) AS n FROM g) WHERE n > 1),
c AS (SELECT id, count(DISTINCT p + o) AS n_repeat_words FROM r, (SELECT unnest([0, 1, 2]) AS o) GROUP BY id),
f AS (SELECT w.doc_id, stratum, len(w)::bigint AS n_words, length(array_to_string(w, ''))::bigint AS word_chars,
  (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint AS n_symbols, (len(l) - len(list_distinct(l)))::bigint AS n_dup_lines,
  coalesce(n_repeat_words, 0)::bigint AS n_repeat_words, len(l) AS n_lines, length(text) - length(replace(text, '!', '')) AS n_shouts,
  length(text) - length(regexp_replace(text, '\\p{{Lu}}', '', 'g')) AS n_upper, len(list_filter(w, lambda x: length(x) > 40)) AS n_long_words
  FROM w LEFT JOIN c USING (id)),
m AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {", ".join(f"{v} AS {k}" for k, v in rate.items())} FROM f),
q AS (SELECT doc_id, min(quality) > 0 AS good FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id),
s AS (SELECT m.*, good FROM m JOIN q USING (doc_id) WHERE NOT base_failed),
u AS (UNPIVOT (SELECT stratum, good, {", ".join(rate)} FROM s) ON {", ".join(rate)} INTO NAME measure VALUE v),
t AS (SELECT stratum, u.measure, cutoff, count(*) FILTER (good) AS n, count(*) FILTER (good AND v > cutoff) AS k, count(*) FILTER (NOT good) AS bad, count(*) FILTER (NOT good AND v > cutoff) AS caught
  FROM u JOIN (VALUES {grid}) g(measure, cutoff) ON u.measure = g.measure GROUP BY ALL),
x AS (SELECT *, CASE WHEN k >= n * {p!r} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({p!r}) + (n - i) * ln(1 - {p!r})))) END AS tail,
  caught::double / nullif(bad, 0) - 10 * (k::double / nullif(n, 0)) AS gain FROM t),
b AS (SELECT stratum, measure, arg_max(cutoff, (gain, cutoff)) AS cutoff FROM x WHERE tail <= {ERROR} / ({tests} * (SELECT greatest(count(DISTINCT stratum), 1) FROM s)) AND gain > 0 GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({" OR ".join(f"coalesce({k} > (SELECT cutoff FROM b WHERE b.stratum = m.stratum AND b.measure = '{k}'), false)" for k in rate)}) AS kept FROM m"""


OP5_SQL = _sql()
