"""Quality rules whose cutoffs keep a promise: few good documents are rejected, in every stratum.

Each rule rejects a document if a measure of its text lies above a cutoff. For each stratum (language) and each
cutoff of a fixed list, the labelled documents tell how many good ones would be rejected. A cutoff is certified if so few
rejections would be unlikely, by the exact binomial distribution, were the true share above the allowed one. The level is
divided by the number of all tests (rules, cutoffs, strata), so with probability 1 - ``DELTA`` all certified cutoffs keep the
promise at once, whichever are used. Of the certified ones that which tells bad from good best is used; a rule that tells
nothing, or has no certified cutoff, rejects nothing there.

All of it is DataFrame work: measures from array functions within the row, counts by aggregation, bounds by column arithmetic.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from emberlog.llm.text import table
from emberlog.session import stored

#: Good documents that all rules together may reject in a stratum, as a share, and the chance that this fails anywhere.
ALPHA = 0.04
DELTA = 0.05

#: Rule: measure (numerator, denominator), and its cutoffs.
RULES: dict[str, tuple[str, str, tuple[float, ...]]] = {
    "symbols": ("n_symbols", "word_chars", (0.01, 0.02, 0.05, 0.1, 0.2, 0.4)),
    "capitals": ("n_capitals", "word_chars", (0.1, 0.2, 0.3, 0.5, 0.7)),
    "same_lines": ("n_dup_lines", "n_lines", (0.1, 0.2, 0.3, 0.5, 0.7)),
    "repeats": ("n_repeat_words", "n_words", (0.02, 0.05, 0.1, 0.15)),
    "word_length": ("word_chars", "n_words", (8.0, 10.0, 15.0, 30.0)),
}

#: Terms of a binomial tail that are added one by one; what is left is bounded from above.
TAIL_TERMS = 100_000

_SPACE = " \t\n\x0b\x0c\r"
_GAP = r"[\x20\x09-\x0D]+"


def measures(docs: DataFrame) -> DataFrame:
    """(doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals) by row.

    A null text has no words, lines or characters. A null language is a stratum of its own, with the empty one.
    """
    width = 5
    text, words = F.coalesce("text", F.lit("")), F.col("words")
    one = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("stratum"), text.alias("text"))
    bare = F.btrim("text", F.lit(_SPACE))
    two = one.select(
        "doc_id", "stratum",
        F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, _GAP)).alias("words"),
        F.length(F.regexp_replace("text", _GAP, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("text", r"[^\p{Lu}]+", "")).cast("long").alias("n_capitals"),
        F.filter(F.split("text", "\n", -1), lambda line: F.btrim(line, F.lit(_SPACE)) != "").alias("lines"))
    some = F.size(words) >= width
    starts = F.when(some, F.sequence(F.lit(1), F.size(words) - (width - 1)))
    # equal windows have equal hashes: if all hashes differ, no window is found twice
    three = two.select("*", F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, width))).alias("hashes"))
    four = three.select("*", (F.size("hashes") > F.size(F.array_distinct("hashes"))).alias("again"))
    windows = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), F.array_join(F.slice(words, i + 1, width), " ").alias("w"), i.alias("i"))))
    five = four.select("*", F.when(F.col("again"), windows).alias("windows"))
    w = F.col("windows")

    def same(x: Column, other: Column) -> Column:
        return F.coalesce((other["h"] == x["h"]) & (other["w"] == x["w"]), F.lit(False))

    twice = F.filter(w, lambda x, k: same(x, F.get(w, k - 1)) | same(x, F.get(w, k + 1)))
    six = five.select("*", F.when(F.col("again"), F.sort_array(F.transform(twice, lambda x: x["i"]))).alias("at"))
    at = F.col("at")
    covered = F.aggregate(F.transform(at, lambda p, k: F.least(F.lit(width), F.coalesce(F.get(at, k + 1) - p, F.lit(width)))), F.lit(0), lambda a, b: a + b)
    return six.select(
        "doc_id", "stratum", F.size(words).cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"), F.size("lines").cast("long").alias("n_lines"), "n_capitals")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _log_factorial(n: Column) -> Column:
    """ln(n!), by Stirling's series eight places further on."""
    x = n + F.lit(9.0)
    series = (x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    for i in range(1, 9):
        series = series - F.log(n + F.lit(float(i)))
    return series


def log_tail(k: Column, n: Column, share: float) -> Column:
    """ln P(X <= k) for X binomial over n trials with that share, for k below the mean; never too small.

    The terms from k down are added; each is a known multiple of the one before and smaller than it. Beyond ``TAIL_TERMS`` of them, the last
    one stands for each that is left.
    """
    k, n = k.cast("double"), n.cast("double")
    top = _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * math.log(share) + (n - k) * math.log1p(-share)
    odds = (1 - share) / share
    steps = F.sequence(F.lit(0), F.least(k, F.lit(float(TAIL_TERMS))).cast("int"))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum"))

    def add(state: Column, i: Column) -> Column:
        return F.struct((state["term"] * (k - i) / (n - k + i + 1) * odds).alias("term"), (state["sum"] + state["term"]).alias("sum"))

    done = F.aggregate(steps, start, add)
    rest = F.greatest(k - TAIL_TERMS, F.lit(0.0)) * done["term"]
    return top + F.log(done["sum"] + rest)


def _measure(rule: str) -> Column:
    over, under, _ = RULES[rule]
    return F.coalesce(F.col(over) / F.nullif(F.col(under), F.lit(0)), F.lit(0.0))


def cutoffs(measured: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, cutoff, good, rejected_good, bad, rejected_bad): what is certified and used.

    ``labels`` (doc_id, quality): null ids and labels are left out; of several labels of one id the largest counts, and several
    rows with one id count each. Documents that fail the base rules take no part.
    """
    marks = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = measured.where(~base_failed()).join(marks, "doc_id")
    good = F.col("quality") == 1
    tests = [(rule, c) for rule, (_, _, grid) in RULES.items() for c in grid]
    sums = [F.count_if(good).alias("good"), F.count_if(~good).alias("bad")]
    for i, (rule, c) in enumerate(tests):
        sums += [F.count_if(good & (_measure(rule) > c)).alias(f"g{i}"), F.count_if(~good & (_measure(rule) > c)).alias(f"b{i}")]
    by = stored(known.groupBy("stratum").agg(*sums))
    n_tests = max(1, by.count()) * len(tests)
    each = F.explode(F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("cutoff"), F.col(f"g{i}").alias("rejected_good"),
                                        F.col(f"b{i}").alias("rejected_bad")) for i, (rule, c) in enumerate(tests)]))
    share = alpha / len(RULES)
    rows = by.select("stratum", "good", "bad", each.alias("t")).select("stratum", "good", "bad", "t.*")
    rows = rows.where(F.col("rejected_good") < F.col("good") * share)
    certified = rows.where(log_tail(F.col("rejected_good"), F.col("good"), share) <= math.log(delta / n_tests))
    gain = F.col("rejected_bad") / F.greatest("bad", F.lit(1)) - F.col("rejected_good") / F.col("good")
    best = certified.where(gain > 0).groupBy("stratum", "rule").agg(
        F.max_by(F.struct("cutoff", "good", "rejected_good", "bad", "rejected_bad"), F.struct(gain, "cutoff")).alias("best"))
    return best.select("stratum", "rule", "best.*")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The measures of each row of ``docs`` (doc_id, text, lang; other columns are ignored) with base_failed and kept.

    Null and empty texts have no words and fail. Rows that repeat are judged each; doc_id may be null. Empty tables are allowed: without
    labels nothing is certified, and kept is what passes the base rules.
    """
    measured = stored(measures(docs))
    used = stored(cutoffs(measured, labels))
    by = used.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_{r}") for r in RULES])
    met = measured.join(by, "stratum", "left")
    over = F.lit(False)
    for rule in RULES:
        over = over | F.coalesce(_measure(rule) > F.col(f"_{rule}"), F.lit(False))
    return met.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~over).drop(*[f"_{r}" for r in RULES])


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _oracle() -> str:
    share = ALPHA / len(RULES)
    grid = ", ".join(f"('{rule}', '{over}', '{under}', CAST({c} AS DOUBLE))" for rule, (over, under, cs) in RULES.items() for c in cs)
    measured = [f"WHEN '{rule}' THEN CASE WHEN {under} = 0 THEN 0 ELSE {over} / CAST({under} AS DOUBLE) END" for rule, (over, under, _) in RULES.items()]
    return rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
          WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
wins AS MATERIALIZED (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS win FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
more AS (SELECT r, win FROM wins GROUP BY r, win HAVING count(*) > 1),
again AS (SELECT r, count(DISTINCT k) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 5)) AS k FROM wins SEMI JOIN more USING (r, win)) GROUP BY r),
f AS MATERIALIZED (SELECT r, doc_id, stratum, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS n_capitals,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(w) < 10 OR 100 * coalesce(n_repeat_words, 0) > 20 * len(w) AS base_failed
  FROM d LEFT JOIN lines USING (r) LEFT JOIN again USING (r)),
grid(rule, num, den, cutoff) AS (VALUES {grid}),
marks AS (SELECT doc_id, max(quality) AS quality FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id),
m AS MATERIALIZED (SELECT f.*, rule, cutoff, (CASE rule {' '.join(measured)} END) > cutoff AS over FROM f, grid),
c AS (SELECT stratum, rule, cutoff, count(*) FILTER (quality = 1) AS good, count(*) FILTER (quality <> 1) AS bad,
        count(*) FILTER (quality = 1 AND over) AS g, count(*) FILTER (quality <> 1 AND over) AS b
      FROM m JOIN marks USING (doc_id) WHERE NOT base_failed GROUP BY stratum, rule, cutoff),
tests AS (SELECT count(*) AS n FROM c),
tail AS (SELECT c.*, (SELECT sum(exp(lgamma(good + 1) - lgamma(j + 1) - lgamma(good - j + 1) + j * ln({share}) + (good - j) * ln(1 - {share})))
        FROM (SELECT unnest(range(0, c.g + 1)) AS j)) AS p FROM c WHERE g < good * {share}),
best AS (SELECT stratum, rule, max_by(cutoff, (b / CAST(greatest(bad, 1) AS DOUBLE) - g / CAST(good AS DOUBLE)) * 1e6 + cutoff * 1e-6) AS used FROM tail, tests
         WHERE p <= {DELTA} / greatest(n, 1) AND b / CAST(greatest(bad, 1) AS DOUBLE) > g / CAST(good AS DOUBLE) GROUP BY stratum, rule),
gone AS (SELECT DISTINCT r FROM m JOIN best USING (stratum, rule) WHERE cutoff = used AND over)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND gone.r IS NULL AS kept
FROM f LEFT JOIN gone ON f.r = gone.r
"""


ORACLE = _oracle()
