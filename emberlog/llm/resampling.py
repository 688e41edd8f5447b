"""Importance resampling of documents towards a target distribution of hashed word n-grams.

The gain of a bucket of n-grams says how much more frequent it is in the target than in the documents. A document's weight is the
mean gain of its n-grams, looked up in one array; weight plus a Gumbel draw that is a hash of the id is its score, and
the highest scores are drawn: sampling without replacement, in proportion to exp(weight), the same on every run.

No sort of all documents takes part. Scores are stored; the cutoff is found by bisection, each job counting the rows
that reach seven probes exactly, first over scores, then over the ids of rows that tie. Only the rows drawn are range-partitioned for ranks.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from emberlog.llm.folded import word_pieces
from emberlog.llm.text import concatenated, steps, table
from emberlog.session import stored

BUCKETS = 10_000
WORDS = 2
PERCENT = 25
LEAST_WORDS = 20
SEED = 7

#: Words up to so many bytes are hashed together by tables.
SHORT = 64

#: Each job of a bisection counts at so many places: as much as three halvings.
PROBES = 7

#: Stands for a null id in comparisons, which so comes last.
LAST = (1 << 63) - 1

_WORDS_AT_ONCE = 1 << 17


def _shifted(crc: np.ndarray) -> np.ndarray:
    """The checksum's register after one more zero byte."""
    return _SHIFT[0][crc & 255] ^ (crc >> 8)


#: _ZEROS[n] is the checksum of n zero bytes; _SHIFT[n][b] is what byte b adds to the register, n bytes before the end. The checksum
#: of a string is the exclusive or of all its bytes' shares and that of as many zero bytes.
_ZEROS = np.array([zlib.crc32(bytes(n)) for n in range(SHORT + 2)], np.uint32)
_SHIFT = [np.array([zlib.crc32(bytes([b])) for b in range(256)], np.uint32) ^ _ZEROS[1]]
for _ in range(SHORT + 1):
    _SHIFT.append(_shifted(_SHIFT[-1]))
_SHIFT = np.stack(_SHIFT)


def word_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of the bytes of each word."""
    length = ends - starts
    out = np.zeros(len(starts), np.uint32)
    short = np.flatnonzero(length <= SHORT)
    for low in range(0, len(short), _WORDS_AT_ONCE):
        at = short[low:low + _WORDS_AT_ONCE]
        n = length[at]
        first = np.cumsum(n) - n
        left = np.repeat(first + n - 1, n) - np.arange(n.sum())
        share = _SHIFT.ravel()[left * 256 + data[concatenated(starts[at], n)]]
        out[at] = np.bitwise_xor.reduceat(share, first) ^ _ZEROS[n]
    for i in np.flatnonzero(length > SHORT).tolist():
        out[i] = zlib.crc32(data[starts[i]:ends[i]])
    return out


def pair_crcs(crc: np.ndarray, word: np.ndarray, length: np.ndarray, long_word: Callable[[int], bytes]) -> np.ndarray:
    """crc32 of strings with checksums ``crc``, each followed by a blank and a word with checksum ``word`` and this length.

    ``long_word`` gives the bytes of the i-th word, for words longer than the tables.
    """
    n = np.minimum(length, SHORT) + 1
    out = word ^ _ZEROS[n - 1] ^ _ZEROS[n] ^ _SHIFT[n - 1, 32]  # of blank and word
    for k in range(4):
        share = _SHIFT[np.maximum(n - 1 - k, 0), (crc >> np.uint32(8 * k)) & 255]
        out ^= np.where(n > k, share, 0).astype(np.uint32)
    out ^= np.where(n < 4, crc >> (8 * np.minimum(n, 3)).astype(np.uint32), 0).astype(np.uint32)
    for i in np.flatnonzero(length > SHORT).tolist():
        out[i] = zlib.crc32(b" " + long_word(i), int(crc[i]))
    return out


def features(texts: pa.Array, words: int = WORDS, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, number of words of each, bucket by n-gram with its row) of a text column, in pieces that add up.

    The n-grams are all runs of 1 to ``words`` consecutive words of a text, joined by one blank; each one's bucket is its crc32 modulo ``buckets``.
    """
    kept_crc, kept_words = np.zeros(0, np.uint32), []  # the last words of the piece before, of which there is one row
    for rows, data, starts, ends, bounds, goes_on in word_pieces(texts):
        own = len(starts)
        crc, length = word_crcs(data, starts, ends), ends - starts
        row = np.repeat(rows, np.diff(bounds))
        held = len(kept_crc) if goes_on else 0
        if held:
            crc, row = np.r_[kept_crc, crc], np.r_[np.zeros(held, np.int64), row]
            length = np.r_[np.array([len(w) for w in kept_words], np.int64), length]

        def word(i: int, held=held, before=kept_words, data=data, starts=starts, ends=ends) -> bytes:
            return before[i] if i < held else data[starts[i - held]:ends[i - held]].tobytes()

        out, of, run = [crc[held:]], [row[held:]], crc
        for n in range(1, words):
            follows = np.flatnonzero((row[n:] == row[:-n]) & (np.arange(n, len(row)) >= held)) if len(row) > n else np.zeros(0, np.int64)
            at = np.arange(n, len(row))
            run = pair_crcs(run[:len(at)], crc[n:], length[n:], lambda i, n=n: word(i + n)) if len(at) else run[:0]
            out.append(run[follows])
            of.append(row[n:][follows])
        last = max(0, len(crc) - (words - 1))
        kept_crc, kept_words = crc[last:], [word(i) for i in range(last, len(crc))]
        counts = np.zeros(len(texts), np.int64)
        counts[rows] += np.diff(bounds) if own else 0
        yield counts, (np.concatenate(out) % np.uint32(buckets)).astype(np.int64), np.concatenate(of)


def bucket_counts(texts: DataFrame, words: int = WORDS, buckets: int = BUCKETS) -> np.ndarray:
    """How many n-grams of all ``texts`` (text) are in each bucket. Each task sends one number a bucket."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for step in steps(batches):
            for _, bucket, _ in features(step.column(0), words, buckets):
                total += np.bincount(bucket, minlength=buckets)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(total[full])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in texts.select("text").mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n")).collect():  # one row a bucket
        out[row[0]] = row[1]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the logarithm of the ratio of smoothed shares, rounded down, by bucket."""
    s, t, n = float(source.sum()), float(target.sum()), float(len(source))
    ratio = [(b + 1.0) * (s + n) / ((a + 1.0) * (t + n)) for a, b in zip(source.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def draw(doc_id: int | None, seed: int = SEED) -> int:
    """1000 times a Gumbel variate from the hash of an id, rounded down; a null id counts as an empty string."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of each row; the weight is the floored mean gain of its n-grams, 0 without any."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, 1):
            n, n_words, total = (np.zeros(step.num_rows, np.int64) for _ in range(3))
            for counts, bucket, row in features(step.column(1), words, len(shared.value)):
                n_words += counts
                n += np.bincount(row, minlength=len(n))
                np.add.at(total, row, shared.value[bucket])
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            score = weight + np.array([draw(i, seed) for i in step.column(0).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([step.column(0), *map(pa.array, (n_words, n, weight, score))], names=["doc_id", "n_words", "n_features", "weight", "score"])

    known = docs.select(F.col("doc_id").cast("long"), "text")
    return known.mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")


def least_reaching(rows: DataFrame, place: Column, wanted: int, low: int, high: int) -> int:
    """The smallest number in low..high that ``place`` does not exceed in at least ``wanted`` rows; high if there are fewer.

    Bisection: each job counts the rows up to seven probes exactly and keeps one eighth of the range.
    """
    while low < high:
        probes = sorted({low + (high - low) * (i + 1) // (PROBES + 1) for i in range(PROBES)})
        counts = rows.agg(*[F.count(F.when(place <= F.lit(p), True)) for p in probes]).first()
        reached = [p for p, n in zip(probes, counts) if n >= wanted]
        missed = [p for p, n in zip(probes, counts) if n < wanted]
        low, high = max([low, *(p + 1 for p in missed)]), min([high, *reached])
    return low


def drawn(rows: DataFrame, wanted: int) -> Column:
    """Whether a row is among the ``wanted`` highest scores of ``rows`` (score, key, row); ties go to the smaller key, then row."""
    score, key, row = F.col("score"), F.col("key"), F.col("row")
    if wanted <= 0:
        return F.lit(False)
    edge = rows.agg(F.min("score"), F.max("score")).first()
    cut = -least_reaching(rows, -score, wanted, -edge[1], -edge[0])
    tied = rows.where(score == cut)
    rest = wanted - rows.where(score > cut).count()
    edge = tied.agg(F.min("key"), F.max("key"), F.count("*")).first()
    if rest == edge[2]:
        return score >= cut
    last = least_reaching(tied, key, rest, edge[0], edge[1])
    same = tied.where(key == last)
    rest -= tied.where(key < last).count()
    edge = same.agg(F.min("row"), F.max("row"), F.count("*")).first()
    until = edge[1] if rest == edge[2] else least_reaching(same, row, rest, edge[0], edge[1])
    return (score > cut) | ((score == cut) & ((key < last) | ((key == last) & (row <= until))))


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with their rank from 1 by falling score, then key and row: range-partitioned, numbered in place, and
    raised by the sizes of the ranges before."""
    order = [F.desc("score"), F.asc("key"), F.asc("row")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = stored(dealt.withColumn("_at", F.monotonically_increasing_id()))  # range number, then place within the range
    numbered = numbered.withColumn("_part", F.shiftright("_at", 33)).withColumn("_place", F.col("_at").bitwiseAND((1 << 33) - 1))
    starts, before = [], 0
    for part, n in sorted(tuple(r) for r in numbered.groupBy("_part").count().collect()):  # one row a range
        starts.append((part, before))
        before += n
    sizes = rows.sparkSession.createDataFrame(starts, "_part long, _before long")
    return numbered.join(F.broadcast(sizes), "_part").withColumn("rank", F.col("_before") + F.col("_place") + 1).drop("_part", "_place", "_at", "_before")


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least: int = LEAST_WORDS, words: int = WORDS, buckets: int = BUCKETS,
              seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) for each row of ``docs``; rank is null for rows not drawn.

    ``target`` (text) says what distribution is aimed at. Of the N rows with at least ``least`` words, ``percent`` N / 100 are
    drawn, rounded down. Null and empty texts have no words: weight 0, never drawn while ``least`` is over 0. A null doc_id is hashed
    like an empty one and comes last among ties; rows that repeat an id are rows of their own, and where score and id
    are equal the order in which the scores were stored decides. An empty target has the same smoothed share in all buckets; empty ``docs``
    give an empty result. Columns other than doc_id and text are ignored.
    """
    gain = gains(bucket_counts(docs, words, buckets), bucket_counts(target, words, buckets))
    key = F.coalesce("doc_id", F.lit(LAST))
    scores = stored(scored(docs, gain, words, seed).withColumns({"key": key, "row": F.monotonically_increasing_id()}))
    fit = scores.where(F.col("n_words") >= least)
    chosen = drawn(fit, percent * fit.count() // 100) & (F.col("n_words") >= least)
    out = ("doc_id", "n_words", "n_features", "weight", "score", "rank")
    return ranked(scores.where(chosen)).select(*out).unionByName(scores.where(~chosen).withColumn("rank", F.lit(None).cast("long")).select(*out))


def op12_importance_resampling(spark, sf_dir: str) -> DataFrame:
    found = resampled(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


ORACLE = r"""
WITH table256 AS MATERIALIZED (
    SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
    FROM (SELECT unnest(range(256)) AS b)),
words AS MATERIALIZED (
    SELECT src, r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM (SELECT 'd' AS src, row_number() OVER () AS r, doc_id, text FROM documents
          UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark)),
grams AS MATERIALIZED (
    SELECT src, r, unnest(w) AS g FROM words
    UNION ALL SELECT src, r, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words),
crcs AS MATERIALIZED (
    SELECT g, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(hex(encode(g))) // 2 + 1),
                                  lambda i: CAST('0x' || substr(hex(encode(g)), 2 * i - 1, 2) AS BIGINT))),
                              lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) % 10000 AS b
    FROM (SELECT DISTINCT g FROM grams), table256),
by_bucket AS (SELECT b, count(*) FILTER (src = 'd') AS s, count(*) FILTER (src = 'b') AS t FROM grams JOIN crcs USING (g) GROUP BY b),
totals AS (SELECT sum(s)::DOUBLE AS s_all, sum(t)::DOUBLE AS t_all FROM by_bucket),
gain AS (SELECT b, floor(1000 * ln((t + 1.0::DOUBLE) * (s_all + 10000) / ((s + 1.0::DOUBLE) * (t_all + 10000))))::BIGINT AS gain FROM by_bucket, totals),
sums AS (SELECT r, count(*) AS n, sum(gain)::BIGINT AS total FROM grams JOIN crcs USING (g) JOIN gain USING (b) WHERE src = 'd' GROUP BY r),
scores AS (
    SELECT r, doc_id, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_features, coalesce(floor(total::DOUBLE / n), 0)::BIGINT AS weight,
           CAST('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8) AS BIGINT) AS h
    FROM words LEFT JOIN sums USING (r) WHERE src = 'd'),
total AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM scores),
ranks AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS k, count(*) OVER () AS n FROM total WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN k <= 25 * n // 100 THEN k END AS rank FROM total LEFT JOIN ranks USING (r)
"""
