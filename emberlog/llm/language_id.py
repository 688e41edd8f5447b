"""Language identification by interpolated Kneser-Ney character models.

Every text is reduced to its letters in lower case with one blank between words. Per language, all character n-grams of the
learnt rows are counted by Spark; continuation counts, discounts and back-off weights of all orders follow from them by
aggregation. Every n-gram is kept: the models are tables in the shared folder, with one probability per language, and grow
with the corpus. Nothing of them is broadcast or collected.

Texts are scored by joins. Some megabytes of texts make a chunk, which asks for each of its distinct n-grams once; what the
models say about them returns to the chunk, is laid out there as a sorted hash array and summed by text.

A text's language is the one with the lowest cross-entropy per character. How the differences turn into a probability,
and from which cross-entropy on a text is rejected as none of the languages, is calibrated on the learnt rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from emberlog.llm.superkmers import _each, pack, rest_of, unpack
from emberlog.llm.text import characters, id_hash, mix, steps, table
from emberlog.session import stored

ORDER = 4

#: N-grams below this share of their language are left out of its model; 0 keeps all.
MIN_SHARE = 0.0

#: Bytes of text that ask for their n-grams together.
CHUNK_BYTES = 64 << 20

#: Share of a language's own texts that are rejected as none.
REJECTED = 0.002

#: Candidates for the factor that turns cross-entropies into probabilities.
SHARPNESS = tuple(2.0**i for i in range(-1, 9))

_BITS = np.uint64(16)
_LETTER_BITS = (1 << 16) - 1


@lru_cache
def _folding() -> np.ndarray:
    """For each code point: a number of 16 bits for its lower case if it is a letter, else the blank's."""
    fold = np.full(0x110000, 32, np.uint16)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = ord(s.lower()[0])
            fold[c] = low if low < 0xE000 else 0xE000 + low % 0x1F00
    return fold


def letters(data: np.ndarray, offsets: np.ndarray, pad: int = ORDER - 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(characters, offsets by row, letters by row) of UTF-8 texts; each row is preceded by ``pad`` blanks.

    Runs of anything but letters are one blank; a row without letters has no characters beyond the padding.
    """
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    whole = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    folded = _folding()[points]
    bounds = whole[offsets]
    letter = folded != 32
    before = np.r_[False, letter[:-1]]
    before[bounds[:-1][bounds[:-1] < len(folded)]] = False
    keep = letter | before
    kept = np.r_[0, np.cumsum(keep)][bounds]
    n = np.r_[0, np.cumsum(letter)]
    out_bounds = kept + pad * np.arange(len(kept))
    out = np.full(int(out_bounds[-1]), 32, np.uint16)
    row = np.repeat(np.arange(len(kept) - 1), np.diff(kept))
    out[np.arange(len(row)) + pad * (row + 1)] = folded[keep]
    return out, out_bounds, n[bounds[1:]] - n[bounds[:-1]]


def grams(text: np.ndarray, bounds: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram of every character with those before it, offsets by row); 16 bits each, the last character lowest."""
    wide = text.astype(np.uint64)
    n = len(wide) - order + 1
    key = np.zeros(max(0, n), np.uint64)
    for i in range(order if n > 0 else 0):
        key = (key << _BITS) | wide[i:i + n]
    size = np.diff(bounds) - (order - 1)
    inside = np.repeat(bounds[:-1], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return key[inside], np.r_[0, np.cumsum(size)]


def _tally(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    head = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[head], np.add.reduceat(n, head)


def counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n): how often each n-gram occurs in all texts of each language; combined within tasks first."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for step in steps(batches, 0):
            text, bounds, _ = letters(*characters(step.column(0)))
            keys, edges = grams(text, bounds)
            coded = step.column(1).dictionary_encode()
            code = coded.indices.to_numpy()
            for i, lang in enumerate(coded.dictionary.to_pylist()):
                own = np.sort(keys[np.repeat(code == i, np.diff(edges))])
                if own.size:
                    head = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                    parts = held.setdefault(lang, [])
                    parts.append((own[head], np.diff(np.r_[head, len(own)])))
                    if len(parts) > 16:
                        held[lang] = [_tally(parts)]
        for lang, parts in held.items():
            keys, n = _tally(parts)
            for low in range(0, len(keys), 1 << 16):
                k = keys[low:low + (1 << 16)]
                yield pa.record_batch([pa.array([lang] * len(k)), pa.array(k.view(np.int64)), pa.array(n[low:low + (1 << 16)])], ["lang", "gram", "n"])

    return docs.select("text", "lang").mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class HashArray:
    """Rows of values by hashed key: hashes sorted, with a table of where each leading bit pattern begins."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        hashes = mix(keys)
        order = np.argsort(hashes)
        self.hashes, self.values = hashes[order], values[order]
        self.shift = np.uint64(64 - max(1, int(len(keys)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.begin = np.searchsorted(self.hashes, np.arange(size, dtype=np.uint64) << self.shift)
        self.longest = int(np.diff(np.r_[self.begin, len(keys)]).max(initial=0))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 if there is none."""
        wanted = mix(keys)
        at = self.begin[(wanted >> self.shift).astype(np.int64)]
        out = np.full(len(keys), -1, np.int64)
        if not len(self.hashes):
            return out
        todo = np.arange(len(keys))
        for _ in range(self.longest):
            here = self.hashes[np.minimum(at, len(self.hashes) - 1)]
            hit = (here == wanted) & (at < len(self.hashes))
            out[todo[hit]] = at[hit]
            more = (here < wanted) & (at + 1 < len(self.hashes))
            todo, at, wanted = todo[more], at[more] + 1, wanted[more]
            if not todo.size:
                break
        return out


@dataclass
class Model:
    """Probabilities and back-off weights by order from 1, as stored tables with one number per language."""

    languages: list[str]
    probability: list[DataFrame]  # (gram, p): interpolated, for the n-grams of any language
    backoff: list[DataFrame]  # (ctx, w)
    floor: float

    def answers(self, asked: DataFrame, order: int = ORDER) -> DataFrame:
        """(gram, p) for distinct n-grams of that order: the interpolated value if there is one, else weight times the shorter one's."""
        if order == 0:
            return asked.select("gram", F.array(*[F.lit(self.floor)] * len(self.languages)).alias("p"))
        met = stored(asked.join(self.probability[order - 1], "gram", "left"))
        missing = met.where("p IS NULL").select("gram", _context("gram").alias("ctx"), _shorter("gram", order - 1).alias("rest"))
        lower = self.answers(missing.select(F.col("rest").alias("gram")).distinct(), order - 1)
        lower = lower.select(F.col("gram").alias("rest"), F.col("p").alias("lower"))
        weighted = F.when(F.col("w").isNull(), F.col("lower")).otherwise(F.zip_with("w", "lower", lambda w, p: w * p))
        rest = missing.join(self.backoff[order - 1], "ctx", "left").join(lower, "rest").select("gram", weighted.alias("p"))
        return met.where("p IS NOT NULL").unionByName(rest)

    def cross_entropy(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bits per character by row and language, letters by row) of a few UTF-8 texts."""
        raw = data.tobytes()
        texts = [(i, raw[a:b].decode("utf-8", "replace")) for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:]))]
        docs = self.probability[0].sparkSession.createDataFrame(texts, "row bigint, text string")
        got = measured(docs, self).orderBy("row").collect()
        return np.array([r.bits for r in got]), np.array([r.n_letters for r in got])


def _context(gram: str) -> Column:
    return F.shiftrightunsigned(gram, 16)


def _shorter(gram: str, order: int) -> Column:
    return F.col(gram).bitwiseAND(F.lit((1 << 16 * order) - 1))


def trained(docs: DataFrame) -> Model:
    """Models of all languages (non-null ``lang``) of ``docs``; null and empty texts teach nothing."""
    table_of = {ORDER: stored(counts(docs.where("lang IS NOT NULL")))}
    for k in range(ORDER - 1, 0, -1):  # of shorter n-grams, how many longer ones end in them
        table_of[k] = stored(table_of[k + 1].groupBy("lang", _shorter("gram", k).alias("gram")).agg(F.count("*").alias("n")))
    sums = {}
    for k, frame in table_of.items():
        of = frame.groupBy("lang").agg(F.sum("n").alias("all"), F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2"))
        sums[k] = {r.lang: (r["all"] * MIN_SHARE, min(max(r.n1 / (r.n1 + 2 * r.n2) if r.n1 else 0.5, 0.1), 0.9)) for r in of.collect()}
    languages = sorted(sums[ORDER])
    if not languages:
        return Model([], [], [], 0.0)

    def by_language(value: Column) -> Column:
        return F.array(*[F.coalesce(F.sum(F.when(F.col("lang") == x, value)), F.lit(0)) for x in languages])

    enough = F.lit(False)
    for x in languages:
        enough |= (F.col("lang") == x) & (F.col("n") >= sums[1][x][0])
    model = Model(languages, [], [], 1 / max(2, table_of[1].where(enough).select("gram").distinct().count() + 1))
    for k in range(1, ORDER + 1):
        least, d = ([sums[k][x][i] for x in languages] for i in (0, 1))
        frame = table_of[k].withColumn("ctx", _context("gram"))
        ctx = stored(frame.groupBy("ctx").agg(by_language(F.col("n")).alias("s"), by_language(F.lit(1)).alias("kinds")))
        weights = [F.when((F.col("s")[i] > 0) & (F.col("s")[i] >= least[i]), d[i] * F.col("kinds")[i] / F.col("s")[i]).otherwise(1.0)
                   for i in range(len(languages))]
        ctx = ctx.select("ctx", "s", F.array(*weights).alias("w"))
        grams_of = table_of[k].groupBy("gram").agg(by_language(F.col("n")).alias("n"))
        grams_of = grams_of.withColumn("ctx", _context("gram")).join(F.broadcast(ctx) if k == 1 else ctx, "ctx")
        if k == 1:
            grams_of = grams_of.withColumn("lower", F.array(*[F.lit(model.floor)] * len(languages)))
        else:
            lower = model.probability[-1].select(F.col("gram").alias("rest"), F.col("p").alias("lower"))
            grams_of = grams_of.withColumn("rest", _shorter("gram", k - 1)).join(lower, "rest")
        p = [F.when((F.col("n")[i] > 0) & (F.col("n")[i] >= least[i]), (F.col("n")[i] - d[i]) / F.col("s")[i]).otherwise(0.0)
             + F.col("w")[i] * F.col("lower")[i] for i in range(len(languages))]
        model.probability.append(stored(grams_of.select("gram", F.array(*p).alias("p"))))
        model.backoff.append(stored(ctx.select("ctx", "w")))
    return model


def _asking(docs: DataFrame) -> DataFrame:
    """(chunk, asks, body, rest): texts (the first column) as letters with the other columns beside them, in pieces, and one
    row per chunk with its distinct n-grams. Stored."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size, parts = TaskContext.get().partitionId() << 32, 0, []

        def out(asks: bytes | None, body: bytes | None, rest: bytes | None) -> pa.RecordBatch:
            columns = [pa.array([chunk], pa.int64()), *[pa.array([x], pa.binary()) for x in (asks, body, rest)]]
            return pa.RecordBatch.from_arrays(columns, names=["chunk", "asks", "body", "rest"])

        for step in steps(batches, 0):
            data, offsets = characters(step.column(0))
            if parts and size + len(data) > CHUNK_BYTES:
                yield out(pack(np.unique(np.concatenate(parts))), None, None)
                chunk, size, parts = chunk + 1, 0, []
            size += len(data)
            text, bounds, n = letters(data, offsets)
            parts.append(np.unique(grams(text, bounds)[0]))
            if len(parts) > 16:
                parts = [np.unique(np.concatenate(parts))]
            rest = pa.RecordBatch.from_arrays(step.columns[1:], names=[f"c{j}" for j in range(1, step.num_columns)])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rest.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_batch(rest)
            yield out(None, pack(text, bounds, n), sink.getvalue().to_pybytes())
        if parts:
            yield out(pack(np.unique(np.concatenate(parts))), None, None)

    return stored(docs.mapInArrow(run, "chunk bigint, asks binary, body binary, rest binary"))


def measured(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` but text, and bits (cross-entropy by language, array<double>) and n_letters, which replace columns so named."""
    docs = docs.select("text", *[c for c in docs.columns if c not in ("text", "bits", "n_letters")])
    width, names = len(model.languages), [*docs.columns[1:], "bits", "n_letters"]
    stock = _asking(docs)

    def listed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, asks in _each(batches):
            keys = unpack(asks, np.uint64)[0].view(np.int64)
            for low in range(0, len(keys), 1 << 16):
                part = keys[low:low + (1 << 16)]
                yield pa.record_batch([pa.array(np.full(len(part), chunk)), pa.array(part)], ["chunk", "gram"])

    def told(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            chunk, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            values = np.log2(batch.column(2).flatten().to_numpy().reshape(-1, width)).astype(np.float32)
            heads = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1]])
            blobs = [pack(keys[a:b], values[a:b].ravel()) for a, b in zip(heads, [*heads[1:], len(chunk)])]
            yield pa.record_batch([pa.array(chunk[heads]), pa.array([0] * len(heads), pa.int32()), pa.array(blobs, pa.binary()),
                                   pa.nulls(len(heads), pa.binary())], ["chunk", "kind", "body", "rest"])

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, parts, known = None, [], None
        for key, kind, blob, rest in _each(batches):
            if key != chunk:
                chunk, parts, known = key, [], None
            if not kind:
                parts.append(unpack(blob, np.uint64, np.float32))
                continue
            if known is None:
                keys = np.concatenate([np.zeros(0, np.uint64), *[p[0] for p in parts]])
                known = HashArray(keys, np.concatenate([np.zeros(0, np.float32), *[p[1] for p in parts]]).reshape(-1, width))
                parts = []
            text, bounds, n = unpack(blob, np.uint16, np.int64, np.int64)
            bits = _summed(text, bounds, known, width)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(bits) + 1) * width, pa.int32()), pa.array(bits.ravel(), pa.float64()))
            yield pa.RecordBatch.from_arrays([*rest_of(rest).columns, lists, pa.array(n)], names=names)

    asked = stock.where("asks IS NOT NULL").select("chunk", "asks").mapInArrow(listed, "chunk bigint, gram bigint")
    answers = model.answers(asked.select("gram").distinct())
    answered = asked.join(answers, "gram").select("chunk", "gram", "p").sortWithinPartitions("chunk", "gram")
    answered = answered.mapInArrow(told, "chunk bigint, kind int, body binary, rest binary")
    pieces = stock.where("body IS NOT NULL").select("chunk", F.lit(1).alias("kind"), "body", "rest")
    met = answered.unionByName(pieces).repartition("chunk").sortWithinPartitions("chunk", "kind")
    return met.mapInArrow(score, T.StructType([*docs.schema.fields[1:], T.StructField("bits", T.ArrayType(T.DoubleType())), T.StructField("n_letters", T.LongType())]))


def _summed(text: np.ndarray, bounds: np.ndarray, known: HashArray, width: int, block: int = 1 << 18) -> np.ndarray:
    """Bits per character by row and language, if ``known`` has all n-grams of the text."""
    keys, edges = grams(text, bounds)
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(edges))
    total = np.zeros((len(bounds) - 1, width))
    for low in range(0, len(keys), block):
        at, row = known.find(keys[low:low + block]), rows[low:low + block]
        if (at < 0).any():
            raise ValueError("an n-gram has no answer")
        head = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        total[row[head]] -= np.add.reduceat(known.values[at], head, axis=0, dtype=np.float64)
    return total / np.maximum(np.diff(edges), 1)[:, None]


def identified(docs: DataFrame, learn) -> DataFrame:
    """(doc_id, lang_pred, score, rejected, bits_per_char) for each row of ``docs`` (doc_id, text, lang; others are ignored).

    ``learn`` is a condition: only rows that meet it, with a non-null language, teach the models and the calibration. Null
    texts and those without a letter are ``und`` with score 0, as is everything if no language can be learnt. ``score`` is the
    calibrated probability of ``lang_pred``; ``rejected`` says that even its model finds the text unlikely. Ties go to the
    language first in order. Rows that repeat are judged each. An empty table gives an empty result.
    """
    docs = docs.select("doc_id", "text", "lang")
    taught = docs.where(learn)
    model = trained(taught)
    names = model.languages
    if not names:
        und = F.lit("und").alias("lang_pred")
        return docs.select("doc_id", und, F.lit(0.0).alias("score"), F.lit(False).alias("rejected"), F.lit(None).cast("double").alias("bits_per_char"))
    bits = stored(measured(docs.withColumn("known", F.coalesce(learn, F.lit(False))), model))
    bits = bits.withColumn("least", F.array_min("bits"))
    own = F.get("bits", F.array_position(F.lit(names), F.col("lang")).cast("int") - 1)
    known = bits.where(F.col("known") & (F.col("n_letters") > 0) & F.array_contains(F.lit(names), F.col("lang")))

    def spread(t: float):
        return F.aggregate(F.transform("bits", lambda b: F.exp((F.col("least") - b) * t)), F.lit(0.0), lambda a, b: a + b)

    losses = known.agg(*[F.avg(F.log(spread(t)) - (F.col("least") - own) * t).alias(f"t{i}") for i, t in enumerate(SHARPNESS)]).first()
    t = min(zip([x if x is not None else 0.0 for x in losses], SHARPNESS))[1]
    limits = known.where(own == F.col("least")).groupBy("lang").agg(F.percentile_approx("least", 1 - REJECTED, 100_000).alias("limit")).collect()
    limit = F.create_map(*[F.lit(x) for r in limits for x in (r.lang, float(r.limit))]) if limits else F.lit(None).cast("map<string,double>")
    best = F.element_at(F.lit(names), F.array_position("bits", F.col("least")).cast("int"))
    some = F.col("n_letters") > 0
    return bits.withColumn("best", best).select(
        "doc_id", F.when(some, F.col("best")).otherwise("und").alias("lang_pred"), F.when(some, 1 / spread(t)).otherwise(0.0).alias("score"),
        F.coalesce(some & (F.col("least") > limit[F.col("best")]), F.lit(False)).alias("rejected"), F.when(some, F.col("least")).alias("bits_per_char"))


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(id_hash(F.col("doc_id")) % 3 == 1, F.lit(False))
    found = identified(docs, id_hash(F.col("doc_id")) % 3 != 1)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected", "bits_per_char")
