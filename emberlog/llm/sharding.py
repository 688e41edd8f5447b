"""Shards of nearly equal bytes by longest-processing-time scheduling.

Documents with equal texts form a group that stays together. Groups go, the largest first, to the shard that has
the least so far. The heap does not see every group: groups of the same size class are alike, and there are fewer classes than
``CLASS_BITS`` allows for, whatever the number of groups. A class of many groups is dealt by the level to which all loads
can be raised, which is what the heap would do. Classes below ``EXACT`` hold one size each; they come last and start from
the true loads, so they even out what the coarser classes left.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, functions as F

from emberlog.llm.ranks import numbered
from emberlog.llm.text import table
from emberlog.session import stored

SHARDS = 16

#: Sizes keep so many leading bits: at most 2 ** (bits - 1) classes per doubling of the size.
CLASS_BITS = 10
EXACT = 1 << CLASS_BITS


def schedule(classes: list[tuple[int, int, int]], loads: list[float]) -> list[tuple[int, int, int, int]]:
    """(class, first, past, shard): how the groups of each (class, groups, bytes) go to shards with these loads."""
    heap = [(load, shard) for shard, load in enumerate(loads)]
    heapq.heapify(heap)
    out = []
    for size, n, total in sorted(classes, key=lambda c: (-c[2] / c[1], c[0])):
        each, given = total / n, [0] * len(loads)
        if n > 4 * len(loads):
            low, high = heap[0][0], heap[0][0] + n * each
            for _ in range(100):
                level = (low + high) / 2
                if sum(max(0, int((level - load) / each)) for load, _ in heap) <= n:
                    low = level
                else:
                    high = level
            for load, shard in heap:
                given[shard] = max(0, int((low - load) / each))
            heap = [(load + given[shard] * each, shard) for load, shard in heap]
            heapq.heapify(heap)
        for _ in range(n - sum(given)):
            load, shard = heap[0]
            given[shard] += 1
            heapq.heapreplace(heap, (load + each, shard))
        first = 0
        for shard, k in enumerate(given):
            if k:
                out.append((size, first, first + k, shard))
                first += k
    return out


def _assigned(groups: DataFrame, loads: list[float]) -> DataFrame:
    """``groups`` (key, bytes, class) with their shard."""
    classes = [tuple(r) for r in groups.groupBy("class").agg(F.count("*"), F.sum("bytes")).collect()]  # bounded by CLASS_BITS
    if not classes:
        return groups.withColumn("shard", F.lit(0))
    ranges = groups.sparkSession.createDataFrame(schedule(classes, loads), "class long, first long, past long, shard int")
    number = numbered(groups, "class", "number", [F.col("key")], [F.col("key")], sum(c[1] for c in classes))
    return number.join(F.broadcast(ranges), "class").where("number >= first AND number < past").select("key", "bytes", "class", "shard")


def shards(docs: DataFrame, n: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for each row of ``docs``; columns other than doc_id and text are ignored.

    The size is the bytes of the text's UTF-8 plus one. A null text has no bytes, like an empty one, and is in its group.
    Rows that repeat are a group of equal texts and all get a slot; doc_id may be null. An empty table gives an empty result.
    """
    text = F.coalesce("text", F.lit(""))
    facts = stored(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("key")))
    sums = facts.groupBy("key").agg(F.sum("size").alias("bytes"))
    low = f"greatest(length(bin(bytes)) - {CLASS_BITS}, 0)"
    groups = stored(sums.withColumn("class", F.expr(f"shiftleft(shiftright(bytes, {low}), {low})")))
    large = stored(_assigned(groups.where(F.col("class") >= EXACT), [0.0] * n))
    loads = [0.0] * n
    for row in large.groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect():
        loads[row.shard] = float(row.bytes)
    where = large.unionByName(_assigned(groups.where(F.col("class") < EXACT), loads)).select("key", "shard")
    placed = stored(facts.join(where, "key").select("doc_id", "size", "text_crc32", "shard"))
    total = placed.count()
    return numbered(placed, "shard", "slot", [F.col("doc_id"), F.col("text_crc32")], [F.col("doc_id"), F.col("text_crc32")], total)


def op8_sharding(spark, sf_dir: str) -> DataFrame:
    return shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
