"""Mixing sources to target weights by Pfair scheduling.

The documents of each source are cut into blocks of ``BLOCK`` documents (in the
order of a hash of the id). One block is placed per slot. A source of share w of the
weights (an exact fraction) gets for its block k the window from release floor(k / w)
to deadline ceil((k + 1) / w); among released blocks the one of earliest deadline
goes first. The shares sum to one, so every deadline is met, and at every slot each
source is less than one block off its share.

A phase ends with the slot in which a source places its last block; the others go on
with their weights, deviations starting afresh. Every document is placed exactly once.

Slots follow one another, so the driver deals them out: it holds one row a source
and one number a block, a 64th of the documents, and hands both to the executors by
broadcast (16 bytes a block). Documents never come to it.

Target weights are a parameter. Sources without one, and all by default, weigh
their number of documents to the power ``TEMPER``, the usual tempered mix. Any number
of sources can be mixed. Only where a ``resolution`` is asked for are weights rounded
to that many parts, at least one each.

Defined cases: a null source is a source of its own; null ids come first within
their hash, rows of one id in the order of the hash of the row; repeated rows are
placed separately; text and further columns are carried unread; an empty table gives no
rows; a target weight of zero or less is an error.
"""

from __future__ import annotations

import heapq
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from fractions import Fraction
from itertools import count, islice
from math import lcm

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import free, table

BLOCK = 64
RESOLUTION = 1_000
TEMPER = 0.7
#: Blocks of one row of the schedule.
RUN = 1_000
#: Documents of one hash bucket of a source, about; ranks are counted inside and summed across.
BUCKET = 2_000
#: Files whose names are broadcast, at most (some 10 MB); those of more are joined.
FILES = 100_000
#: Documents of one partition of the mix at most.
PART = 30_000


def quantise(weights: dict, resolution: int = RESOLUTION) -> dict:
    """Integers of sum ``resolution``, at least one each, by largest remainder."""
    if any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be above zero")
    if len(weights) > resolution:
        raise ValueError(f"at most {resolution} sources can be mixed; raise the resolution")
    total = sum(map(Fraction, weights.values()))
    spare = resolution - len(weights)
    exact = {s: Fraction(w) / total * spare for s, w in weights.items()}
    whole = {s: 1 + int(x) for s, x in exact.items()}
    rest = sorted(exact, key=lambda s: (int(exact[s]) - exact[s], str(s)))
    for s in rest[: resolution - sum(whole.values())]:
        whole[s] += 1
    return whole


def exact(weights: dict) -> dict:
    """Integers in the very proportions of ``weights``."""
    if any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be above zero")
    parts = {s: Fraction(w) for s, w in weights.items()}
    scale = lcm(*(w.denominator for w in parts.values()))
    return {s: int(w * scale) for s, w in parts.items()}


def _ordered(sources) -> list:
    return sorted(sources, key=lambda s: (s is None, str(s)))


def _classes(q: list[int]) -> list[tuple[int, list[int]]]:
    """(weight, numbers of the sources that have it), largest weight first."""
    found: dict = {}
    for i, w in enumerate(q):
        found.setdefault(w, []).append(i)
    return sorted(found.items(), reverse=True)


def _turns(classes: list[tuple[int, list[int]]], total: int) -> Iterator[int]:
    """The source of each slot of a phase without end, by earliest deadline among released blocks.

    First blocks are all released at the start, their deadlines in the order of the classes: a class enters when its
    deadline is due, and is stood for by one source at a time. So a short phase costs little, however many sources there are.
    """
    released: list[tuple] = []
    waiting: list[tuple] = []
    fresh = 0
    for t in count():
        while waiting and waiting[0][0] <= t:
            _, i, w, k = heapq.heappop(waiting)
            heapq.heappush(released, (-(-(k + 1) * total // w), i, w, k, 0, ()))
        while fresh < len(classes) and (not released or -(-total // classes[fresh][0]) <= released[0][0]):
            w, members = classes[fresh]
            heapq.heappush(released, (-(-total // w), members[0], w, 0, 0, members))
            fresh += 1
        due, i, w, k, at, members = heapq.heappop(released)
        yield i
        if at + 1 < len(members):
            heapq.heappush(released, (due, members[at + 1], w, 0, at + 1, members))
        heapq.heappush(waiting, ((k + 1) * total // w, i, w, k + 1))


def cycle(q: dict) -> list:
    """The source of each of the sum(q) slots of one cycle of integer weights."""
    names = _ordered(q)
    return [names[i] for i in islice(_turns(_classes([q[s] for s in names]), sum(q.values())), sum(q.values()))]


def schedule(blocks: dict, q: dict) -> dict:
    """The slots of the blocks of every source, phase by phase."""
    names = _ordered(blocks)
    left, weights = [blocks[s] for s in names], [q[s] for s in names]
    classes, total, slots = _classes(weights), sum(weights), array("i")
    while classes:
        for i in _turns(classes, total):
            slots.append(i)
            left[i] -= 1
            if not left[i]:
                break
        at = bisect_left(classes, -weights[i], key=lambda c: -c[0])
        members = classes[at][1]
        del members[bisect_left(members, i)]
        if not members:
            del classes[at]
        total -= weights[i]
    where = np.argsort(np.frombuffer(slots, np.int32), kind="stable")
    return dict(zip(names, np.split(where, np.cumsum([blocks[s] for s in names])[:-1])))


def _hashable(docs: DataFrame, numbers: bool = False) -> list[Column]:
    """The columns of ``docs`` that have a hash, or the numbers among them."""
    kinds = T.NumericType if numbers else T.AtomicType
    return [F.col(f"`{f.name}`") for f in docs.schema if isinstance(f.dataType, kinds) and not isinstance(f.dataType, T.VariantType)]


def placed(docs: DataFrame, weights: dict | None = None, source: str = "source", key: str = "doc_id", block: int = BLOCK, resolution: int | None = None) -> DataFrame:
    """``row`` (the whole row of ``docs`` as a struct), ``block`` (number within the source), ``slot``, and ``position``, dense from 0.

    The rows of a source are dealt into hash buckets (of the id; of all numbers of the row where that is null), ranked
    inside them, and shifted by the sizes of the buckets before, so a source of any size is spread over many tasks.
    Texts move once. Ties end with the hash of the whole row, so a repeated task ranks alike.
    """
    return _placed(docs, weights, source, key, block, resolution)[0]


def _placed(docs: DataFrame, weights: dict | None = None, source: str = "source", key: str = "doc_id", block: int = BLOCK, resolution: int | None = None) -> tuple[DataFrame, int]:
    """The rows of :func:`placed`, and their number."""
    spark = docs.sparkSession
    spread = F.coalesce(F.when(F.col(key).isNotNull(), F.xxhash64(key)), F.xxhash64(*_hashable(docs, numbers=True), F.lit(0)))
    # sources by a key that is never null: joins and windows on it ask for the same partitioning, so texts move once
    coded = F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n"))
    code = lambda s: "n" if s is None else f"s{s}"
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), coded.alias("source"), F.col(key).alias("key"), spread.alias("spread"),
        F.xxhash64(*_hashable(docs), F.lit(0)).alias("tie"),
    )
    sizes = {None if r["source"] == "n" else r["source"][1:]: r["n"] for r in rows.groupBy("source").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return rows.select("row", *(F.lit(None).cast("long").alias(c) for c in ("block", "slot", "position"))), 0
    blocks = {s: -(-n // block) for s, n in sizes.items()}
    given = {s: Fraction(w) for s, w in (weights or {}).items()}
    tempered = {s: Fraction(n**TEMPER) for s, n in sizes.items()}
    # sources without a target weigh, by size, like those with one
    known = [s for s in sizes if s in given]
    scale = sum(given[s] for s in known) / sum(tempered[s] for s in known) if known else 1
    targets = {s: given[s] if s in given else tempered[s] * scale for s in sizes}
    where = schedule(blocks, quantise(targets, resolution) if resolution else exact(targets))

    # documents before a slot: only the last block of a source may be short
    held = np.full(sum(blocks.values()), block, np.int64)
    for s, n in sizes.items():
        held[where[s][-1]] = n - (blocks[s] - 1) * block
    starts = np.cumsum(held) - held

    # a row a run of blocks: what the driver has dealt out, executors can hold
    named = F.broadcast(
        spark.createDataFrame(
            [(code(s), at // RUN, spots[at : at + RUN].tolist(), starts[spots[at : at + RUN]].tolist()) for s, spots in where.items() for at in range(0, len(spots), RUN)],
            "source string, run long, slots array<long>, starts array<long>",
        )
    )
    dealing = F.broadcast(spark.createDataFrame([(code(s), max(1, n // BUCKET)) for s, n in sizes.items()], "source string, buckets long"))
    bucketed = lambda df: df.join(dealing, "source").withColumn("bucket", F.pmod("spread", F.col("buckets"))).drop("buckets")
    inside = Window.partitionBy("source", "bucket").orderBy(F.xxhash64("key", F.lit(1)), "key", "tie")
    # as many partitions as keep each small, not joined into larger ones
    dealt = bucketed(rows).repartition(_parts(spark, sum(sizes.values())), "source", "bucket")
    ranked = dealt.withColumn("rank", F.row_number().over(inside) - 1)
    # one row per bucket, summed in two steps so that no source's buckets meet in one task
    counts = bucketed(rows.select("source", "spread")).groupBy("source", "bucket").agg(F.count("*").alias("n")).withColumn("part", F.floor(F.col("bucket") / 1_000))
    near = Window.partitionBy("source", "part").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    far = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.groupBy("source", "part").agg(F.sum("n").alias("n")).select("source", "part", F.coalesce(F.sum("n").over(far), F.lit(0)).alias("far"))
    shifts = counts.withColumn("near", F.coalesce(F.sum("n").over(near), F.lit(0))).join(parts, ["source", "part"]).select("source", "bucket", (F.col("near") + F.col("far")).alias("shift"))
    shifted = ranked.join(shifts, ["source", "bucket"]).withColumn("rank", F.col("rank") + F.col("shift"))
    numbered = shifted.withColumn("block", F.floor(F.col("rank") / block))
    numbered = numbered.withColumn("run", F.floor(F.col("block") / RUN))
    at = (F.col("block") % RUN + 1).cast("int")
    out = numbered.join(named, ["source", "run"]).select("row", "block", F.element_at("slots", at).alias("slot"), (F.element_at("starts", at) + F.col("rank") % block).alias("position"))
    return out, sum(sizes.values())


def positions(docs: DataFrame, weights: dict | None = None, **how) -> DataFrame:
    """``docs`` with block, slot and position; columns of these names are replaced."""
    made = ("block", "slot", "position")
    return placed(docs, weights, **how).select(*(F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in made), *made)


def _parts(spark: SparkSession, n: int) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // PART))


def mixed(docs: DataFrame, weights: dict | None = None, **how) -> DataFrame:
    """``docs``, the same columns, in the order of the mix: dealt by runs of positions to partitions and sorted.

    Positions are dense, so the runs are known beforehand and nothing is sampled. Written as files, partition by
    partition, the rows keep the order; :func:`file_positions` reads it back.
    """
    rows, n = _placed(docs, weights, **how)
    parts = _parts(docs.sparkSession, n)
    per = max(1, -(-n // parts))
    ordered = rows.repartitionById(parts, F.floor(F.col("position") / per).cast("int")).sortWithinPartitions("position")
    return ordered.select(*(F.col("row")[c].alias(c) for c in docs.columns))


def file_positions(written: DataFrame, out: str = "position") -> DataFrame:
    """``written`` with ``out``: the place of each row, dense from 0, in the order of its files by name and rows inside.

    ``written`` is read from Parquet. Readers order files by size, so only their names tell the order that they were
    written in. Rows that come from no file get a null.
    """
    name, row, before = (free(written, c) for c in ("_file", "_row", "_before"))
    try:
        rows = written.select("*", F.col("_metadata.file_name").alias(name), F.col("_metadata.row_index").alias(row))
    except AnalysisException:
        return written.withColumn(out, F.lit(None).cast("long"))
    files = written.select(F.col("_metadata.file_name").alias(name)).groupBy(name).agg(F.count("*").alias("n")).collect()  # a row a file
    start, starts = 0, []
    for f in sorted(files, key=lambda f: f[name]):
        starts.append((f[name], start))
        start += f["n"]
    sizes = written.sparkSession.createDataFrame(starts, f"`{name}` string, `{before}` long")
    return rows.join(F.broadcast(sizes) if len(starts) <= FILES else sizes, name).withColumn(out, F.col(before) + F.col(row)).drop(name, row, before)


def op4_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions(table(spark, sf_dir, "documents"))


QUERIES = {"op4_pfair_mix": op4_pfair_mix}
SQL: dict[str, str] = {}
