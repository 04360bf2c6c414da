"""Hard negatives of anchor vectors, by a vector-approximation file.

Vectors are integers (``floor(256 x)`` of each component) and scores their inner products. Every dimension is cut into at
most ``CELLS`` cells of equal width between its extremes over the whole table, and a row is approximated by its cells. For
an anchor, a table a dimension holds the least contribution of each cell; a row's lower bound is the sum of what its cells
look up, its upper bound lies a fixed slack of the anchor above. Only rows whose bounds let them enter a window - the best
``positives`` of the anchor's label, or the best ``negatives`` of other labels inside a share of a positive's score - are
scored exactly; the others are never. The bounds are safe, so the result is that of scoring all.

Anchors are dealt by hash into blocks of about ``BLOCK``; a block (its vectors, labels and windows: at most some MB) is
broadcast and meets all rows in one pass for the positives and one for the negatives. A task keeps the best rows of each
window and returns those alone; they are ranked over all tasks by a window of at most ``negatives`` rows a task. No row is
moved, so a vector or label that many rows share makes no task larger than its share of the table.

Defined cases: rows with a null id, label, vector, or a null or non-finite component take no part; repeated ids are rows
of their own as candidates and one anchor (the one of smallest label, then vector); a row of the anchor's id is never its
positive or negative; vectors of other lengths count on the components that both have; ties go to the smaller id; an anchor
without positives, and a positive without negatives in its window, give no row; extra columns are not read; an empty table gives
no rows. A component of 2^27 or more in size is an error, since scores might not fit 64 bits.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, shared_dir, table

#: Cells a dimension; anchors a block, on average; entries of the lookup tables and of the bounds that a worker holds at once.
CELLS, BLOCK, TABLE, BOUNDS = 256, 2_048, 1 << 21, 1 << 20
_LOWEST = np.iinfo(np.int64).min // 4


def usable(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, label, v``: the rows that take part, their components scaled and floored, as doubles."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = F.transform(embedding, lambda x: F.floor(x.cast("double") * 256).cast("double"))
    rows = df.filter(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(embedding).isNotNull() & ~bad)
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), v.alias("v"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Vectors as int64 rows of ``dims`` components, missing ones 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ends = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]] if len(column) else np.zeros(0)
    if len(flat) and np.abs(flat).max() >= 1 << 27:
        raise ArithmeticError("a component of 2^27 or more: scores may not fit 64 bits")
    lengths = np.diff(ends)
    if (lengths == dims).all():
        return flat.reshape(len(column), dims).astype(np.int64)
    out = np.zeros((len(column), dims), np.int64)
    row = np.repeat(np.arange(len(column)), lengths)
    place = np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], lengths)
    inside = place < dims
    out[row[inside], place[inside]] = flat[inside].astype(np.int64)
    return out


def extremes(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of each dimension over all rows: two numbers a dimension reach the driver."""
    found = rows.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("*").alias("n")).orderBy("d").toPandas()
    # where some vectors are shorter, they count as 0
    zero = found["n"] < found["n"].max()
    return found["lo"].where(~zero, found["lo"].clip(upper=0)).to_numpy(np.int64), found["hi"].where(~zero, found["hi"].clip(lower=0)).to_numpy(np.int64)


class Cells:
    """The cells of every dimension: their lower ends and widths."""

    def __init__(self, lo: np.ndarray, hi: np.ndarray, cells: int = CELLS):
        self.lo, self.width = lo, np.maximum(1, -(-(hi - lo + 1) // cells))
        self.cells = cells

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Cell numbers, a row a dimension, as the index type of the lookups."""
        return np.clip((x - self.lo) // self.width, 0, self.cells - 1).T.astype(np.intp, order="C")

    def tables(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least contribution of each cell, (anchor, dimension, cell), and each anchor's slack."""
        low = self.lo[:, None] + np.arange(self.cells) * self.width[:, None]
        least = np.minimum(q[:, :, None] * low, q[:, :, None] * (low + self.width[:, None] - 1))
        return least, (np.abs(q) * (self.width - 1)).sum(axis=1)

    def bounds(self, q: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores, (anchor, row)."""
        least, slack = self.tables(q)
        if np.abs(least).max(initial=0) * max(1, len(codes)) < 1 << 31:
            least = least.astype(np.int32)
        lower = np.zeros((len(q), codes.shape[1]), least.dtype)
        for d in range(len(codes)):
            lower += least[:, d].take(codes[d], axis=1, mode="clip")
        lower = lower.astype(np.int64)
        return lower, lower + slack[:, None]


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row; _LOWEST where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), _LOWEST)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


class _Best:
    """The best ``k`` (score, id) of every window, over the batches of a task."""

    def __init__(self, windows: int, k: int):
        self.k, self.floor = k, np.full(windows, _LOWEST)
        self.window, self.score, self.key = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, window: np.ndarray, score: np.ndarray, key: np.ndarray) -> None:
        if not len(window):
            return
        w, s, i = np.concatenate([self.window, window]), np.concatenate([self.score, score]), np.concatenate([self.key, key])
        order = np.lexsort((i, -s, w))
        w, s, i = w[order], s[order], i[order]
        place = np.arange(len(w)) - np.searchsorted(w, w)
        keep = place < self.k
        self.window, self.score, self.key = w[keep], s[keep], i[keep]
        full = np.flatnonzero(place == self.k - 1)
        self.floor[w[full]] = s[full]


def _chunks(n: int, dims: int, rows: int) -> Iterator[slice]:
    step = max(1, min(TABLE // max(1, dims * CELLS), BOUNDS // max(1, rows)))
    for at in range(0, n, step):
        yield slice(at, min(n, at + step))


def _scan(rows: DataFrame, cells: Cells, block, positives: int, negatives: int | None) -> DataFrame:
    """``window, score, vec_id``: the best rows of each task, for windows of the block's anchors.

    ``block`` has ids, labels, q (anchor, dimension) and, for negatives, lo and hi (anchor, window) in whole scores.
    """
    shared = rows.sparkSession.sparkContext.broadcast((cells, block))
    per = negatives or positives

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, block = shared.value
        ids, labels, q, lo, hi = block
        dims, windows = q.shape[1], lo.shape[1] if negatives else 1
        best = _Best(len(ids) * windows, per)
        for batch in batches:
            key, label = np.asarray(batch.column("vec_id")), np.asarray(batch.column("label"))
            x = _matrix(batch.column("v"), dims)
            codes = cells.codes(x)
            for part in _chunks(len(ids), dims, len(key)):
                lower, upper = cells.bounds(q[part], codes)
                other = (label[None, :] != labels[part, None]) if negatives else (label[None, :] == labels[part, None]) & (key[None, :] != ids[part, None])
                other &= key[None, :] != ids[part, None]
                lower[~other], upper[~other] = _LOWEST, _LOWEST
                base = np.arange(part.start, part.stop) * windows
                wanted = np.zeros(lower.shape, bool)
                for j in range(windows):
                    first, last = (lo[part, j], hi[part, j]) if negatives else (np.full(len(base), _LOWEST + 1), np.full(len(base), -_LOWEST))
                    sure = np.where((lower >= first[:, None]) & (upper <= last[:, None]), lower, _LOWEST)
                    # rows that beat the k-th row sure to be inside, or the k-th exact score so far
                    floor = np.maximum(np.maximum(_kth(sure, per), best.floor[base + j]), first)
                    wanted |= (upper >= floor[:, None]) & (lower <= last[:, None])
                a, r = np.nonzero(wanted)
                score = np.concatenate([np.einsum("ij,ij->i", q[part][a[s : s + 65_536]], x[r[s : s + 65_536]]) for s in range(0, len(a), 65_536)]) if len(a) else a
                for j in range(windows):
                    inside = (score >= lo[part, j][a]) & (score <= hi[part, j][a]) if negatives else np.ones(len(a), bool)
                    best.add(base[a[inside]] + j, score[inside], key[r[inside]])
        yield pa.RecordBatch.from_arrays([pa.array(best.window), pa.array(best.score), pa.array(best.key)], ["window", "score", "vec_id"])

    found = rows.mapInArrow(run, "window long, score long, vec_id long")
    order = Window.partitionBy("window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90, cells: int = CELLS, block: int = BLOCK
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for ``rows`` as of :func:`usable`.

    For every anchor and each of its best ``positives`` rows of the same label: the best ``negatives`` rows of other labels
    whose score is from ``least`` to ``most`` hundredths of the positive's.
    """
    spark = rows.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    anchors = cut(rows.filter(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row")).select("vec_id", "row.label", "row.v"))
    n = anchors.count()
    lo, hi = extremes(rows)
    if not n:
        return spark.createDataFrame([], schema)
    blocks = -(-n // block)
    folder = f"{shared_dir(spark)}/hard-negatives-{uuid.uuid4().hex}" if blocks > 1 else None
    for b in range(blocks):
        some = anchors.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).orderBy("vec_id").toArrow()
        if not some.num_rows:
            continue
        q = _matrix(some.column("v"), len(lo))
        ids, labels = some.column("vec_id").to_numpy(), some.column("label").to_numpy()
        none = np.zeros((len(ids), 0), np.int64)
        best = _scan(rows, Cells(lo, hi, cells), (ids, labels, q, none, none), positives, None).toPandas()
        # a window a positive; those that are missing let nothing in
        first, last = np.ones((len(ids), positives), np.int64), np.zeros((len(ids), positives), np.int64)
        a, j, s = (best[c].to_numpy(np.int64) for c in ("window", "rank", "score"))
        first[a, j - 1], last[a, j - 1] = -(-least * s // 100), most * s // 100
        found = _scan(rows, Cells(lo, hi, cells), (ids, labels, q, first, last), positives, negatives)
        known = spark.createDataFrame(
            pa.table({"window": pa.array(a * positives + j - 1), "anchor_id": pa.array(ids[a]), "positive_id": pa.array(best["vec_id"].to_numpy(np.int64)), "positive_score": pa.array(s)})
        )
        made = found.join(F.broadcast(known), "window").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        if not folder:
            return made
        made.write.mode("append").parquet(folder)
    return spark.read.schema(schema).parquet(folder)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = usable(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label").withColumn("label", shifted))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


QUERIES = {"op13_hard_negatives": op13_hard_negatives}

SQL = {
    "op13_hard_negatives": """WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS s FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
pos AS (SELECT anchor_id, vec_id AS positive_id, s AS positive_score FROM p WHERE label = anchor_label QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s DESC, vec_id) AS INT) AS rank, vec_id AS negative_id, positive_score, s AS negative_score FROM pos JOIN p USING (anchor_id)
WHERE label <> anchor_label AND 30 * positive_score <= 100 * s AND 100 * s <= 90 * positive_score QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s DESC, vec_id) <= 10"""
}
