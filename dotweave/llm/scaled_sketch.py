"""Threshold-scaled sketches of documents.

A sketch keeps every shingle hash below a fixed fraction ``1 / SCALE`` of the hash
range, and always the smallest hash, so a text with any byte has one. What is kept
of a shingle depends on that shingle alone: the sketch of a union is the union of
the sketches (:func:`merge`), and shares of kept hashes estimate similarity and
containment even of very unequal documents (:func:`likeness`, :func:`containment`).
Shingles are ``WIDTH`` consecutive bytes of the UTF-8 text; a shorter text is one.

Stored form: the kept 32-bit hashes, ascending, little-endian, in base64.

Defined cases: null text counts as empty; an empty text has an empty sketch, which
is wholly like another empty one and not at all like any other; a null doc_id
sorts below all; rows of equal doc_id stand next to each other in the order of
their texts' hashes; a single document is its own next; an empty table gives none.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix64, table

WIDTH, SCALE = 16, 16
#: Rows of one bucket of the document order, about; more where that would be more than MOST_BUCKETS, whose first ids
#: every worker knows.
BUCKET_ROWS, MOST_BUCKETS = 4_000, 100_000
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_POWERS: list[np.ndarray] = [np.zeros(0, np.uint64)] * 2


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n + 1:
        size = max(n, 1 << 17)
        _POWERS[:] = [np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, p))]) for p in (_P, _P_INV)]
    return _POWERS


def sketch(raw: bytes, scale: int = SCALE) -> np.ndarray:
    """The kept hashes of a text, ascending uint32."""
    a = np.frombuffer(raw, np.uint8)
    if not len(a):
        return np.zeros(0, np.uint32)
    up, down = _powers(len(a))
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum((a + np.uint64(1)) * up[: len(a)], out=sums[1:])
    width = min(WIDTH, len(a))
    h = mix64((sums[width:] - sums[:-width]) * down[: len(a) - width + 1] + np.uint64(width)) >> np.uint64(32)
    limit = (1 << 32) // scale
    kept = h[h < limit]
    return np.unique(kept if len(kept) else h.min(keepdims=True)).astype(np.uint32)


def merge(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sketch of the union of two documents' shingles."""
    both = np.union1d(a, b)
    low = both[both < (1 << 32) // scale]
    return low if len(low) else both[:1]


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of the shingle sets."""
    if not len(a) and not len(b):
        return 1.0
    n = _shared(a, b)
    return n / (len(a) + len(b) - n)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the shingles of ``a`` that ``b`` has."""
    return _shared(a, b) / len(a) if len(a) else 1.0


def to_text(kept: np.ndarray) -> str:
    return base64.b64encode(kept.astype("<u4").tobytes()).decode()


def from_text(stored: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(stored), "<u4")


def with_sketch(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``df`` with ``out``, the stored sketch of ``text``; one pass without a shuffle."""
    from pyspark.sql import types as T

    keep = [c for c in df.columns if c.lower() != out.lower()]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [to_text(sketch((t.as_py() or "").encode())) for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(made, pa.string())], [*keep, out])

    return df.mapInArrow(run, schema)


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as many first code points of ``following`` (or all)."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


_LOWEST = -(1 << 63)
_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of sorted buckets -> one result per row that is no tail; the next row of a bucket is the next document."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    names = [x.split()[0] for x in _RESULT.split(", ")]
    held = None
    for batch in batches:
        rows = []
        for bucket, tail, doc_id, packed in zip(*(batch.column(c).to_pylist() for c in ("bucket", "tail", "doc_id", "packed"))):
            text = unpack(packed).decode() if packed else ""
            own = sketch(text.encode())
            if held and held[0] == bucket:
                _, before, first, kept = held
                new = edited(first, text)
                raw = new.encode()
                changed = sketch(raw)
                rows.append((before, len(first), hashlib.sha256(raw).hexdigest(), to_text(kept), to_text(changed), likeness(kept, changed), likeness(kept, own)))
            held = None if tail else (bucket, doc_id, text, own)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 7, kinds)], names)


def _tie(packed: bytes) -> int:
    """Order of rows of one id: 56 bits of a digest of the compressed text."""
    return int.from_bytes(hashlib.blake2b(packed, digest_size=7).digest())


def _packed(text: str | None) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(text.encode()) if text else b""


class Buckets:
    """The document order in buckets: ids descending, rows of one id by :func:`_tie`.

    ``edges``: ascending ids that end a bucket; ``hot``: ids of more rows than two buckets should have (nulls count as one id),
    which stand alone and are split by ties into so many parts.
    """

    def __init__(self, edges: np.ndarray, hot: dict[int, int]):
        self.edges, self.hot = edges, hot

    def __call__(self, k: np.ndarray, tie: np.ndarray) -> np.ndarray:
        bucket = (len(self.edges) - np.searchsorted(self.edges, k, "left")) << 32
        for key, parts in self.hot.items():
            own = k == key
            if own.any():
                bucket[own] += (tie[own] >> 24) * parts >> 32
        return bucket


def buckets(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> Buckets | None:
    """Of about ``bucket_rows`` rows; none for an empty table. ``docs``: k. Only an id that ends several buckets can be hot, so ids are counted for such alone."""
    count = docs.count()
    if not count:
        return None
    cuts = min(max(1, count // bucket_rows), MOST_BUCKETS)
    marks = docs.agg(F.percentile_approx("k", [i / cuts for i in range(1, cuts)] or [0.5], max(10_000, 4 * cuts)).alias("q")).first()["q"]
    edges, often = np.unique(np.array(marks, np.int64), return_counts=True)
    hot = {}
    if (often > 1).any():
        for r in docs.filter(F.col("k").isin(edges[often > 1].tolist())).groupBy("k").agg(F.count("*").alias("n")).collect():
            if r["n"] * cuts > 2 * count:
                hot[r["k"]] = -(-r["n"] * cuts // count)
    alone = [e for k in hot for e in (k - 1, k) if e >= _LOWEST]
    return Buckets(np.unique(np.concatenate([edges, np.array(alone, np.int64)])), hot)


def next_likeness(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Sketches of each document (doc_id, text), of its edited text, and likenesses to that and to the next document.

    The order is cut into buckets of about ``bucket_rows`` rows. A row goes, compressed, to its bucket; the first
    row of a bucket goes also, as a tail, to the bucket before, so every row meets its next one in one shuffle
    and no task sees more than its buckets. Null ids come last; rows of one id, nulls as well, follow each other by a digest
    of their texts, and where they are many, buckets part them by it (equal texts of one id stay in one).
    """
    key = F.coalesce(F.col("doc_id"), F.lit(_LOWEST))
    ids = docs.select(key.alias("k"))
    place = buckets(ids, bucket_rows)
    if not place:
        return docs.sparkSession.createDataFrame([], _RESULT)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), key.alias("k"))
    hot = list(place.hot)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = np.asarray(b.column("k"))
            ties = np.array([_tie(_packed(t)) for t in b.column("text").to_pylist()] if "text" in b.schema.names else np.zeros(len(k)), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(place(k, ties)), pa.array(k), pa.array(ties)], ["bucket", "k", "tie"])

    # the first row of each bucket: the largest id, or the smallest tie of a part of a hot one, for which alone texts are read
    heads: dict[int, tuple[int, int]] = {}
    for some in [ids.filter(~F.col("k").isin(hot)), rows.filter(F.col("k").isin(hot)).select("k", "text")] if hot else [ids]:
        found = some.mapInArrow(first, "bucket long, k long, tie long").groupBy("bucket").agg(F.max("k").alias("k"), F.min("tie").alias("tie"))
        heads |= {r["bucket"]: (r["k"], r["tie"]) for r in found.collect()}
    filled = sorted(heads)
    before = {b: filled[i - 1] for i, b in enumerate(filled)}  # the first follows the last

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = np.asarray(batch.column("k"))
            packed = [_packed(t) for t in batch.column("text").to_pylist()]
            order = np.array([_tie(p) for p in packed], np.int64)
            bucket = place(k, order)
            copy = np.flatnonzero([heads[b][0] == i and (i not in place.hot or heads[b][1] == o) for b, i, o in zip(bucket.tolist(), k.tolist(), order.tolist())])
            at = np.concatenate([np.arange(len(k)), copy]).astype(np.int64)
            goal = np.concatenate([bucket, np.array([before[b] for b in bucket[copy]], np.int64)])
            tail = np.repeat([False, True], [len(k), len(copy)])
            whole = pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(packed, pa.binary()), pa.array(k), pa.array(order)], ["doc_id", "packed", "k", "o"]).take(pa.array(at))
            yield pa.RecordBatch.from_arrays([pa.array(goal), pa.array(tail), *whole.columns], ["bucket", "tail", "doc_id", "packed", "k", "o"])

    dealt = rows.mapInArrow(deal, "bucket long, tail boolean, doc_id long, packed binary, k long, o long").repartition("bucket")
    return dealt.sortWithinPartitions("bucket", "tail", F.desc("k"), "o").mapInArrow(_pairs, _RESULT)


def op8_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return next_likeness(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op8_scaled_sketch": op8_scaled_sketch}
SQL: dict[str, str] = {}
