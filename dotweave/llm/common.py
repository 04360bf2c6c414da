"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Bytes of the sampled texts of a class that reach the driver, but for the last text.
SAMPLE_BYTES = 1 << 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Where that is unset, a session with a local master, whose executors are this machine, gets a temporary folder; any
    other is an error, since no folder of one machine would be shared.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="dotweave-checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, so that a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def free(df: DataFrame, name: str) -> str:
    """``name``, or the first of name_, name__, ... that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that Spark itself uses for it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def utf8_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column without a copy; null counts as empty.

    Text i is ``data[offsets[i]:offsets[i + 1]]``.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offs = np.frombuffer(offsets, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def small(batches, rows: int = 1_000):
    """The same rows in batches of at most ``rows``, so that what is made of a batch at once stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser (splitmix64) on uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, held_out, per_class: dict[int, int]) -> tuple[dict[int, list[str]], dict[int, int]]:
    """A bounded sample of labelled texts for fitting, and the number of labelled rows of each class.

    ``labels`` has ``doc_id`` and ``label`` (0 or 1); rows where ``held_out`` (a column of doc_id) holds are
    not used, nor null labels; of contradicting labels the larger counts. At most ``per_class[c]`` texts of
    class c, those of smallest hash of doc_id, reach the driver, and none after the one that brings the class to
    SAMPLE_BYTES: the ids are chosen from the labels alone, so the texts of no other document move.
    """
    known = labels.filter(F.col(label).isin(0, 1) & ~held_out & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64("doc_id")
    chosen = [r for c, n in per_class.items() for r in known.filter(F.col("label") == c).orderBy(order, "doc_id").limit(n).collect()]
    texts: dict[int, list[str]] = {c: [] for c in per_class}
    if chosen:
        few = docs.sparkSession.createDataFrame([(r["doc_id"], r["label"]) for r in chosen], "doc_id long, label int")
        got = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").groupBy("doc_id").agg(F.max("label").alias("label"), F.max("text").alias("text"))
        # a window over the sample alone
        before = Window.partitionBy("label").orderBy(order, "doc_id").rowsBetween(Window.unboundedPreceding, -1)
        held = F.coalesce(F.sum(F.octet_length("text")).over(before), F.lit(0))
        for r in sorted(got.withColumn("held", held).filter(F.col("held") < SAMPLE_BYTES).collect(), key=lambda r: r["doc_id"]):
            texts[r["label"]].append(r["text"] or "")
    return texts, {c: sizes.get(c, 0) for c in per_class}


def logit_fit(x: np.ndarray, y: np.ndarray, l2: float = 1e-2, steps: int = 60) -> np.ndarray:
    """Logistic regression by Newton steps; the last weight is the intercept (not shrunk)."""
    x = np.column_stack([x, np.ones(len(x))])
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], l2)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag(ridge), grad)
        w -= np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-7:
            break
    return w


def prior_shift(used: dict[int, int], sizes: dict[int, int]) -> float:
    """What to add to log odds fitted on ``used`` rows a class so that they hold for classes of ``sizes`` rows."""
    return float(np.log((sizes[1] + 0.5) / (sizes[0] + 0.5)) - np.log((used[1] + 0.5) / (used[0] + 0.5)))
