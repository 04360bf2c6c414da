"""A training-data pipeline over ``documents``: five stages, each one operator of dotweave.llm.

quality -> toxicity -> near duplicates -> source mix -> tokens. Every stage reads what
its predecessor wrote as Parquet into the shared folder. The first three drop rows,
the fourth orders them (files and rows follow the mix), the last turns texts into
token ids and gives each its position in the mix; all but the last return the columns
of ``documents``, further columns included.

Defined cases: null, empty and blank texts are scored like any other by the classifiers
and have no near copies, so the join keeps each row of them; of equal rows the join
keeps one; a null doc_id is an id like any other; a null source is a source of its own;
very long texts are read whole by every stage; columns that bear the name of an
operator's own are carried unchanged; empty tables, or labels of one class only, leave
each stage an empty or unfiltered table.

ORACLE_SQL is None: SQL can express neither classifier nor the join; the tests hold
the stages against brute force instead.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dotweave.llm import jaccard_join, pfair_mix, quality_cnn, tokenize_bpe, toxicity
from dotweave.llm.common import drop_path, free, shared_dir, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte-level network takes for good."""
    model = quality_cnn.fit_on(docs, table(spark, sf_dir, "labels"), quality_cnn.held_out())
    score = free(docs, "_score")
    return quality_cnn.with_score(docs, model, out=score).filter(F.col(score) >= quality_cnn.CUT).select(*docs.columns)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose compression evidence stays below the toxic threshold."""
    model = toxicity.fit_on(docs, table(spark, sf_dir, "labels"), toxicity.held_out())
    score = free(docs, "_score")
    return toxicity.with_score(docs, model, out=score).filter(F.col(score) < toxicity.CUT).select(*docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest doc_id."""
    return jaccard_join.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the tempered source mix."""
    return pfair_mix.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and its ``position`` in the mix, which the files of the stage before hold in their order.

    Rows of no file have a null position.
    """
    placed = pfair_mix.file_positions(docs.select("doc_id", "lang", "source", "text"))
    made = tokenize_bpe.with_tokens(placed, *tokenize_bpe.public_ranks())
    return made.select("position", "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("toxicity", clean),
    ("n-gram jaccard join", distinct),
    ("mixing sources", mix),
    ("byte-level bpe", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and read again by the next."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    atexit.register(_forget, spark, folder)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)


def _forget(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:
        drop_path(spark, path)
