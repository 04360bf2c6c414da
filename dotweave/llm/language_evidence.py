"""Language identification by Bayesian evidence fusion.

The evidence on a web page, in log space:

* its text: a byte 4-gram model per language (SLOTS numbers each, for any number of
  languages), fitted on a bounded sample of documents of known language (``SAMPLE``
  texts a language), as a mean over the
  page's grams times at most ``GRAMS``, since neighbouring grams are no
  independent witnesses;
* the language declared in the markup, and a language in the address (the suffix of
  the host, or a first path element that looks like one): how often each value goes
  with each language is counted over all pages by grouped aggregation, with the
  text's posterior as soft labels;
* the host: a Dirichlet prior smoothed along page < host < domain < suffix < all,
  whose counts are grouped aggregations of the posteriors of all pages; a page's own
  posterior is taken out of each count before it votes.

Only ids, addresses and one number per language are shuffled, never pages. Counts
of a host meet its pages by an equi-join, which adaptive execution splits where a
host is hot.

Defined cases: null or empty html has no text evidence and relies on address and
prior; a null or unparsable url has host, domain and suffix ''; unknown declared
values count as a value like any other; ties go to the first language by name;
repeated rows each give a row; an empty table gives no rows; without labelled
documents there are no languages and the result is empty; the operators read the
columns they name, so further columns of any name play no part; very long pages are
read whole, in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, mix64, table, utf8_parts

SAMPLE, PARTS = 400, 16
SLOTS, GRAMS = 1 << 16, 60.0
#: Pseudo-counts that a level borrows from the one above.
STRENGTH = 5.0
#: Share of a categorical table that is spread evenly over its values.
BLEND = 1.0


def gram_slots(data: np.ndarray) -> np.ndarray:
    """The slot of each 4-gram of lower-cased bytes."""
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint64)
    if len(low) < 4:
        return np.zeros(0, np.int64)
    g = low[:-3] | low[1:-2] << np.uint64(8) | low[2:-1] << np.uint64(16) | low[3:] << np.uint64(24)
    return (mix64(g) & np.uint64(SLOTS - 1)).astype(np.int64)


def fit_text(samples: DataFrame, languages: list[str]) -> np.ndarray:
    """(SLOTS, languages) float32 log probabilities from rows (lang, text); grams are counted where the texts are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = utf8_parts(batch.column("text"))
            counts: dict[str, np.ndarray] = {}
            for lang, a, b in zip(batch.column("lang").to_pylist(), offs[:-1], offs[1:]):
                for at in range(a, b, 1 << 20):  # long texts in pieces that overlap by three bytes
                    now = counts.setdefault(lang, np.zeros(SLOTS, np.int64))
                    now += np.bincount(gram_slots(data[at : min(b, at + (1 << 20) + 3)]), minlength=SLOTS)
            for lang, n in counts.items():
                slot = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slot), pa.string()), pa.array(slot, pa.int64()), pa.array(n[slot], pa.int64())], ["lang", "slot", "n"])

    counted = samples.select("lang", "text").mapInArrow(run, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    made, place = np.full((len(languages), SLOTS), 0.1), {x: i for i, x in enumerate(languages)}
    # SLOTS rows a language at most
    for lang, part in counted.toPandas().groupby("lang"):
        made[place[lang], part["slot"]] += part["n"]
    return np.ascontiguousarray(np.log(made / made.sum(axis=1, keepdims=True)).T.astype(np.float32))


def text_evidence(df: DataFrame, text: str, model: np.ndarray, out: str = "evidence") -> DataFrame:
    """``df`` without ``text``, with ``out``: an array of log likelihoods, one per language."""
    keep = [c for c in df.columns if c not in (text, out)]
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep) + f", {out} array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = utf8_parts(batch.column(text))
            rows = np.zeros((batch.num_rows, model.shape[1]))
            for i, (a, b) in enumerate(zip(offs[:-1], offs[1:])):
                slots = gram_slots(data[a:b])
                if len(slots):
                    # long texts in pieces, so that memory stays bounded
                    total = sum(model[slots[s : s + 65_536]].sum(axis=0, dtype=np.float64) for s in range(0, len(slots), 65_536))
                    rows[i] = total / len(slots) * min(len(slots), GRAMS)
            offsets = pa.array(np.arange(0, rows.size + 1, model.shape[1], dtype=np.int32))
            column = pa.ListArray.from_arrays(offsets, pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), column], [*keep, out])

    return df.mapInArrow(run, schema)


def visible(html: Column) -> Column:
    """The text of a page without scripts, styles, comments and tags; one that is never closed reaches to the end, so each byte is looked at once."""
    bare = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)\b.*?(?:</\1\s*>|\z)|<!--.*?(?:-->|\z)|<[a-z/!?][^>]*(?:>|\z)", " ")
    return F.regexp_replace(bare, r"\s+|&[a-zA-Z0-9#]{1,8};", " ")


def declared(html: Column) -> Column:
    """The primary language tag of the html element, or ''."""
    return F.lower(F.regexp_extract(F.coalesce(html, F.lit("")), r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2,3})\b""", 1))


def address(url: Column) -> dict[str, Column]:
    """host, domain (its last two labels), suffix (its last label) and the language that address names."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    path = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?i)^[a-z][a-z0-9+.-]*://[^/?#]+/([a-z]{2})(?:-[a-z]{2})?(?:[/?#]|$)", 1))
    suffix = F.regexp_extract(host, r"([^.]*)$", 1)
    return {
        "host": host,
        "domain": F.regexp_extract(host, r"([^.]*\.?[^.]*)$", 1),
        "suffix": suffix,
        "named": F.when(path != "", path).otherwise(F.when(F.length(suffix) == 2, suffix).otherwise(F.lit(""))),
    }


def _softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    up = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(up, lambda x: x / F.aggregate(up, F.lit(0.0), lambda a, b: a + b))


def _sums(df: DataFrame, by: list[str], n: int, prefix: str) -> DataFrame:
    return df.groupBy(*by).agg(F.array(*(F.sum(F.col("p")[i]) for i in range(n))).alias(prefix))


def fuse(pages: DataFrame, languages: list[str], key: str = "page_id") -> DataFrame:
    """``key, lang, probability, probabilities`` from rows of key, evidence, declared, host, domain, suffix, named."""
    n = len(languages)
    rows = cut(pages.withColumn("p", _softmax(F.col("evidence"))))
    zero = F.array(*[F.lit(0.0)] * n)
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    sums = F.array(*(F.coalesce(F.sum(F.col("p")[i]), F.lit(0.0)) for i in range(n))).alias("p")
    every = rows.agg(sums, F.count_distinct("declared").alias("declared"), F.count_distinct("named").alias("named")).first()
    total = F.array(*map(F.lit, every["p"]))

    # the hierarchy: each level's counts without the page's own vote, smoothed by the level above
    joined = rows
    for level in ("suffix", "domain", "host"):
        joined = joined.join(_sums(rows, [level], n, f"c_{level}"), level, "left")
    own = lambda c: F.zip_with(c, F.col("p"), lambda x, y: F.greatest(x - y, F.lit(0.0)))

    def smoothed(counts: Column, above: Column) -> Column:
        size = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
        return F.zip_with(counts, above, lambda x, y: (x + STRENGTH * y) / (size + STRENGTH))

    prior = smoothed(own(total), F.array(*[F.lit(1.0 / n)] * n))
    for level in ("suffix", "domain", "host"):
        name = f"prior_{level}"
        joined = joined.withColumn(name, smoothed(own(F.col(f"c_{level}")), prior))
        prior = F.col(name)

    # how values of the markup and the address go with languages
    for value in ("declared", "named"):
        counts = _sums(rows, [value], n, f"c_{value}")
        kinds = max(every[value], 2)
        joined = joined.join(counts, value, "left")
        both = F.zip_with(own(F.col(f"c_{value}")), own(total), lambda x, t: F.struct(x.alias("x"), t.alias("t")))
        smooth = F.transform(both, lambda s: F.log((s["x"] + BLEND) / (s["t"] + BLEND * kinds)))  # noqa: B023
        joined = joined.withColumn(f"e_{value}", F.when(F.col(value) == "", zero).otherwise(smooth))

    logs = reduce(add, [F.col("evidence"), F.col("e_declared"), F.col("e_named"), F.transform(F.col("prior_host"), lambda x: F.log(x))])
    done = joined.select(key, _softmax(logs).alias("probabilities"))
    best = F.array_max("probabilities")
    names = F.array(*map(F.lit, languages))
    return done.select(key, F.get(names, (F.array_position("probabilities", best) - 1).cast("int")).alias("lang"), best.alias("probability"), "probabilities")


def language_samples(docs: DataFrame, per_language: int = SAMPLE) -> tuple[DataFrame, list[str]]:
    """Rows (lang, text) of at most ``per_language`` texts of each language, those of smallest hash of doc_id; and the languages.

    Ids are ranked first, for all languages in one pass: partitions keep their smallest before anything is shuffled.
    """
    known = docs.filter(F.col("lang").isNotNull()).select("doc_id", "lang")
    # a frequent language is dealt over PARTS tasks, which keep their smallest, before they meet
    part = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(PARTS))
    for by in (["lang", part], ["lang"]):
        first = Window.partitionBy(*by).orderBy(F.xxhash64("doc_id"), "doc_id")
        known = known.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= per_language).select("doc_id", "lang")
    ids = known.distinct().collect()
    few = docs.sparkSession.createDataFrame([(r["doc_id"], r["lang"]) for r in ids], "d long, l string")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("lang") == F.col("l"))
    return docs.select("doc_id", "lang", "text").join(F.broadcast(few), same).select("lang", "text"), sorted({r["lang"] for r in ids})


def op6_language_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples, languages = language_samples(table(spark, sf_dir, "documents"))
    pages = table(spark, sf_dir, "pages")
    if not languages:
        return spark.createDataFrame([], "page_id long, lang string, probability double")
    seen = pages.select("page_id", visible(F.col("html")).alias("text"), declared(F.col("html")).alias("declared"), *(c.alias(k) for k, c in address(F.col("url")).items()))
    evidence = text_evidence(seen, "text", fit_text(samples, languages))
    return fuse(evidence, languages).select("page_id", "lang", "probability")


QUERIES = {"op6_language_evidence": op6_language_evidence}
SQL: dict[str, str] = {}
