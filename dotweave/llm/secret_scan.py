"""Secrets in texts: three base patterns, and random strings found by how badly a tokenizer compresses them.

Base kinds, each scanned from left to right without overlaps, matches that fail their length test dropped after the scan:
``assign`` (a key word, ``:`` or ``=``, a value of 8 or more characters), ``access`` (access key ids of 16 or more) and
``hex`` (lower-case hexadecimal runs of 32 or more).

The method adds the kind ``random``. A byte-pair vocabulary has long tokens for what people write and almost none for what
a generator draws, so a run of key characters whose number of characters a token falls below ``LIMIT`` is a random string.
The runs are of ``LEAST`` or more characters with ``DISTINCT`` or more different ones. Each part of a run between ``/._=-``
is looked at alone, so that a key inside an address is its own span; a run none of whose parts is random (they may be too
short) is looked at as a whole. Left out are known digests (hexadecimal text of the length of a digest, integrity values, and the values given as ``known``) and
known identifiers (UUIDs, ULIDs, DOIs, numbers with separators), and what overlaps a base span, which is reported as such.

Offsets count code points, ends are exclusive. A text is read whole, in its worker; nothing is shuffled.

Defined cases: null and empty texts have no spans; repeated rows each give a row; further columns pass through, the
result's own name is freed (``secrets``, ``secrets_``, ...); an empty table gives no rows; ties of start are ordered by kind.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free, small, table
from .tokenize_bpe import encode, encoder, public_ranks

#: Base kinds in their order, then the method's own.
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "random")
#: Characters a token below which a run is random; prose, names and long words lie above 2.5, generated keys at 1.3 to 1.9.
LIMIT = 2.1
#: Characters, and different characters, of the shortest run that is looked at.
LEAST, DISTINCT = 20, 10
#: Texts known to be digests that a closure may carry to the workers.
MOST_KNOWN = 100_000

_ASSIGN = re.compile(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_RUN = re.compile(rf"[A-Za-z0-9+/_.=-]{{{LEAST},}}")
_PART = re.compile(r"[A-Za-z0-9+]+")
_DIGEST = re.compile(r"(?:md5|sha1|sha224|sha256|sha384|sha512)?[=-]?(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})|sha(?:256|384|512)-[A-Za-z0-9+/]{43,86}={0,2}")
_IDENTIFIER = re.compile(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}|[0-7][0-9A-HJKMNP-TV-Z]{25}|10\.[0-9]{4,9}/.+|[0-9+/_.=-]+")

SPAN = T.StructType([T.StructField("kind", T.StringType(), False), T.StructField("start", T.IntegerType(), False), T.StructField("end", T.IntegerType(), False)])
_ARROW = pa.list_(pa.struct([pa.field("kind", pa.string(), False), pa.field("start", pa.int32(), False), pa.field("end", pa.int32(), False)]))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind in KINDS, end) of the three patterns."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    # a run is as long as it can be, so the length test inside the pattern finds what a test after the scan would
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def is_random(enc, run: str, limit: float = LIMIT, known: Collection[str] = ()) -> bool:
    """Whether a run of key characters costs a token for every ``limit`` characters or less, and is no known digest or identifier."""
    if len(run) < LEAST or len(set(run)) < DISTINCT or run in known or _DIGEST.fullmatch(run) or _IDENTIFIER.fullmatch(run):
        return False
    return len(run) < limit * len(encode(enc, run))


def random_spans(enc, text: str, taken: list[tuple[int, int, int]], limit: float = LIMIT, known: Collection[str] = ()) -> list[tuple[int, int, int]]:
    """Random strings of ``text`` that overlap none of the ``taken`` spans."""
    found = []
    for m in _RUN.finditer(text):
        run = m.group()
        start = m.start() + len(run) - len(run.lstrip("/._=-"))
        run = run.strip("/._-").lstrip("=")
        if _DIGEST.fullmatch(run) or _IDENTIFIER.fullmatch(run) or run in known:
            continue
        parts = [(start + p.start(), 3, start + p.end()) for p in _PART.finditer(run) if is_random(enc, p.group(), limit, known)]
        found += parts or [(start, 3, start + len(run))] * is_random(enc, run, limit, known)
    if not taken:
        return found
    free_of, at, reach = [], 0, -1
    for start, kind, end in found:
        while at < len(taken) and taken[at][0] < end:
            reach = max(reach, taken[at][2])
            at += 1
        if reach <= start:
            free_of.append((start, kind, end))
    return free_of


def with_secrets(df: DataFrame, rank_file: str, pattern: str, text: str = "text", out: str = "secrets", limit: float = LIMIT, known: Collection[str] = ()) -> DataFrame:
    """``df`` with ``out``, the array of (kind, start, end) of all spans by start, then kind.

    ``known`` are values that are no secrets (digests of published files), at most MOST_KNOWN.
    """
    if len(known) > MOST_KNOWN:
        raise ValueError(f"at most {MOST_KNOWN} known values; take out more with an anti join on the spans' texts")
    known = frozenset(known)
    out = free(df, out)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(SPAN, False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(rank_file, pattern)
        for batch in small(batches, 500):
            rows = []
            for value in batch.column(text):
                whole = value.as_py() or ""
                base = base_spans(whole)
                spans = sorted(base + random_spans(enc, whole, base, limit, known))
                rows.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, _ARROW)], [*batch.schema.names, out])

    return df.mapInArrow(run, schema)


def with_redacted(df: DataFrame, spans: str = "secrets", text: str = "text", mark: str = "*") -> DataFrame:
    """``df`` with every character inside a span replaced by ``mark``, in ``text`` itself."""
    a = F.col(spans)
    # spans may overlap, so each one covers from the furthest end before it
    start = F.aggregate(
        a,
        F.struct(F.lit("").alias("made"), F.lit(0).alias("at")),
        lambda s, x: F.struct(
            F.concat(s["made"], F.substring(F.col(text), s["at"] + 1, F.greatest(x["start"] - s["at"], F.lit(0))), F.repeat(F.lit(mark), F.greatest(x["end"] - F.greatest(x["start"], s["at"]), F.lit(0)))).alias("made"),
            F.greatest(s["at"], x["end"]).alias("at"),
        ),
        lambda s: F.concat(s["made"], F.substring(F.col(text), s["at"] + 1, F.length(F.col(text)))),
    )
    return df.withColumn(text, F.when(F.size(a) > 0, start).otherwise(F.col(text)))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of an array of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), *public_ranks()).drop("text")
    spans = F.col("secrets")
    counts = [F.size(F.array_compact(F.transform(spans, lambda s: F.when(s["kind"] == kind, 1)))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    base = F.sha2(joined(F.filter(spans, lambda s: s["kind"].isin(*BASE))).cast("binary"), 256)
    return found.select("doc_id", *counts, base.alias("base_sha256"), joined(spans).alias("spans"))


QUERIES = {"op11_secret_scan": op11_secret_scan}
SQL: dict[str, str] = {}
