"""WARC archives: write, read, and resolve revisits.

Writing: digests and sizes of all payloads (headers, no payloads) are shuffled by
digest; in each group of equal payloads of at least ``LEAST`` bytes the smallest
page id is the response and the others become revisit records, which hold headers
only. A payload crosses the network at most once, dealt by page id, and archives
go out through Spark's own text sink with the record terminator as line separator,
so any store that Spark can write to will do. Each archive is one gzip stream.

Reading: archives are framed by Content-Length, never by searching payloads for
separators; payload digests are computed anew. Revisits are joined to the
responses of their digest, which gives their length and original. Archives of other
writers are read too, packed or plain: record ids that are no page ids are kept as ``record_id`` with a
null page id, further record types are rows of their own, members a record or a file
make no difference. An archive is read as one value, so files are bounded: records of up to
LARGE bytes go FILE_RECORDS to a file, larger ones so many that FILE_BYTES hold them.

:func:`deduplicate_archives` reads archives, and writes them again with equal
payloads resolved and fresh headers. No record is lost: revisits find their response by digest, or
else by the record id they refer to; what finds none, and any other record type, is
written as it was. Record ids, dates, addresses and HTTP heads are those of the source.

Defined cases: null or empty html is an empty payload (a response); a null page id
is always a response and is read back as null; repeated rows of the smallest page
id are all responses, repeated revisits all revisits; a null url gives no target
address, and line breaks or spaces in one are percent-encoded; payload bytes that are
no UTF-8 are kept as they are; very long payloads are whole; further columns are
ignored; an empty table gives an archive folder without records and no rows.
"""

from __future__ import annotations

import atexit
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, drop_path, shared_dir, table

#: Payload bytes from which equal payloads are stored once.
LEAST = 100
#: Records of one archive file at most; payload bytes above which a record is large, and of a file of large ones.
FILE_RECORDS, LARGE, FILE_BYTES = 4_000, 1 << 16, 1 << 28
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, record_id string"
#: What :func:`deduplicate_archives` needs of a record besides: digest and reference as stated, date, kind, and the bytes of its heads and payload.
_WHOLE = "stated string, refers_id string, date string, kind string, head binary, http binary, payload binary"


def revisits(heads: DataFrame, least: int = LEAST) -> DataFrame:
    """``page_id, digest, original`` of every page whose payload an earlier page has; ``heads``: page_id, digest, bytes."""
    sized = heads.filter(F.col("bytes") >= least)
    groups = sized.groupBy("digest").agg(F.min("page_id").alias("original"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return sized.join(groups, "digest").filter(F.col("page_id") != F.col("original")).select("page_id", "digest", "original").distinct()


def record(page_id: Column, url: Column, payload: Column, digest: Column, size: Column, original: Column, date: str) -> Column:
    """The text of one record without its terminator."""
    again = original.isNotNull()
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    safe = F.regexp_replace(F.regexp_replace(F.regexp_replace(url, "\r", "%0D"), "\n", "%0A"), " ", "%20")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), size.cast("string"), F.lit(CRLF * 2))
    body = F.octet_length(http) + F.when(again, F.lit(0)).otherwise(size)
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(again, F.lit("revisit")).otherwise(F.lit("response")), F.lit(f"{CRLF}WARC-Record-ID: "), name(page_id),
        F.lit(f"{CRLF}WARC-Date: {date}"), F.coalesce(F.concat(F.lit(f"{CRLF}WARC-Target-URI: "), safe), F.lit("")),
        F.lit(f"{CRLF}WARC-Payload-Digest: sha256:"), digest,
        F.when(again, F.concat(F.lit(f"{CRLF}WARC-Profile: {PROFILE}{CRLF}WARC-Refers-To: "), name(original))).otherwise(F.lit("")),
        F.lit(f"{CRLF}Content-Type: application/http; msgtype=response{CRLF}Content-Length: "), body.cast("string"), F.lit(CRLF * 2),
        http, F.when(again, F.lit("")).otherwise(payload),
    )


def _classes(most: int, file_records: int = FILE_RECORDS) -> list[tuple[Column, int]]:
    """Which rows (by ``bytes``, ``most`` at most) go into files together, and how many of them into one."""
    if most <= LARGE:
        return [(F.lit(True), file_records)]
    return [(F.col("bytes") <= LARGE, file_records), (F.col("bytes") > LARGE, min(file_records, max(1, FILE_BYTES // most)))]


def _write(made: DataFrame, path: str, records: int) -> None:
    made.select("value").write.mode("append").option("lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", records).text(path)


def write_archives(pages: DataFrame, path: str, least: int = LEAST, date: str = "2000-01-01T00:00:00Z", file_records: int = FILE_RECORDS) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) into the folder ``path``, equal payloads once."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumns({"digest": F.sha2("html", 256), "bytes": F.octet_length("html")})
    # ids of revisits alone: found once, also where files are written in two goes
    marks = cut(revisits(rows.select("page_id", "digest", "bytes"), least))
    for of_class, records in _classes(rows.agg(F.max("bytes")).first()[0] or 0, file_records):
        marked = rows.filter(of_class).join(marks, ["page_id", "digest"], "left")
        _write(marked.select(record(*map(F.col, ("page_id", "url", "html", "digest", "bytes", "original")), date).alias("value")), path, records)


class _Stream:
    """Reads a gzip stream of one or more members, a bounded piece at a time, or plain bytes."""

    #: Bytes read and bytes unpacked at once.
    PIECE, MOST = 1 << 16, 1 << 20

    def __init__(self, raw: bytes):
        self.raw, self.at, self.buffer, self.start = raw, 0, bytearray(), 0
        self.packed = raw[:2] == b"\x1f\x8b"
        self.z = zlib.decompressobj(31)

    def fill(self) -> bool:
        """More of the stream in the buffer, MOST bytes at most; whether there was any."""
        if not self.packed:
            del self.buffer[: self.start]
            self.start, more = 0, self.raw[self.at : self.at + self.MOST]
            self.at += len(more)
            self.buffer += more
            return bool(more)
        if self.z.eof:
            rest = self.z.unused_data or self.raw[self.at : self.at + self.PIECE]
            self.at += 0 if self.z.unused_data else len(rest)
            if not rest.strip(b"\0"):
                return False
            self.z = zlib.decompressobj(31)
        else:
            rest = self.z.unconsumed_tail
            if not rest:
                rest = self.raw[self.at : self.at + self.PIECE]
                self.at += len(rest)
        del self.buffer[: self.start]
        self.start = 0
        before = len(self.buffer)
        self.buffer += self.z.decompress(rest, self.MOST)
        return bool(rest) or len(self.buffer) > before

    def head(self) -> bytes | None:
        seen = self.start
        while (end := self.buffer.find(b"\r\n\r\n", seen)) < 0:
            held = len(self.buffer) - self.start
            if not self.fill():
                if self.buffer[self.start :].strip() or (self.packed and not self.z.eof):
                    raise ValueError("the archive ends inside a header")
                return None
            seen = max(0, held - 3)
        got, self.start = bytes(self.buffer[self.start : end]), end + 4
        return got

    def take(self, n: int) -> bytes:
        while len(self.buffer) - self.start < n:
            if not self.fill():
                raise ValueError("the archive ends inside a record")
        got, self.start = bytes(self.buffer[self.start : self.start + n]), self.start + n
        return got


def _fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split(CRLF)[1:])}


_OWN = re.compile(r"<?urn:page:(-?\d+)>?")


def _page(name: str | None) -> int | None:
    """The page id of a record id that :func:`record` gave; null for any other."""
    found = _OWN.fullmatch(name or "")
    return int(found[1]) if found else None


def parse_archive(raw: bytes) -> Iterator[dict]:
    """The records of one archive, of any writer and type. A revisit's digest and length come from its own headers; others' from their payload.

    The payload of an HTTP message is its body, of any other record (a warcinfo, say) the whole block.
    """
    stream = _Stream(raw)
    while (head := stream.head()) is not None:
        fields = _fields(head)
        block = stream.take(int(fields["content-length"]))
        stream.take(4)
        http, payload = b"", block
        if fields.get("content-type", "").startswith("application/http") and fields.get("warc-type") in ("response", "revisit"):
            http, _, payload = block.partition(b"\r\n\r\n")
        again, length = fields.get("warc-type") == "revisit", _fields(http).get("content-length", "")
        digest = fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
        yield {
            "page_id": _page(fields.get("warc-record-id")),
            "url": fields.get("warc-target-uri"),
            "record_type": fields.get("warc-type"),
            "payload_bytes": (int(length) if length.isdigit() else None) if again else len(payload),
            "payload_digest": digest if again else hashlib.sha256(payload).hexdigest(),
            "refers_to": _page(fields.get("warc-refers-to")) if again else None,
            "record_id": fields.get("warc-record-id"),
            "stated": fields.get("warc-payload-digest"),
            "refers_id": fields.get("warc-refers-to"),
            "date": fields.get("warc-date"),
            "kind": fields.get("content-type"),
            "head": head,
            "http": http if fields.get("warc-type") in ("response", "revisit") else b"",
            "payload": block if again else payload,
        }


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """One row per record of the archives in ``path``; with ``payloads`` also heads and payload bytes (of a revisit: its block)."""
    schema = f"{_RECORD}, {_WHOLE}" if payloads else _RECORD

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in schema.split(", ")]
        for files in batches:
            for raw in files["content"]:
                block, held = [], 0
                for r in parse_archive(raw):
                    block.append([r[n] for n in names])
                    held += len(r["payload"] or b"") if payloads else 200
                    if held > 1 << 24:
                        yield _frame(block, names)
                        block, held = [], 0
                if block:
                    yield _frame(block, names)

    def _frame(block: list, names: list) -> pd.DataFrame:
        out = pd.DataFrame(block, columns=names)
        return out.astype({n: "Int64" for n in ("page_id", "payload_bytes", "refers_to")})

    # archives in folders, too; what is no archive is none of ours
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).filter(F.col("length") > 0).select("content")
    return files.mapInPandas(run, schema)


def resolve(records: DataFrame) -> DataFrame:
    """Records with each revisit joined, by payload digest, to its original response; other types as they are."""
    first = records.filter("record_type = 'response'").groupBy("payload_digest").agg(F.min("page_id").alias("original"), F.max("payload_bytes").alias("original_bytes"))
    joined = records.filter("record_type = 'revisit'").join(first, "payload_digest", "left")
    again = joined.withColumns({"refers_to": F.coalesce("original", "refers_to"), "payload_bytes": F.coalesce("original_bytes", "payload_bytes")}).drop("original", "original_bytes")
    return records.filter("record_type IS DISTINCT FROM 'revisit'").unionByName(again)


def _fresh(again: Column) -> Column:
    """A response or revisit of ``rid, date, url, digest, original, kind, http, body`` with fresh WARC headers and its own HTTP head."""
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{CRLF}{name}: "), value), F.lit(""))
    http = F.when(F.col("http") != "", F.concat("http", F.lit(CRLF * 2))).otherwise(F.lit(""))
    block = F.concat(http, F.when(again, F.lit("")).otherwise(F.col("body")))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(again, F.lit("revisit")).otherwise(F.lit("response")), line("WARC-Record-ID", F.col("rid")), line("WARC-Date", F.col("date")), line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")), F.when(again, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", F.col("original")))).otherwise(F.lit("")),
        line("Content-Type", F.col("kind")), line("Content-Length", F.octet_length(block).cast("string")), F.lit(CRLF * 2), block,
    )


def deduplicate_archives(spark: SparkSession, source: str, target: str, least: int = LEAST) -> None:
    """Read the archives of ``source`` and write them to ``target`` with equal payloads once and fresh headers.

    A revisit gets its payload back first: from the response of its digest (computed, or as both state it), or else from
    that of the record id it refers to. Of equal payloads of at least ``least`` bytes the record of smallest page id is the response,
    the smallest record id where no page id is; all others become its revisits. Revisits that find no response, and
    records of other types, are written as they are, byte for byte. Only sizes, digests and ids are shuffled to find
    the groups; a payload moves to the revisits of its digest that need it, and once to be written.
    """
    # bytes become strings as they are: neither Spark's strings nor its text sink look inside
    records = cut(read_archives(spark, source, payloads=True).withColumn("key", F.monotonically_increasing_id()))
    rank = F.struct(F.col("page_id").isNull().alias("foreign"), "page_id", F.coalesce("record_id", F.lit("")).alias("rid"))
    full = records.filter("record_type = 'response'")
    ways = F.array(*(F.struct(F.lit(k).alias("way"), F.col(c).alias("name")) for k, c in enumerate(("payload_digest", "stated", "record_id"))))
    named = full.select(F.explode(ways).alias("w"), "payload_digest", rank.alias("rank")).filter("w.name IS NOT NULL").groupBy("w.way", "w.name").agg(F.min(F.struct("rank", "payload_digest")).alias("m"))
    named = named.select("way", "name", F.col("m.payload_digest").alias("found"))
    again = records.filter("record_type = 'revisit'")
    asked = again.select("key", F.explode(F.array(*(F.struct(F.lit(k).alias("way"), F.col(c).alias("name")) for k, c in enumerate(("payload_digest", "stated", "refers_id"))))).alias("w"))
    # of the ways that lead to a response the first counts
    found = asked.select("key", "w.*").join(named, ["way", "name"]).groupBy("key").agg(F.min(F.struct("way", "found")).alias("m")).select("key", F.col("m.found").alias("digest"))
    found = cut(found)
    bodies = full.join(found.select(F.col("digest").alias("payload_digest")).distinct(), "payload_digest", "left_semi").groupBy(F.col("payload_digest").alias("digest")).agg(F.min_by("payload", "key").alias("body"))
    back = again.join(found, "key").join(bodies, "digest")
    columns = ["key", "page_id", "record_id", "date", "url", "kind", "http"]
    whole = cut(full.select(*columns, F.col("payload_digest").alias("digest"), F.col("payload").alias("body")).unionByName(back.select(*columns, "digest", "body")))
    sized = whole.withColumn("bytes", F.octet_length("body"))
    groups = sized.filter(F.col("bytes") >= least).groupBy("digest").agg(F.min(F.struct(rank.alias("rank"), F.col("record_id").alias("original"))).alias("m"), F.count("*").alias("n")).filter("n > 1").select("digest", "m.original")
    small = sized.select("key", "digest", "record_id", "bytes").filter(F.col("bytes") >= least).join(groups, "digest").filter(~F.col("record_id").eqNullSafe(F.col("original"))).select("key", "original")
    small = cut(small)
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("http", "body")}
    repeated = F.col("original").isNotNull()
    others = records.filter("record_type IS NULL OR record_type NOT IN ('response', 'revisit')").unionByName(again.join(found, "key", "left_anti")).withColumn("bytes", F.octet_length("payload"))
    as_they_are = F.concat(F.col("head").cast("string"), F.lit(CRLF * 2), F.col("payload").cast("string"))
    for of_class, n in _classes(records.agg(F.max(F.octet_length("payload"))).first()[0] or 0):
        marked = sized.filter(of_class).join(small, "key", "left").withColumn("rid", F.col("record_id")).withColumns(text)
        _write(marked.select(_fresh(repeated).alias("value")).unionByName(others.filter(of_class).select(as_they_are.alias("value"))), target, n)


def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    atexit.register(_forget, spark, path)
    # headers only: each archive is parsed once, however often its headers are used
    return resolve(cut(read_archives(spark, path))).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _forget(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:
        drop_path(spark, path)


QUERIES = {"op9_warc_revisits": op9_warc_revisits}
SQL = {
    "op9_warc_revisits": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS n, sha256(html) AS digest FROM p),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) END AS original FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN original <> page_id THEN original END AS refers_to
FROM f"""
}
