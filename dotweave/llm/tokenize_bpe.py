"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Texts longer than ``SEGMENT`` characters are first cut where the split pattern
must begin a new match anyway: before a single space that stands between two
non-space characters. No match of the pattern runs across such a point and no
look-ahead reaches it, so the ids equal those of the uncut text, while each call
of the library stays small.

A part that still holds a long run of one kind (white space, letters, digits, other)
has no such place. Its matches are then found one by one with the ``regex`` module,
whose backtracking needs no stack; a match of more than ``MATCH`` bytes is merged here
(:func:`merge_pairs`), in time close to linear, since the library's own merge of one
match is quadratic and its pattern overflows the stack on white space.

Decoding works on raw bytes: a token may end inside a character, so only the
joined bytes are a text again.

Defined cases: null or empty text gives no ids; special-token strings in a text
are ordinary text; further columns pass through (a clashing output name is
replaced); repeated rows each give a row; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small, table

#: Characters above which a text is cut at safe boundaries.
SEGMENT = 16_384
#: Characters of a run of one kind, and bytes of a match, above which the library does not see them.
RUN, MATCH = 8_192, 8_192
_SAFE = re.compile(r"(?<=\S) (?=\S)")
_LONG = regex.compile(rf"\s{{{RUN}}}|\p{{L}}{{{RUN}}}|\p{{N}}{{{RUN}}}|[^\s\p{{L}}\p{{N}}]{{{RUN}}}")
_ENCODERS: dict[tuple[str, str], object] = {}
_PARTS: dict[int, tuple[dict[bytes, int], list[int], object]] = {}


def encoder(rank_file: str, pattern: str):
    """The encoding of a rank file (base64 token, rank per line), kept per worker process."""
    key = (rank_file, pattern)
    if key not in _ENCODERS:
        import tiktoken

        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        _ENCODERS[key] = enc = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        _PARTS[id(enc)] = ranks, [ranks[bytes([b])] for b in range(256)], regex.compile(pattern)
    return _ENCODERS[key]


def merge_pairs(ranks: dict[bytes, int], single: list[int], match: bytes) -> list[int]:
    """Ids of one match by pair merging: always the pair of lowest rank, the leftmost of equal ones.

    While one pair makes up a good part of the match (runs of one character), all its places are merged at once:
    left to right, and only if no merge can give a pair of a rank as low, which would have had to come first. What is
    left goes through a heap of pairs over a linked list.
    """
    if match in ranks:
        return [ranks[match]]
    names = {rank: token for token, rank in ranks.items()}
    ids = np.asarray(single, np.int64)[np.frombuffer(match, np.uint8)]
    while len(ids) > 4_096:
        pairs, of = np.unique(ids[:-1] << 32 | ids[1:], return_inverse=True)
        rank = np.array([ranks.get(names[p >> 32] + names[p & 0xFFFFFFFF], 1 << 40) for p in pairs.tolist()])
        best = int(rank.min())
        at = np.flatnonzero(of == rank.argmin())
        if best == 1 << 40 or (rank == best).sum() > 1 or len(at) * 64 < len(ids):
            break
        # of places in a row that overlap, every second one from the left is merged
        head = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        at = at[(at - at[head[np.cumsum(np.diff(at, prepend=-2) != 1) - 1]]) % 2 == 0]
        gone = np.ones(len(ids), bool)
        gone[at + 1] = False
        merged = ids.copy()
        merged[at] = best
        merged = merged[gone]
        new = np.unique(merged[:-1] << 32 | merged[1:])
        new = [p for p in new.tolist() if best in (p >> 32, p & 0xFFFFFFFF)]
        if any(ranks.get(names[p >> 32] + names[p & 0xFFFFFFFF], 1 << 40) <= best for p in new):
            break
        ids = merged
    return _merge_by_heap(ranks, [names[i] for i in ids.tolist()])


def _merge_by_heap(ranks: dict[bytes, int], tokens: list[bytes | None]) -> list[int]:
    n = len(tokens)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(tokens, tokens[1:])) if (r := ranks.get(a + b)) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        # a pair that an earlier merge has changed is no longer there
        if j >= n or tokens[i] != a or tokens[j] != b:
            continue
        tokens[i], tokens[j], after[i] = a + b, None, after[j]
        if after[i] < n:
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] < n and (r := ranks.get(tokens[k] + tokens[after[k]])) is not None:
                heapq.heappush(heap, (r, k, tokens[k], tokens[after[k]]))
    return [ranks[t] for t in tokens if t is not None]


def _match_ids(enc, part: str) -> Iterator[list[int]]:
    """Ids of a part match by match, for parts with long runs."""
    ranks, single, pattern = _PARTS[id(enc)]
    for found in pattern.finditer(part):
        match = found.group()
        raw = match.encode() if len(match) * 4 > MATCH else b""
        yield merge_pairs(ranks, single, raw) if len(raw) > MATCH else enc.encode_ordinary(match)


def segments(text: str, size: int = SEGMENT) -> list[str]:
    """Consecutive parts of ``text``, cut only at safe boundaries, of ``size`` or the least more that such a boundary allows."""
    if len(text) <= size:
        return [text]
    parts, start = [], 0
    while len(text) - start > size and (at := _SAFE.search(text, start + size)):
        parts.append(text[start : at.start()])
        start = at.start()
    return [*parts, text[start:]]


def encode(enc, text: str | None) -> list[int]:
    ids: list[int] = []
    for part in segments(text or ""):
        if len(part) >= RUN and _LONG.search(part):
            for some in _match_ids(enc, part):
                ids += some
        else:
            ids += enc.encode_ordinary(part)
    return ids


def encode_array(enc, text: str | None) -> np.ndarray:
    """As :func:`encode`, four bytes an id."""
    made = []
    for part in segments(text or ""):
        if len(part) >= RUN and _LONG.search(part):
            made += [np.asarray(some, np.int32) for some in _match_ids(enc, part)]
        else:
            made.append(np.asarray(enc.encode_to_numpy(part, disallowed_special=()), np.int32))
    return np.concatenate(made)


def with_tokens(df: DataFrame, rank_file: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with ``out``, the array of token ids of ``text``."""
    keep = [c for c in df.columns if c.lower() != out.lower()]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(out, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(rank_file, pattern)
        for batch in small(batches, 500):
            made = [encode_array(enc, t.as_py()) for t in batch.column(text)]
            offsets = np.cumsum([0, *map(len, made)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(made)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), ids], [*keep, out])

    return df.mapInArrow(run, schema)


def with_text_bytes(df: DataFrame, rank_file: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out``, the raw bytes that ``ids`` stand for."""
    keep = [c for c in df.columns if c.lower() != out.lower()]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(out, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(rank_file, pattern)
        for batch in batches:
            raw = [enc.decode_bytes(i or []) for i in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(raw, pa.binary())], [*keep, out])

    return df.mapInArrow(run, schema)


def token_digests(df: DataFrame, rank_file: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` without ``text``, with ``n_tokens, ids_sha256, decoded_sha256`` of each whole text.

    One pass over the rows: the ids of a text are encoded, decoded and digested in its worker.
    """
    added = ["n_tokens", "ids_sha256", "decoded_sha256"]
    keep = [c for c in df.columns if c.lower() not in {text.lower(), *added}]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(added[0], T.LongType()), T.StructField(added[1], T.StringType()), T.StructField(added[2], T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(rank_file, pattern)
        decimal = [b"%d " % i for i in range(enc.max_token_value + 1)]
        for batch in batches:
            counts, ids_hex, text_hex = [], [], []
            for value in batch.column(text):
                ids = encode(enc, value.as_py())
                counts.append(len(ids))
                ids_hex.append(hashlib.sha256(b"".join(map(decimal.__getitem__, ids))[:-1]).hexdigest())
                text_hex.append(hashlib.sha256(enc.decode_bytes(ids)).hexdigest())
            new = [pa.array(counts, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *new], [*keep, *added])

    return df.mapInArrow(run, schema)


def public_ranks() -> tuple[str, str]:
    """Path and pattern of the public 50k byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents").select(F.col("doc_id"), F.col("text")), *public_ranks())


QUERIES = {"op5_byte_bpe": op5_byte_bpe}
SQL: dict[str, str] = {}
