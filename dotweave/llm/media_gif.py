"""GIF media columns: LZW code streams, palettes, disposal, transparency, timed frames, colour histograms.

:func:`frames` turns a binary column of GIF files into one row per frame: its
time, place, the composed canvas as RGB bytes and colour histograms. The decoder
handles global and local palettes, interlacing, transparent indices, the disposal
methods (leave, background, previous), code sizes 2 to 8 and code tables that stay
full. :func:`encode_samples` stores bytes losslessly as palette indices of a grey
GIF, in rows of 64 and frames of at most ``FRAME_ROWS`` rows.

Defined cases: null media has no frames; bytes that are no GIF, or end early, give
one row with null fields and the fault in ``error``, with the frames before it
kept; a canvas or frame of more than ``MOST_PIXELS`` pixels, or a code size outside 2
to 8, is such a fault before anything is allocated; null text counts as empty and is
stored as 64 zero bytes; equal texts give equal media, repeated rows each a row; very
long texts become many frames of one file; only the columns named are read, so further
ones of any name play no part; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import small, table

ROW, FRAME_ROWS = 64, 1_024
BINS = 16
#: Codes that fit into a code table.
FULL = 4_096
#: Pixels of a canvas or a frame at most: 200 MB as colours.
MOST_PIXELS = 1 << 26


@functools.cache
def _widths(low: int, count: int) -> np.ndarray:
    """Bits of each code after a clear code, for indices of ``low`` bits."""
    size = (1 << low) + 1 + np.arange(count)  # entries of the reader's table when it reads code i
    size[0] += 1
    return np.clip(np.floor(np.log2(np.maximum(size, 1))).astype(int) + 1, low + 1, 12)


def lzw_encode(data: bytes, low: int = 8) -> bytes:
    """The code stream of ``data``; the table is cleared whenever it is full."""
    clear = 1 << low
    codes = [clear]
    out, known, free = codes.append, {}, clear + 2
    get = known.get
    w = data[0] if data else -1
    for c in memoryview(data)[1:]:
        key = w << 8 | c
        found = get(key)
        if found is None:
            out(w)
            if free < FULL:
                known[key] = free
                free += 1
            else:
                out(clear)
                known = {}
                get, free = known.get, clear + 2
            w = c
        else:
            w = found
    if w >= 0:
        out(w)
    out(clear + 1)
    span = FULL - clear  # codes from one clear code to the next, that included
    width = np.concatenate([[low + 1], np.resize(_widths(low, span), len(codes) - 1)]).astype(np.uint8)
    ends = np.cumsum(width, dtype=np.int64)
    start = ends - width
    # a code of at most 12 bits at any bit reaches into three bytes; bits of different codes never meet, so sums are unions
    word = np.array(codes, np.uint32) << (start & 7).astype(np.uint32)
    size = int(ends[-1] + 7) // 8
    parts = [np.bincount((start >> 3) + k, (word >> np.uint32(8 * k)) & np.uint32(255), size) for k in range(3)]
    return (parts[0][:size] + parts[1][:size] + parts[2][:size]).astype(np.uint8).tobytes()


def lzw_decode(stream: bytes, low: int, most: int) -> bytes:
    """At most ``most`` indices of a code stream.

    Entry e of a table is the string of code e and the first index of code e + 1, so every code above the literals
    points at an earlier code. Chains of these pointers give all lengths and strings at once.
    """
    codes, first = _read_codes(stream, low)
    if not len(codes):
        return b""
    clear = 1 << low
    literal = codes < clear
    place = np.arange(len(codes))
    parent = np.where(literal, place, first + codes - (clear + 2))
    if (parent[~literal] >= place[~literal]).any() or (codes[~literal] < clear + 2).any():
        raise ValueError("a code that is not in the table yet")
    root, depth = parent, (~literal).astype(np.int64)
    while not literal[root].all():
        depth, root = depth + depth[root], root[root]
    head = codes[root]
    tail = np.where(literal, codes, head[np.minimum(parent + 1, place)]).astype(np.uint8)
    ends = np.cumsum(depth + 1)
    out = np.empty(int(ends[-1]), np.uint8)
    spot, at = ends - 1, place
    while len(at):
        out[spot] = tail[at]
        more = ~literal[at]
        spot, at = spot[more] - 1, parent[at[more]]
    return out[:most].tobytes()


def _read_codes(stream: bytes, low: int) -> tuple[np.ndarray, np.ndarray]:
    """The codes of a stream without clear and end codes, and for each the place of the first code of its table."""
    clear, end = 1 << low, (1 << low) + 1
    raw = np.frombuffer(stream + b"\0\0\0\0", np.uint8).astype(np.uint32)
    total, plan = len(stream) * 8, _widths(low, 2 * FULL)
    found: list[np.ndarray] = []
    firsts: list[np.ndarray] = []
    at, read, begun, done = 0, 0, 0, 0  # bits passed; codes since the last clear code; where its table begins; codes found
    while True:
        width = plan[min(read, FULL) : min(read, FULL) + FULL]
        ends = at + np.cumsum(width)
        some = int(np.searchsorted(ends, total, "right"))
        if not some:
            break
        begin = ends[:some] - width[:some]
        byte = begin >> 3
        word = raw[byte] | raw[byte + 1] << np.uint32(8) | raw[byte + 2] << np.uint32(16)
        codes = (word >> (begin & 7).astype(np.uint32)) & ((np.uint32(1) << width[:some].astype(np.uint32)) - np.uint32(1))
        stop = np.flatnonzero((codes == clear) | (codes == end))
        n = int(stop[0]) if len(stop) else some
        found.append(codes[:n].astype(np.int64))
        firsts.append(np.full(n, begun))
        done += n
        read += n
        if not len(stop):
            at = int(ends[some - 1])
            continue
        if codes[n] == end:
            break
        at, read, begun = int(ends[n]), 0, done
    return (np.concatenate(found), np.concatenate(firsts)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _blocks(data: bytes) -> bytes:
    return b"".join(bytes([len(part)]) + part for part in (data[i : i + 255] for i in range(0, len(data), 255))) + b"\0"


def encode_gif(frames: list[dict], width: int, height: int, palette: bytes, background: int = 0) -> bytes:
    """A GIF of frames: ``indices`` (bytes), ``left, top, width, height``, and optionally ``delay_ms, disposal, transparent, palette``."""
    out = [b"GIF89a", struct.pack("<HHBBB", width, height, 0xF0 | 7, background, 0), palette.ljust(768, b"\0")]
    for f in frames:
        clear = f.get("transparent")
        out.append(b"\x21\xf9\x04" + struct.pack("<BHB", (f.get("disposal", 0) << 2) | (clear is not None), f.get("delay_ms", 0) // 10, clear or 0) + b"\0")
        own = f.get("palette")
        out.append(b"," + struct.pack("<HHHHB", f.get("left", 0), f.get("top", 0), f["width"], f["height"], 0x87 if own else 0))
        out += [own.ljust(768, b"\0")] if own else []
        out += [b"\x08", _blocks(lzw_encode(f["indices"]))]
    return b"".join([*out, b";"])


def decode_gif(media: bytes) -> Iterator[dict]:
    """The frames of a GIF, each composed over those before it."""
    if media[:6] not in (b"GIF87a", b"GIF89a") or len(media) < 13:
        raise ValueError("not a GIF")
    width, height, flags, background, _ = struct.unpack("<HHBBB", media[6:13])
    if width * height > MOST_PIXELS:
        raise ValueError(f"a canvas of more than {MOST_PIXELS} pixels")
    at = 13
    shared = None
    if flags & 0x80:
        size = 3 << ((flags & 7) + 1)
        shared = np.frombuffer(media[at : at + size].ljust(768, b"\0"), np.uint8).reshape(-1, 3)
        at += size
    empty = shared[background] if shared is not None and background < len(shared) else np.zeros(3, np.uint8)
    canvas = np.empty((height, width, 3), np.uint8)
    canvas[:] = empty
    delay = disposal = 0
    clear = None
    time = index = 0

    def take() -> bytes:
        nonlocal at
        parts = []
        while at < len(media) and (n := media[at]):
            parts.append(media[at + 1 : at + 1 + n])
            at += 1 + n
        if at >= len(media):
            raise ValueError("the file ends inside a block")
        at += 1
        return b"".join(parts)

    while True:
        if at >= len(media):
            raise ValueError("the file ends without a trailer")
        kind = media[at]
        at += 1
        if kind == 0x3B:
            return
        if kind == 0x21:
            label = media[at] if at < len(media) else 0
            at += 1
            data = take()
            if label == 0xF9 and len(data) >= 4:
                packed, hundredths, lucid = struct.unpack("<BHB", data[:4])
                delay, disposal, clear = hundredths * 10, packed >> 2 & 7, lucid if packed & 1 else None
        elif kind == 0x2C and at + 10 <= len(media):
            left, top, w, h, flags = struct.unpack("<HHHHB", media[at : at + 9])
            at += 9
            palette = shared
            if flags & 0x80:
                size = 3 << ((flags & 7) + 1)
                palette = np.frombuffer(media[at : at + size].ljust(768, b"\0"), np.uint8).reshape(-1, 3)
                at += size
            if at >= len(media):
                raise ValueError("the file ends inside an image")
            low = media[at]
            at += 1
            if not 2 <= low <= 8:
                raise ValueError("a code size that no GIF has")
            if w * h > MOST_PIXELS:
                raise ValueError(f"a frame of more than {MOST_PIXELS} pixels")
            pixels = np.frombuffer(lzw_decode(take(), low, w * h), np.uint8)
            if len(pixels) < w * h:
                raise ValueError("the code stream ends early")
            pixels = pixels.reshape(h, w)
            if flags & 0x40:
                rows = np.concatenate([np.arange(a, h, b) for a, b in ((0, 8), (4, 8), (2, 4), (1, 2))])
                woven = np.empty_like(pixels)
                woven[rows] = pixels
                pixels = woven
            kept = canvas.copy() if disposal == 3 else None
            place = canvas[top : top + h, left : left + w]
            shown = pixels[: place.shape[0], : place.shape[1]]
            colours = (palette if palette is not None else np.repeat(np.arange(256, dtype=np.uint8)[:, None], 3, 1))[shown]
            place[:] = colours if clear is None else np.where((shown == clear)[..., None], place, colours)
            yield {"frame": index, "time_ms": time, "delay_ms": delay, "left": left, "top": top, "width": w, "height": h, "canvas": canvas.copy()}
            time, index = time + delay, index + 1
            if disposal == 2:
                place[:] = empty
            elif kept is not None:
                canvas = kept
            delay = disposal = 0
            clear = None
        else:
            raise ValueError("an unknown block")


def histogram(channel: np.ndarray) -> np.ndarray:
    return np.bincount(channel.ravel() >> 4, minlength=BINS)


FRAME = (
    "frame int, time_ms long, delay_ms int, left int, top int, width int, height int, canvas_width int, canvas_height int, "
    "rgb binary, hist_r array<long>, hist_g array<long>, hist_b array<long>, error string"
)


def frames(df: DataFrame, key: str, media: str) -> DataFrame:
    """One row per frame of the GIF files in ``media``, with ``key``."""
    names = [key, *(x.split()[0] for x in FRAME.split(", "))]
    key_type = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, value in zip(batch.column(key), batch.column(media)):
                if not value.is_valid:
                    continue
                read, row = decode_gif(value.as_py()), None
                while True:
                    try:
                        f = next(read, None)
                        if f is None:
                            break
                        canvas = f.pop("canvas")
                        hists = [histogram(canvas[..., c]).tolist() for c in range(3)]
                        row = [*f.values(), canvas.shape[1], canvas.shape[0], canvas.tobytes(), *hists, None]
                        over = False
                    except (ValueError, struct.error, IndexError, OverflowError) as fault:
                        row, over = [None] * (len(names) - 2) + [str(fault)], True
                    kinds = [batch.schema.field(key).type, *([pa.int32(), pa.int64()] + [pa.int32()] * 7), pa.binary(), *[pa.list_(pa.int64())] * 3, pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip([k.as_py(), *row], kinds)], names)
                    if over:
                        break

    return df.select(key, media).mapInArrow(run, f"`{key}` {key_type}, {FRAME}")


_GREY = np.repeat(np.arange(256, dtype=np.uint8), 3).tobytes()


def encode_samples(payload: bytes) -> bytes:
    """``payload``, whose length is a multiple of ROW, as the indices of a grey GIF."""
    step = ROW * FRAME_ROWS
    parts = [payload[i : i + step] for i in range(0, len(payload), step)]
    shown = [{"indices": p, "width": ROW, "height": len(p) // ROW, "delay_ms": 40, "disposal": 1} for p in parts]
    return encode_gif(shown, ROW, max(f["height"] for f in shown), _GREY)


def decode_samples(media: bytes) -> tuple[bytes, np.ndarray]:
    """The payload of :func:`encode_samples`, read from the composed frames, and its colour histogram."""
    parts, total = [], np.zeros(BINS, np.int64)
    for f in decode_gif(media):
        shown = f["canvas"][f["top"] : f["top"] + f["height"], f["left"] : f["left"] + f["width"], 0]
        parts.append(shown.tobytes())
        total += histogram(shown)
    return b"".join(parts), total


def with_media(df: DataFrame, key: str, text: str, out: str = "media") -> DataFrame:
    """``key``, ``n_bytes`` and ``out``: each text, as UTF-8 filled up with zeros to whole rows, as a GIF."""
    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, n_bytes long, `{out}` binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 200):
            raw = [(value.as_py() or "").encode() for value in batch.column(text)]
            media = [encode_samples(r.ljust(max(ROW, -(-len(r) // ROW) * ROW), b"\0")) for r in raw]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(map(len, raw), pa.int64()), pa.array(media, pa.binary())], [key, "n_bytes", out])

    return df.select(key, text).mapInArrow(run, schema)


def read_samples(df: DataFrame, key: str, media: str = "media") -> DataFrame:
    """``key``, ``n_bytes`` and what the stored bytes of ``media`` say: the payload read back from them, digests, and a colour histogram."""
    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    names = [key, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(media):
                stored = value.as_py()
                payload, hist = decode_samples(stored)
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), ",".join(map(str, hist))))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("n_bytes"), *(pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 6, kinds))], names)

    return df.mapInArrow(run, schema)


def op7_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_samples(with_media(table(spark, sf_dir, "documents"), "doc_id", "text"), "doc_id")


QUERIES = {"op7_gif_media": op7_gif_media}
SQL: dict[str, str] = {}
