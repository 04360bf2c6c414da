"""Chunked arrays (a directory store with consolidated metadata) as a Spark data source, ``array_chunks``.

A store is a folder that all executors mount: a group per image with its attributes (``.zattrs``), in it one array (``.zarray``
and a file a chunk), and ``.zmetadata`` with all of that in one file. A row is a chunk; a partition of a read is a chunk.

Reading looks at ``.zmetadata`` alone to list chunks. Filters on the attributes in ``KEYS`` and on ``chunk`` are pushed to that
list (equality, IN and comparisons; with ``spark.sql.python.filterPushdown.enabled``), so chunks of other images are no
partitions. Without ``pixels`` in the schema asked for, no chunk is opened.

Writing: tasks write chunks under temporary names and rename them, so a repeated task leaves the same store; the driver writes
metadata when all are there, one entry an image. ``append`` keeps the images that are not written again.

Chunks are plain or zlib-packed, in C order; absent chunks (all fill value) are zeros.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq, ge, gt, le, lt

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import StructType

#: Attributes of an image that are columns and can be filtered on.
KEYS = ("grp_name", "fov_num", "channel", "round_num")
SCHEMA = "grp_name string, fov_num int, channel string, round_num int, chunk string, origin array<int>, shape array<int>, dtype string, pixels binary"
ARRAY = "pixels"
#: Pixels that are made rows at once.
PIXELS = 100_000
_COMPARED = {EqualTo: eq, GreaterThan: gt, GreaterThanOrEqual: ge, LessThan: lt, LessThanOrEqual: le}


@dataclass
class Chunk(InputPartition):
    values: dict
    path: str


@dataclass
class Written(WriterCommitMessage):
    images: dict


def _metadata(path: str) -> dict:
    name = os.path.join(path, ".zmetadata")
    if not os.path.exists(name):
        return {}
    with open(name) as f:
        return json.load(f)["metadata"]


def _put(path: str, raw: bytes) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    held = f"{path}.{uuid.uuid4().hex}.tmp"
    with open(held, "wb") as f:
        f.write(raw)
    os.replace(held, path)


class ChunkReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.names, self.tests = path, schema.fieldNames(), []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in (*KEYS, "chunk") and type(f) in _COMPARED:
                self.tests.append((column, _COMPARED[type(f)], f.value))
            elif column in (*KEYS, "chunk") and isinstance(f, In):
                self.tests.append((column, lambda x, some: x in some, tuple(f.value)))
            else:
                yield f

    def _fits(self, values: dict) -> bool:
        return all(values[column] is not None and test(values[column], value) for column, test, value in self.tests if column in values)

    def partitions(self) -> list[Chunk]:
        metadata, found = _metadata(self.path), []
        for name, array in metadata.items():
            if not name.endswith(f"/{ARRAY}/.zarray"):
                continue
            group = name.removesuffix(f"/{ARRAY}/.zarray")
            attrs = {"grp_name": group, **metadata.get(f"{group}/.zattrs", {})}
            image = {k: attrs.get(k) for k in KEYS}
            if not self._fits(image):
                continue
            kind = {"dtype": array["dtype"], "packed": bool(array.get("compressor"))}
            for at in np.ndindex(*(-(-n // c) for n, c in zip(array["shape"], array["chunks"]))):
                values = {**image, "chunk": ".".join(map(str, at))}
                if self._fits({"chunk": values["chunk"]}):
                    # a chunk at the end is stored whole, and cut to the array when read
                    origin = [i * c for i, c in zip(at, array["chunks"])]
                    shape = [min(c, n - o) for c, n, o in zip(array["chunks"], array["shape"], origin)]
                    found.append(Chunk({**values, **kind, "origin": origin, "shape": shape, "stored": list(array["chunks"])}, os.path.join(self.path, group, ARRAY, values["chunk"])))
        return found or [Chunk({}, "")]

    def read(self, partition: Chunk) -> Iterator[tuple]:
        v = partition.values
        if not v:
            return
        row = {**{k: v[k] for k in KEYS}, "chunk": v["chunk"], "origin": v["origin"], "shape": v["shape"], "dtype": np.dtype(v["dtype"]).name}
        if "pixels" in self.names:
            if os.path.exists(partition.path):
                with open(partition.path, "rb") as f:
                    raw = f.read()
                whole = np.frombuffer(zlib.decompress(raw) if v["packed"] else raw, v["dtype"]).reshape(v["stored"])
                row["pixels"] = np.ascontiguousarray(whole[tuple(slice(n) for n in v["shape"])]).tobytes()
            else:
                row["pixels"] = np.zeros(v["shape"], v["dtype"]).tobytes()
        yield tuple(row.get(n) for n in self.names)


class ChunkWriter(DataSourceWriter):
    """Rows are images: ``KEYS`` (grp_name may be null), shape, dtype and pixels; they are cut into chunks of the option ``chunks``.

    With the columns ``origin`` and ``whole`` rows are pieces of an image of shape ``whole``; each begins at a chunk and ends at
    one or at the image's end. A chunk of no piece stays absent.
    """

    def __init__(self, path: str, schema: StructType, chunks: list[int], packed: bool, overwrite: bool):
        self.path, self.names, self.chunks, self.packed, self.overwrite = path, schema.fieldNames(), chunks, packed, overwrite

    def write(self, iterator: Iterator[Row]) -> Written:
        images = {}
        for r in iterator:
            row = dict(zip(self.names, r))
            image = np.frombuffer(row["pixels"], row["dtype"]).reshape(row["shape"])
            group = row.get("grp_name") or f"{row['fov_num']}_{row['channel']}_{row['round_num']}"
            whole, origin = row.get("whole") or list(image.shape), row.get("origin") or [0] * image.ndim
            size = [min(n, c) if c else n for n, c in zip(whole, (self.chunks + [0] * image.ndim)[: image.ndim])]
            if any(o % c or (n % c and o + n != w) for o, n, c, w in zip(origin, image.shape, size, whole)):
                raise ValueError(f"the piece of {group} at {origin} is cut between chunks")
            for at in np.ndindex(*(-(-n // c) for n, c in zip(image.shape, size))):
                part = image[tuple(slice(i * c, (i + 1) * c) for i, c in zip(at, size))]
                full = np.zeros(size, image.dtype)
                full[tuple(slice(n) for n in part.shape)] = part
                raw = full.tobytes()
                name = ".".join(str(o // c + i) for o, c, i in zip(origin, size, at))
                _put(os.path.join(self.path, group, ARRAY, name), zlib.compress(raw, 1) if self.packed else raw)
            array = {"zarr_format": 2, "shape": list(whole), "chunks": size, "dtype": image.dtype.str, "fill_value": 0, "order": "C", "filters": None, "compressor": {"id": "zlib", "level": 1} if self.packed else None}
            images[group] = ({k: row.get(k) for k in KEYS if k != "grp_name"}, array)
        return Written(images)

    def commit(self, messages: list[Written | None]) -> None:
        metadata = {} if self.overwrite else _metadata(self.path)
        metadata[".zgroup"] = {"zarr_format": 2}
        # pieces of an image name it once each
        images = {group: found for m in messages if m for group, found in m.images.items()}
        for group, (attrs, array) in images.items():
            for name, body in ((f"{group}/.zgroup", {"zarr_format": 2}), (f"{group}/.zattrs", attrs), (f"{group}/{ARRAY}/.zarray", array)):
                metadata[name] = body
                _put(os.path.join(self.path, name), json.dumps(body).encode())
        _put(os.path.join(self.path, ".zmetadata"), json.dumps({"zarr_consolidated_format": 1, "metadata": metadata}).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Chunks without metadata belong to no image; the next write replaces them."""


class ArrayChunks(DataSource):
    """Options: ``path``; for writing ``chunks`` (sizes of the axes, comma-separated, 0 for whole; default ``1``) and ``packed`` (default true)."""

    @classmethod
    def name(cls) -> str:
        return "array_chunks"

    def schema(self) -> str:
        return SCHEMA

    def _path(self) -> str:
        return self.options["path"].removeprefix("file://")

    def reader(self, schema: StructType) -> ChunkReader:
        return ChunkReader(self._path(), schema)

    def writer(self, schema: StructType, overwrite: bool) -> ChunkWriter:
        chunks = [int(x) for x in self.options.get("chunks", "1").split(",")]
        return ChunkWriter(self._path(), schema, chunks, self.options.get("packed", "true").lower() == "true", overwrite)


def register(spark: SparkSession) -> None:
    """Make ``array_chunks`` known to a session, with filters pushed to the list of chunks."""
    spark.dataSource.register(ArrayChunks)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    register(spark)
    return spark.read.format("array_chunks").schema(schema).load(path)


def write(images: DataFrame, path: str, chunks: str = "1", packed: bool = True, mode: str = "overwrite") -> None:
    """Write images (fov_num, channel, round_num, shape, dtype, pixels; grp_name if there is one) or pieces of images (with origin, whole) as chunked arrays."""
    register(images.sparkSession)
    images.write.format("array_chunks").option("chunks", chunks).option("packed", str(packed).lower()).mode(mode).save(path)


def sparse(chunks: DataFrame) -> DataFrame:
    """grp_name, fov_num, channel, round_num, at (place in the array), value of the non-zero pixels."""
    schema = "grp_name string, fov_num int, channel string, round_num int, at array<int>, value double"

    def run(batches):
        import pandas as pd

        for rows in batches:
            for row in rows.itertuples(index=False):
                image = np.frombuffer(row.pixels, row.dtype).reshape(tuple(row.shape))
                lit = np.flatnonzero(image)
                # a row of its own for each pixel takes much more than the chunk
                for part in np.split(lit, range(PIXELS, len(lit), PIXELS)) if len(lit) else ():
                    at = np.stack(np.unravel_index(part, image.shape), axis=1)
                    yield pd.DataFrame({"grp_name": row.grp_name, "fov_num": row.fov_num, "channel": row.channel, "round_num": row.round_num, "at": list((at + np.asarray(row.origin)).astype("int32")), "value": image.ravel()[part].astype(float)})

    return chunks.select("grp_name", "fov_num", "channel", "round_num", "origin", "shape", "dtype", "pixels").mapInPandas(run, schema)
