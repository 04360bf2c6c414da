"""Barcodes from matched dots, decoding against a codebook, per-bit intensities."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.codes import flips, positive_bits
from ..functions.lineage import cut
from .graphs import components
from .spatial import nearest_within

LENGTH = 16
#: Bits of a code at most: a long holds no more.
MOST_BITS = 64
#: Dots of a tile or a cluster that one task decodes at most; beyond, rounds are joined.
MOST_DOTS = 50_000
#: Side of a tile of dots, in radii.
TILE = 128
#: Dots of the tiles that are decoded at once, about: a tile alone has too few to be worth a call.
RUN_DOTS = 20_000


def barcode_bits(matches: DataFrame, reference: str, round_num: str = "round_num") -> DataFrame:
    """``reference`` and its code: bit k - 1 is set if a dot of round k belongs to it."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col(round_num).cast("int") - 1)
    return matches.groupBy(reference).agg(F.bit_or(bit).alias("code_bits"))


def _chunked(bits: Column, length: int, parts: int) -> list[Column]:
    """A code's chunks, the lowest bits first."""
    ends = [length * i // parts for i in range(parts + 1)]
    return [F.shiftrightunsigned(bits, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1).cast("long")) for lo, hi in zip(ends, ends[1:])]


def _masks(width: int, weight: int) -> list[int]:
    return [sum(1 << i for i in at) for at in combinations(range(width), weight)]


def nearest_codeword(codes: DataFrame, codebook: DataFrame, length: int = LENGTH, bits: str = "code_bits") -> DataFrame:
    """Gene, distance (a share of bits) and positive bits for each row; ties go to the codebook's order.

    Distinct codes search a multi-index of the codebook (gene, code_bits, code_idx). Codes are cut into m chunks, each an
    exact-match index of the codewords: a codeword at distance d has a chunk that differs in d // m bits at most. So ring t
    looks up, in every chunk, the values that differ in t bits; after it every codeword up to distance m (t + 1) - 1 has
    been met, and a code whose best is no farther is done. Only the others go on to ring t + 1, at the last of which each
    chunk has met all of its values. Chunks have about as many bits as the codebook's size, so a look-up meets few words.
    """
    if not 0 < length <= MOST_BITS:
        raise ValueError(f"codes of 1 to {MOST_BITS} bits")
    book = codebook.select(F.col("gene").alias("decoded_genes"), F.col("code_bits").alias("_book"), F.col("code_idx").alias("_idx"))
    parts = -(-length // max(4, min(16, book.count().bit_length())))
    width = -(-length // parts)
    key = lambda column: F.posexplode(F.array(*_chunked(column, length, parts)))
    index = book.select("*", key(F.col("_book")).alias("_part", "_value"))
    best = F.struct("_d", "_idx", "_book", "decoded_genes")
    left, done = cut(codes.select(bits).filter(F.col(bits).isNotNull()).distinct().withColumn("_best", F.lit(None).cast(_best_type(book)))), []
    for ring in range(width + 1):
        near = F.explode(F.lit(_masks(width, ring)))
        asked = left.select(bits, key(F.col(bits)).alias("_part", "_chunk")).select(bits, "_part", "_chunk", near.alias("_mask"))
        asked = asked.withColumn("_value", F.col("_chunk").bitwiseXOR(F.col("_mask").cast("long")))
        met = asked.join(index, ["_part", "_value"]).withColumn("_d", F.bit_count(F.col(bits).bitwiseXOR(F.col("_book"))))
        found = met.groupBy(bits).agg(F.min(best).alias("_new"))
        left = cut(left.join(found, bits, "left").select(bits, F.least("_best", "_new").alias("_best")))
        sure = F.coalesce(F.col("_best._d") <= parts * (ring + 1) - 1, F.lit(False)) if ring < width else F.lit(True)
        done.append(left.filter(sure))
        left = left.filter(~sure)
        if left.isEmpty():
            break
    named = reduce(lambda a, b: a.unionByName(b), done).filter(F.col("_best").isNotNull())
    named = named.select(bits, F.col("_best.decoded_genes").alias("decoded_genes"), (F.col("_best._d") / F.lit(length)).alias("hamming_distance"), F.col("_best._book").alias("codeword_bits"))
    return codes.join(named, bits).withColumn("number_positive_bits", positive_bits(F.col(bits)))


def _best_type(book: DataFrame) -> T.StructType:
    return T.StructType([T.StructField("_d", T.IntegerType()), *(book.schema[c] for c in ("_idx", "_book", "decoded_genes"))])


def flip_summary(decoded: DataFrame, length: int = LENGTH, bits: str = "code_bits") -> DataFrame:
    """How often each bit flips in each direction, over rows that are off by one or two bits."""
    off = decoded.filter((F.col("hamming_distance") > 0) & (F.col("hamming_distance") < 3 / length))
    each = off.select(F.explode(flips(F.col(bits), F.col("codeword_bits"), length)).alias("f"))
    return each.groupBy(F.col("f.position").alias("position"), F.col("f.direction").alias("direction")).agg(F.count("*").alias("n"))


def _pairs(one: np.ndarray, two: np.ndarray, radius: float, kind_one: np.ndarray, kind_two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of ``two`` and of ``one`` of equal kind within ``radius``, and their squared distance; they meet in grid cells."""
    side = radius if radius > 0 else 1.0
    cell, near = (np.floor(x / side).astype(np.int64) for x in (one, two))
    low = np.minimum(cell.min(axis=0), near.min(axis=0)) - 1
    high = np.maximum(cell.max(axis=0), near.max(axis=0)) + 2 - low
    number = lambda kind, x: (kind * high[0] + x[:, 0] - low[0]) * high[1] + x[:, 1] - low[1]
    order = np.argsort(number(kind_one, cell), kind="stable")
    places = number(kind_one, cell)[order]
    rows, refs = [], []
    for i in (-1, 0, 1):
        # the three cells of a row of cells are neighbours in the order
        first = number(kind_two, near + (i, -1))
        a, b = np.searchsorted(places, first, "left"), np.searchsorted(places, first + 2, "right")
        n = b - a
        rows.append(np.repeat(np.arange(len(two)), n))
        refs.append(order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - a, n)])
    row, at = np.concatenate(rows), np.concatenate(refs)
    d2 = ((one[at] - two[row]) ** 2).sum(axis=1)
    close = d2 <= radius * radius
    return row[close], at[close], d2[close]


def _nearest(ref: np.ndarray, other: np.ndarray, radius: float, kind_ref: np.ndarray, kind_other: np.ndarray) -> np.ndarray:
    """For each row of ``other`` the nearest row of ``ref`` of its kind within ``radius`` (the first of equals), or -1."""
    row, at, d2 = _pairs(ref, other, radius, kind_ref, kind_other)
    rank = np.lexsort((at, d2, row))
    row, at = row[rank], at[rank]
    head = np.concatenate([[True], row[1:] != row[:-1]]) if len(row) else np.zeros(0, bool)
    best = np.full(len(other), -1)
    best[row[head]] = at[head]
    return best


def _linked(rc: np.ndarray, radius: float, kind: np.ndarray) -> np.ndarray:
    """For each point the smallest number of a point of its kind that a chain of links within ``radius`` leads to."""
    one, two, _ = _pairs(rc, rc, radius, kind, kind)
    label = np.arange(len(rc))
    while True:
        new = label.copy()
        np.minimum.at(new, one, label[two])
        np.minimum.at(new, label[one], label[two])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _least(ids: np.ndarray, label: np.ndarray) -> np.ndarray:
    """For each row the smallest of ``ids`` among rows of its ``label``."""
    order = np.argsort(ids, kind="stable")
    _, first, group = np.unique(label[order], return_index=True, return_inverse=True)
    least = np.empty(len(ids), object)
    least[order] = ids[order[first]][group]
    return least


def sequence_owners(rounds: np.ndarray, rc: np.ndarray, kind: np.ndarray, radius: float, length: int) -> np.ndarray:
    """Sequential consumption, round after round: for each dot the row of the dot that took it, itself if none did, -1 beyond ``length``.

    The dots of round k that are left take the nearest dots within the radius of all other rounds, of their own kind;
    both leave the pool. Rows are in the order of ties.
    """
    left, owner = np.ones(len(rounds), bool), np.full(len(rounds), -1)
    for k in range(1, length + 1):
        ref, other = np.flatnonzero(left & (rounds == k)), np.flatnonzero(left & (rounds != k))
        if not len(ref):
            continue
        if len(other):
            hit = _nearest(rc[ref], rc[other], radius, kind[ref], kind[other])
            some = hit >= 0
            left[other[some]] = False
            owner[other[some]] = ref[hit[some]]
        left[ref] = False
        owner[ref] = ref
    return owner


_TILED = "kind int, dot_id string, round_num int, r double, c double, label string, own boolean"
_OWNED = "dot_id string, round_num int, r double, c double, barcode_reference_dot_id string"


def _whole_images(dots: DataFrame, by: tuple[str, ...], rc: tuple[str, str]) -> DataFrame:
    """``by``, dot_id (text), round_num, r, c of the images without a null coordinate: others have failed registration."""
    rows = dots.filter(F.col("dot_id").isNotNull()).select(
        *by, F.col("dot_id").cast("string").alias("dot_id"), F.col("round_num").cast("int").alias("round_num"), F.col(rc[0]).cast("double").alias("r"), F.col(rc[1]).cast("double").alias("c")
    )
    failed = rows.filter(F.col("r").isNull() | F.col("c").isNull()).select(*by).distinct()
    same = reduce(lambda x, y: x & y, [F.col(f"x.{b}").eqNullSafe(F.col(f"y.{b}")) for b in by])
    return rows.alias("x").join(failed.alias("y"), same, "left_anti")


def _keyed(dots: DataFrame, by: tuple[str, ...], schema: str) -> str:
    return ", ".join([*(f"`{b}` {dots.schema[b].dataType.simpleString()}" for b in by), schema])


def _in_order(group: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    group = group.sort_values(["round_num", "dot_id"], kind="stable").reset_index(drop=True)
    return group, group["round_num"].to_numpy(), group[["r", "c"]].to_numpy(float)


def _decoded_tiles(rows: DataFrame, radius: float, length: int, by: tuple[str, ...]) -> DataFrame:
    """Kind 0: dots of clusters inside one tile, their owner as label. Kind 1: dots of other clusters, labelled by their smallest dot in the tile and its margin."""
    side = float(TILE * radius) if radius > 0 else float(TILE)
    span = lambda x: F.explode(F.sequence(F.floor((F.col(x) - radius) / side), F.floor((F.col(x) + radius) / side)))
    own = (F.floor(F.col("r") / side) == F.col("_tr")) & (F.floor(F.col("c") / side) == F.col("_tc"))
    tiled = rows.withColumn("_tr", span("r")).withColumn("_tc", span("c")).withColumn("own", own)
    # a run holds many tiles, each a kind of its own
    runs = max(1, rows.count() // RUN_DOTS)
    tiled = tiled.withColumn("_run", F.pmod(F.xxhash64(*by, "_tr", "_tc"), F.lit(runs)))
    names = [x.split()[0] for x in _TILED.split(", ")]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group, rounds, rc = _in_order(group)
        own = group["own"].to_numpy(bool)
        tile = group.groupby([*by, "_tr", "_tc"], dropna=False, sort=False).ngroup().to_numpy(np.int64)
        label = _linked(rc, radius, tile)
        crossing = np.isin(label, label[~own])
        inside = ~crossing
        ids = group["dot_id"].to_numpy(object)
        # the smallest dot of each cluster names it: the same for all tiles that it lies in with all of its dots there
        least = _least(ids, label)
        owner = sequence_owners(rounds[inside], rc[inside], tile[inside], radius, length) if inside.any() else np.zeros(0, int)
        taken = np.full(len(ids), None, object)
        kept = np.flatnonzero(inside)
        taken[kept[owner >= 0]] = ids[kept[owner[owner >= 0]]]
        out = group.assign(kind=np.where(inside, 0, 1), label=np.where(inside, taken, least))
        out = out[crossing | (taken != None)]  # noqa: E711
        return out[[*by, *names]]

    return tiled.groupBy("_run").applyInPandas(run, _keyed(rows, by, _TILED))


def owners(dots: DataFrame, radius: float, length: int = LENGTH, by: tuple[str, ...] = ("fov_num", "channel"), rc: tuple[str, str] = ("r_px_registered", "c_px_registered")) -> DataFrame:
    """``by``, dot_id, round_num, r, c and ``barcode_reference_dot_id``, the dot that took it in sequential consumption, or itself.

    Dots that no chain of links within the radius joins never meet, so what one task holds is a cluster of dots, not an
    image. Dots are dealt to tiles of TILE radii, with a margin of one, and tiles to runs. A cluster without dots in the margin lies in its
    tile and is decoded there. Of the others, the pieces that share a dot are joined over the tiles' borders (components
    of pieces), and their dots are dealt again, by cluster, in runs of about MOST_DOTS. Tiles and clusters of more dots
    than that are decoded by joins, one round after another.
    """
    rows = cut(_whole_images(dots, by, rc))
    side = float(TILE * radius) if radius > 0 else float(TILE)
    full = rows.groupBy(*by, F.floor(F.col("r") / side), F.floor(F.col("c") / side)).agg(F.count("*").alias("_n")).filter(F.col("_n") > MOST_DOTS).select(*by).distinct()
    crowded = [r.asDict() for r in full.limit(1).collect()]
    if crowded:
        # images with such a tile, whole
        full = cut(full)
        return owners_joined(rows.join(full, list(by), "left_semi"), radius, length, by).unionByName(owners(rows.join(full, list(by), "left_anti"), radius, length, by, ("r", "c")))
    tiled = cut(_decoded_tiles(rows, radius, length, by))
    names = ["dot_id", "round_num", "r", "c"]
    inside = tiled.filter("kind = 0").select(*by, *names, F.col("label").alias("barcode_reference_dot_id"))
    pieces = tiled.filter("kind = 1")
    home = pieces.filter("own").select(*by, *names, "label")
    # a dot of the margin is in its home tile's piece too; the image is part of a piece's name
    name = lambda label: F.struct(*by, F.col(label).alias("label"))
    away = pieces.filter("NOT own").select(*by, "dot_id", F.col("label").alias("_other"))
    links = home.join(away, [*by, "dot_id"]).select(name("label").alias("a"), name("_other").alias("b"))
    roots = components(links)
    placed = home.withColumn("node", name("label")).join(roots, "node", "left").withColumn("_cluster", F.coalesce("root", "node")).drop("node", "root", "label")
    placed = cut(placed)
    sizes = placed.groupBy("_cluster").agg(F.count("*").alias("_n"))
    large = sizes.filter(F.col("_n") > MOST_DOTS).select("_cluster")
    made = inside
    if not large.isEmpty():
        large = cut(large)
        made = made.unionByName(owners_joined(placed.join(large, "_cluster", "left_semi").drop("_cluster"), radius, length, by))
        placed = placed.join(large, "_cluster", "left_anti")
    # a run holds many clusters: as many runs as make them about as large as a cluster may be
    runs = max(1, placed.count() // MOST_DOTS)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group, rounds, rc = _in_order(group)
        owner = sequence_owners(rounds, rc, group["_kind"].factorize()[0].astype(np.int64), radius, length)
        group["barcode_reference_dot_id"] = np.where(owner >= 0, group["dot_id"].to_numpy(object)[owner], None)
        return group.loc[owner >= 0, [*by, *names, "barcode_reference_dot_id"]]

    dealt = placed.withColumn("_run", F.pmod(F.xxhash64("_cluster"), F.lit(runs))).withColumn("_kind", F.to_json("_cluster")).drop("_cluster")
    return made.unionByName(dealt.groupBy("_run").applyInPandas(run, _keyed(rows, by, _OWNED)))


def owners_joined(rows: DataFrame, radius: float, length: int, by: tuple[str, ...] = ("fov_num", "channel"), rc: tuple[str, str] = ("r", "c")) -> DataFrame:
    """The same as :func:`owners` by joins alone, one round after another."""
    pool, made = rows.filter(F.col("dot_id").isNotNull()).select(*by, F.col("dot_id").cast("string").alias("dot_id"), "round_num", F.col(rc[0]).alias("r"), F.col(rc[1]).alias("c")), []
    for k in range(1, length + 1):
        ref, other = pool.filter(F.col("round_num") == k), pool.filter(F.col("round_num") != k)
        near = nearest_within(other, ref, radius, ("r", "c"), ("r", "c"), "dot_id", "dot_id", list(by))
        taken = cut(near.select(*by, "dot_id", "round_num", "r", "c", F.col("r_dot_id").alias("barcode_reference_dot_id")))
        made += [taken, ref.withColumn("barcode_reference_dot_id", F.col("dot_id"))]
        pool = cut(other.join(taken.select("dot_id"), "dot_id", "left_anti").select(*by, "dot_id", "round_num", "r", "c"))
    return reduce(lambda a, b: a.unionByName(b), made)


def codes_of(owned: DataFrame, by: tuple[str, ...] = ("fov_num", "channel")) -> DataFrame:
    """Codes of dots with their owners: bit k - 1 is set if a dot of round k belongs to the reference.

    A reference that took no dot gives no code, unless no dot of another round was left when its turn came. That
    happens to the last references of an image, and only if none of their round took a dot.
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("round_num") - 1)
    self_ = F.col("dot_id") == F.col("barcode_reference_dot_id")
    codes = owned.groupBy(*by, "barcode_reference_dot_id").agg(F.max(F.when(self_, F.struct("round_num", "r", "c"))).alias("_ref"), F.bit_or(bit).alias("code_bits"), F.count("*").alias("_n"))
    codes = codes.select(*by, "barcode_reference_dot_id", "_ref.round_num", "_ref.r", "_ref.c", "code_bits", (F.col("_n") > 1).alias("_took"))
    last = codes.groupBy(*by).agg(F.max(F.struct("round_num", "_took")).alias("_last"))
    same = reduce(lambda x, y: x & y, [F.col(f"x.{b}").eqNullSafe(F.col(f"y.{b}")) for b in by])
    alone = (F.col("round_num") == F.col("_last.round_num")) & ~F.col("_last._took")
    return codes.alias("x").join(last.alias("y"), same).filter(F.col("_took") | alone).select(*(F.col(f"x.{b}") for b in by), "barcode_reference_dot_id", "round_num", "r", "c", "code_bits")


def decode(dots: DataFrame, radius: float, length: int = LENGTH, by: tuple[str, ...] = ("fov_num", "channel"), rc: tuple[str, str] = ("r_px_registered", "c_px_registered")) -> DataFrame:
    """Codes of all dots, each (fov, channel) on its own, decoded a cluster of linked dots at a time.

    An image with a null coordinate is not decoded at all, as its registration failed.
    """
    return codes_of(owners(dots, radius, length, by, rc), by)


def members(dots: DataFrame, radius: float, length: int = LENGTH, by: tuple[str, ...] = ("fov_num", "channel"), rc: tuple[str, str] = ("r_px_registered", "c_px_registered")) -> DataFrame:
    """dot_id and the reference dot that took it, single dots with themselves."""
    return owners(dots, radius, length, by, rc).select(*by, "dot_id", "barcode_reference_dot_id")


def decode_joined(dots: DataFrame, radius: float, length: int, by: list[str], rc: tuple[str, str]) -> DataFrame:
    """The same as :func:`decode` by joins alone."""
    return codes_of(owners_joined(_whole_images(dots, tuple(by), rc), radius, length, tuple(by)), tuple(by))


def decode_recollecting(
    dots: DataFrame, codebook: DataFrame, radii: tuple[float, float] = (2.0, 3.0), length: int = LENGTH, by: tuple[str, ...] = ("fov_num", "channel"),
    rc: tuple[str, str] = ("r_px_registered", "c_px_registered"),
) -> DataFrame:
    """Two passes: the dots of codes that are off by more than two bits, and single dots, are decoded again with the second radius.

    ``pass`` tells the two apart; each code is returned once.
    """
    owned = cut(owners(dots, radii[0], length, by, rc))
    first = cut(nearest_codeword(codes_of(owned, by), codebook, length).withColumn("pass", F.lit(1)))
    good = first.filter(F.col("hamming_distance") <= 2 / length).select("barcode_reference_dot_id")
    used = owned.join(good, "barcode_reference_dot_id", "left_semi").select("dot_id")
    rest = dots.withColumn("dot_id", F.col("dot_id").cast("string")).join(used, "dot_id", "left_anti")
    second = nearest_codeword(decode(rest, radii[1], length, by, rc), codebook, length).withColumn("pass", F.lit(2))
    return first.unionByName(second)


def bit_intensities(decoded: DataFrame, pixels: DataFrame, reach: int, frame: int, rc: tuple[str, str] = ("r", "c"), key: str = "barcode_reference_dot_id") -> DataFrame:
    """Per code and round, the largest pixel value in the box of ``reach`` around it, cut at 0 and ``frame``.

    ``pixels``: fov_num, round_num, pr, pc, value; pixels of value 0 may be left out. Pairs meet in grid cells of
    the box's size.
    """
    side = 2 * reach + 1
    box = lambda c: (F.greatest((F.col(c) - reach).cast("int"), F.lit(0)), F.least((F.col(c) + reach).cast("int"), F.lit(frame)))
    (r0, r1), (c0, c1) = box(rc[0]), box(rc[1])
    # a box outside the frame is empty; left in, its sequence of cells would run backwards
    boxes = decoded.select("fov_num", key, r0.alias("r0"), r1.alias("r1"), c0.alias("c0"), c1.alias("c1")).filter("r0 <= r1 AND c0 <= c1")
    cells = boxes.withColumn("_gr", F.explode(F.sequence(F.floor(F.col("r0") / side), F.floor(F.col("r1") / side))))
    cells = cells.withColumn("_gc", F.explode(F.sequence(F.floor(F.col("c0") / side), F.floor(F.col("c1") / side))))
    found = pixels.withColumns({"_gr": F.floor(F.col("pr") / side), "_gc": F.floor(F.col("pc") / side)}).join(cells, ["fov_num", "_gr", "_gc"])
    inside = found.filter(F.col("pr").between(F.col("r0"), F.col("r1")) & F.col("pc").between(F.col("c0"), F.col("c1")))
    return inside.groupBy(key, "round_num").agg(F.max("value").alias("intensity"))


def wide_intensities(intensities: DataFrame, rounds: int, key: str = "barcode_reference_dot_id") -> DataFrame:
    """One column per bit, absent boxes 0."""
    wide = intensities.groupBy(key).pivot("round_num", list(range(1, rounds + 1))).agg(F.max("intensity"))
    return wide.select(key, *(F.coalesce(F.col(str(i)), F.lit(0.0)).alias(f"bit_{i}_intensity") for i in range(1, rounds + 1)))


__all__ = ["barcode_bits", "bit_intensities", "codes_of", "decode", "decode_joined", "decode_recollecting", "flip_summary", "members", "nearest_codeword", "owners", "owners_joined", "wide_intensities"]
