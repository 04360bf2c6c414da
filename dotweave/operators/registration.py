"""Shifts between rounds and tiles, and their application."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions.lineage import cut
from ..schema import ERRORS, REFERENCE_MATCHES, SHIFTS
from .geometry import in_overlaps
from .graphs import components

#: Larger shifts of a pair of tiles are no measurement.
USABLE, FAILED = 20.0, 1000.0
#: Bytes of strips that a task holds before it hands them on.
STRIP_BYTES = 1 << 24


def round_shifts_of(dots: pd.DataFrame, reference: int, rounds: int, shape: tuple[int, int], tolerance: float, least: int) -> pd.DataFrame:
    """fov_num, round_num, dr, dc, n_match of one tile's beads (round_num, r, c).

    The reference is the first round from ``reference`` on that has beads; a round before it or without beads
    gets an error code in place of a count, as does one with fewer than ``least`` matching beads.
    """
    dots = dots.dropna(subset=["r", "c"])
    by = {k: g[["r", "c"]].to_numpy(float) for k, g in dots.groupby("round_num")}
    ref = next((k for k in range(reference, rounds + 1) if k in by), None)
    rows = []
    for k in range(1, rounds + 1):
        dr = dc = None
        if ref is None:
            n = ERRORS["missing_in_registration_channel"]
        elif k == ref:
            dr, dc, n = 0.0, 0.0, REFERENCE_MATCHES
        elif k < ref:
            if k < reference:
                continue
            n = ERRORS["missing_in_reference_round" if k == reference else "missing_in_round"]
        elif k not in by:
            n = ERRORS["missing_in_round"]
        else:
            (dr, dc), n = A.dots_shift(shape, by[ref], by[k], tolerance)
        rows.append((k, dr, dc, n))
    return pd.DataFrame(rows, columns=["round_num", "dr", "dc", "n_match"])


def round_shifts(beads: DataFrame, reference: int, rounds: int, shape: tuple[int, int], tolerance: float = 3, least: int = 5, rc: tuple[str, str] = ("r_px_original", "c_px_original")) -> DataFrame:
    """Shifts of every round of every tile; a group is one tile's beads."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        made = round_shifts_of(group, reference, rounds, shape, tolerance, least)
        return made.assign(fov_num=key[0])[["fov_num", "round_num", "dr", "dc", "n_match"]].astype({"dr": "float64", "dc": "float64"})

    rows = beads.select(F.col("fov_num").cast("int").alias("fov_num"), F.col("round_num").cast("int").alias("round_num"), F.col(rc[0]).alias("r"), F.col(rc[1]).alias("c"))
    return rows.groupBy("fov_num").applyInPandas(run, SHIFTS)


def round_shifts_by_kind(beads: DataFrame, **how) -> DataFrame:
    """Large beads decide; tiles where they give no usable shift (a round with fewer than two) fall back on all beads."""
    large = beads.filter(F.col("mapped_beads_type") == "large")
    few = large.groupBy("fov_num", "round_num").agg(F.count("*").alias("n")).groupBy("fov_num").agg(F.min("n").alias("n")).filter("n < 2").select("fov_num")
    none = beads.select("fov_num").distinct().join(large.select("fov_num").distinct(), "fov_num", "left_anti")
    back = few.union(none).distinct()
    return round_shifts(large.join(back, "fov_num", "left_anti"), **how).unionByName(round_shifts(beads.join(back, "fov_num", "left_semi"), **how))


def register(dots: DataFrame, shifts: DataFrame, rc: tuple[str, str] = ("r_px_original", "c_px_original"), least: int | None = None) -> DataFrame:
    """``dots`` with registered coordinates, shifts and match counts. With ``least`` (beads), lower counts become the error code."""
    joined = dots.join(shifts, ["fov_num", "round_num"], "left")
    count = F.col("n_match")
    if least is not None:
        count = F.when(count.between(0, least - 1), F.lit(ERRORS["too_few_matches"])).otherwise(count)
    return joined.select(
        *dots.columns, (F.col(rc[0]) + F.col("dr")).alias("r_px_registered"), (F.col(rc[1]) + F.col("dc")).alias("c_px_registered"),
        F.col("dr").alias("r_shift_px"), F.col("dc").alias("c_shift_px"), count.alias("min_number_matching_dots_registration"),
    )


def image_shifts(images: DataFrame, reference: int) -> DataFrame:
    """Shifts of whole (nuclei) images of a tile onto its reference round; the residual error stands for the count."""
    from .images import to_array

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        by = {row["round_num"]: to_array(row) for _, row in group.iterrows()}
        rows = []
        for k, img in sorted(by.items()):
            if reference not in by:
                rows.append((key[0], k, None, None, ERRORS["missing_in_reference_round"]))
            else:
                dr, dc = A.phase_shift(by[reference], img)
                rows.append((key[0], k, dr, dc, REFERENCE_MATCHES if k == reference else 0))
        return pd.DataFrame(rows, columns=["fov_num", "round_num", "dr", "dc", "n_match"]).astype({"dr": "float64", "dc": "float64"})

    return images.groupBy("fov_num").applyInPandas(run, SHIFTS)


def registered_stack(images: DataFrame, shifts: DataFrame) -> DataFrame:
    """One row per tile and channel: the rounds' images, shifted and stacked in order of round."""
    from .images import to_array

    schema = "fov_num int, channel string, rounds array<int>, shape array<int>, dtype string, pixels binary"

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.dropna(subset=["dr"]).sort_values("round_num")
        if not len(group):
            return pd.DataFrame(columns=[x.split()[0] for x in schema.split(", ")])
        stack = np.stack([A.shift_image(to_array(row), (row["dr"], row["dc"])) for _, row in group.iterrows()])
        return pd.DataFrame([{"fov_num": key[0], "channel": key[1], "rounds": group["round_num"].tolist(), "shape": list(stack.shape), "dtype": "float64", "pixels": stack.tobytes()}])

    return images.join(shifts, ["fov_num", "round_num"]).groupBy("fov_num", "channel").applyInPandas(run, schema)


def pair_shifts(beads: DataFrame, rects: DataFrame, tolerance: float = 3, rc: tuple[str, str] = ("r", "c")) -> DataFrame:
    """a, b, dr, dc, err of each overlap: how far tile b's beads must move onto a's. A side without beads gives a failed shift."""
    inside = in_overlaps(beads.select("fov_num", *rc), rects, rc)
    rows = inside.select("a", "b", "side", F.col(rc[0]).alias("r"), F.col(rc[1]).alias("c"))
    # every overlap takes part, also those without any bead
    marks = rects.select("a", "b", F.lit(None).cast("string").alias("side"), F.col("r_tl").alias("r"), F.col("c_tl").alias("c"))

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        corner = group[group["side"].isna()][["r", "c"]].to_numpy(float)[0]
        one, two = (group[group["side"] == s][["r", "c"]].to_numpy(float) - corner for s in ("a", "b"))
        dr, dc, err = FAILED, FAILED, None
        if len(one) and len(two):
            shape = tuple(np.ceil(np.concatenate([one, two]).max(axis=0)).astype(int) + 1)
            (dr, dc), n = A.dots_shift(shape, one, two, tolerance)
            err = 1 - n / len(two)
        return pd.DataFrame([(*key, dr, dc, err)], columns=["a", "b", "dr", "dc", "err"]).astype({"err": "float64"})

    schema = f"a {rects.schema['a'].dataType.simpleString()}, b {rects.schema['b'].dataType.simpleString()}, dr double, dc double, err double"
    return rows.unionByName(marks).groupBy("a", "b").applyInPandas(run, schema)


def cut_strips(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """a, b, side, shape and pixels of the strips of images (shape, dtype, pixels, overlaps), in frames of about STRIP_BYTES: dark images
    are few bytes to a shuffle, so a batch may hold thousands, whose strips are many times as large."""
    far = {"a": ("top", "left"), "b": ("bottom", "right")}  # at which orders of tile a a side's strip lies at the far edge
    known = ("top", "bottom"), ("left", "right")
    frame = lambda made: pd.DataFrame(made, columns=["a", "b", "side", "shape", "pixels"])
    for rows in batches:
        made, size = [], 0
        for pixels, dtype, shape, overlaps in zip(rows["pixels"], rows["dtype"], rows["shape"], rows["overlaps"]):
            whole = np.frombuffer(pixels, dtype).reshape(tuple(shape))
            for o in overlaps:
                order, high_wide = (o["a_row"], o["a_column"]), (o["high"], o["wide"])
                if any(x not in k for x, k in zip(order, known)) or min(high_wide) < 1:
                    continue
                ends = [slice(n - min(k, n), n) if x == f else slice(0, k) for n, k, x, f in zip(whole.shape, high_wide, order, far[o["side"]])]
                strip = whole[tuple(ends)].astype(np.float64)
                made.append((o["a"], o["b"], o["side"], list(strip.shape), strip.tobytes()))
                size += strip.nbytes
                if size >= STRIP_BYTES:
                    yield frame(made)
                    made, size = [], 0
        yield frame(made)


def overlap_strips(images: DataFrame, rects: DataFrame) -> DataFrame:
    """``a, b, side, shape, pixels``: what each tile's image (fov_num, shape, dtype, pixels) shows of each of its overlaps, as doubles.

    The strip lies along the edges that ``a_row`` and ``a_column`` name for tile a, and along the opposite ones for b. Images are cut
    where they are read: they meet their few overlaps as an array, and only strips go on. Tiles without pixels give none, nor do
    empty boxes and unknown orders.
    """
    box = F.struct("a", "b", F.abs(F.col("r_br") - F.col("r_tl")).cast("int").alias("high"), F.abs(F.col("c_br") - F.col("c_tl")).cast("int").alias("wide"), "a_row", "a_column")
    ends = [rects.select(F.col(s).alias("fov_num"), F.struct(F.lit(s).alias("side"), *(box.getField(x).alias(x) for x in ("a", "b", "high", "wide", "a_row", "a_column"))).alias("o")) for s in ("a", "b")]
    cuts = ends[0].unionByName(ends[1]).groupBy("fov_num").agg(F.collect_list("o").alias("overlaps"))
    kind = lambda c: rects.schema[c].dataType.simpleString()
    whole = images.filter(F.col("pixels").isNotNull()).select("fov_num", "shape", "dtype", "pixels")
    return whole.join(cuts, "fov_num").mapInPandas(cut_strips, f"a {kind('a')}, b {kind('b')}, side string, shape array<int>, pixels binary")


def image_pair_shifts(images: DataFrame, rects: DataFrame) -> DataFrame:
    """a, b, dr, dc, err of each overlap, from the tiles' images: how far b's strip must move onto a's, by phase correlation.

    ``err`` is the share of both strips that the shift leaves unexplained (0: equal strips). A side without an image, or one whose
    strip has another shape, is a failed shift without ``err``; of several images of a tile the smallest in order of bytes counts.
    """
    marks = rects.select("a", "b", F.lit(None).cast("string").alias("side"), F.lit(None).cast("array<int>").alias("shape"), F.lit(None).cast("binary").alias("pixels"))

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        dr, dc, err = FAILED, FAILED, None
        one, two = (sorted(zip(g["pixels"], g["shape"]), key=lambda x: x[0]) for g in (group[group["side"] == s] for s in ("a", "b")))
        if one and two and tuple(one[0][1]) == tuple(two[0][1]):
            x, y = (np.frombuffer(v[0][0]).reshape(tuple(v[0][1])) for v in (one, two))
            dr, dc = map(float, A.phase_shift(x, y))
            power, like = (x * x).sum() * (y * y).sum(), (x * np.roll(y, (int(dr), int(dc)), (0, 1))).sum()
            err = float(np.sqrt(max(1 - like * like / power, 0))) if power else None
        return pd.DataFrame([(*key, dr, dc, err)], columns=["a", "b", "dr", "dc", "err"]).astype({"err": "float64"})

    schema = f"a {rects.schema['a'].dataType.simpleString()}, b {rects.schema['b'].dataType.simpleString()}, dr double, dc double, err double"
    return overlap_strips(images, rects).unionByName(marks).groupBy("a", "b").applyInPandas(run, schema)


#: Tiles along the side of a block of the first level, and how many blocks of a level make one of the next, along a side.
BLOCK, GROWTH = 8, 4
_PART = "kind int, i bigint, j bigint, w double, xr double, xc double"


def eliminate(nodes: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
    """One block of the normal equations: its inner tiles are eliminated.

    ``nodes``: node, gr, gc (right sides), outer (has an edge to another block); ``edges``: a, b, w inside the block. Rows:
    0 an edge i, j, w between outer tiles that stands for the paths through inner ones; 1 an outer tile's new right side; 2 an
    inner tile's own part of the solution; 3 how much of outer tile j's solution goes off inner tile i's.
    """
    names, outer = nodes["node"].to_numpy(np.int64), nodes["outer"].to_numpy(bool)
    order = np.argsort(outer, kind="stable")
    names, n, inner = names[order], len(names), int((~outer).sum())
    g = nodes[["gr", "gc"]].to_numpy(float)[order]
    place = pd.Series(np.arange(n), index=names)
    m = np.zeros((n, n))
    a, b, w = place[edges["a"]].to_numpy(int), place[edges["b"]].to_numpy(int), edges["w"].to_numpy(float)
    np.add.at(m, (a, b), -w)
    np.add.at(m, (b, a), -w)
    m[np.arange(n), np.arange(n)] = -m.sum(axis=1)
    ii, io, oi, oo = m[:inner, :inner], m[:inner, inner:], m[inner:, :inner], m[inner:, inner:]
    # a group of inner tiles without an outer neighbour has no fixed level: the smallest solution
    solved = np.linalg.lstsq(ii, np.hstack([io, g[:inner]]), rcond=None)[0] if inner else np.zeros((0, n - inner + 2))
    through, own = solved[:, : n - inner], solved[:, n - inner :]
    reduced, right = oo - oi @ through, g[inner:] - oi @ own
    p, q = np.nonzero(np.triu(-reduced, 1) > 1e-12)
    x, y = np.nonzero(np.abs(through) > 1e-14)
    rows = [
        pd.DataFrame({"kind": 0, "i": names[inner + p], "j": names[inner + q], "w": -reduced[p, q], "xr": 0.0, "xc": 0.0}),
        pd.DataFrame({"kind": 1, "i": names[inner:], "j": -1, "w": 0.0, "xr": right[:, 0], "xc": right[:, 1]}),
        pd.DataFrame({"kind": 2, "i": names[:inner], "j": -1, "w": 0.0, "xr": own[:, 0], "xc": own[:, 1]}),
        pd.DataFrame({"kind": 3, "i": names[x], "j": names[inner + y], "w": through[x, y], "xr": 0.0, "xc": 0.0}),
    ]
    return pd.concat([r.astype({"kind": "int32", "i": "int64", "j": "int64"}) for r in rows])


def least_squares_offsets(pairs: DataFrame, tiles: DataFrame) -> DataFrame:
    """``node, xr, xc``: the smallest least-squares solution of x_b - x_a = (dr, dc) over ``pairs``, for all ``tiles`` (fov_num, r, c).

    The normal equations are those of a weighted graph of tiles, and eliminating the inner tiles of a block gives such
    equations again, over the tiles on the blocks' borders. So blocks of tiles are solved side by side, then blocks of
    GROWTH x GROWTH of them, until one is left; the solution goes back the same way, a join and a sum a level. A level
    holds a table of edges and one of tiles; nothing is collected. Each connected component has a level of its own, which the
    smallest solution puts at a mean of zero. Tiles without a pair are at zero.
    """
    ends = lambda df, *names: df.select(*(F.col(n).cast("bigint").alias(n) for n in names), *(c for c in df.columns if c not in names))
    at = tiles.select(F.col("fov_num").cast("bigint").alias("node"), "r", "c")
    box = at.agg(F.min("r").alias("r"), F.min("c").alias("c"), (F.max("r") - F.min("r")).alias("h"), (F.max("c") - F.min("c")).alias("w"), F.count("*").alias("n"))
    unit = F.greatest(F.sqrt(F.col("h") * F.col("w") / F.col("n")), F.greatest("h", "w") / F.col("n"), F.lit(1e-9))
    at = cut(at.crossJoin(F.broadcast(box.select(F.col("r").alias("r0"), F.col("c").alias("c0"), unit.alias("unit")))).select("node", ((F.col("r") - F.col("r0")) / F.col("unit")).alias("r"), ((F.col("c") - F.col("c0")) / F.col("unit")).alias("c")))
    known = at.select("node")
    good = ends(pairs.select("a", "b", "dr", "dc"), "a", "b").filter("a <> b")
    good = good.join(known.withColumnRenamed("node", "a"), "a", "left_semi").join(known.withColumnRenamed("node", "b"), "b", "left_semi")
    edges = cut(good.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count("*").cast("double").alias("w")))
    sides = good.select(F.explode(F.array(F.struct(F.col("b").alias("node"), F.col("dr").alias("gr"), F.col("dc").alias("gc")), F.struct(F.col("a").alias("node"), (-F.col("dr")).alias("gr"), (-F.col("dc")).alias("gc")))).alias("s"))
    right = sides.groupBy("s.node").agg(F.sum("s.gr").alias("gr"), F.sum("s.gc").alias("gc"))
    nodes = at.join(right, "node", "left").na.fill(0.0, ["gr", "gc"])
    roots, levels, side = components(edges), [], float(BLOCK)
    while True:
        nodes = nodes.withColumn("blk", F.struct(F.floor(F.col("r") / side).alias("i"), F.floor(F.col("c") / side).alias("j")))
        where = nodes.select("node", "blk")
        placed = edges.join(where.select(F.col("node").alias("a"), F.col("blk").alias("ba")), "a").join(where.select(F.col("node").alias("b"), F.col("blk").alias("bb")), "b")
        crossing = placed.filter("ba <> bb").select("a", "b", "w")
        outer = crossing.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("outer", F.lit(True))
        marked = nodes.join(outer, "node", "left").na.fill(False, ["outer"]).select("blk", "node", "gr", "gc", "outer")
        inside = placed.filter("ba = bb").select(F.col("ba").alias("blk"), "a", "b", "w")
        made = cut(marked.groupBy("blk").cogroup(inside.groupBy("blk")).applyInPandas(eliminate, _PART))
        levels.append(made)
        left = made.filter("kind = 1").select(F.col("i").alias("node"), F.col("xr").alias("gr"), F.col("xc").alias("gc"))
        if left.isEmpty():
            break
        edges = cut(crossing.unionByName(made.filter("kind = 0").select(F.col("i").alias("a"), F.col("j").alias("b"), "w")).groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("w").alias("w")))
        nodes, side = left.join(at, "node"), side * GROWTH
    solved = None
    for made in reversed(levels):
        own = made.filter("kind = 2").select(F.col("i").alias("node"), "xr", "xc")
        if solved is not None:
            off = made.filter("kind = 3").select("i", F.col("j").alias("node"), "w").join(solved, "node").groupBy(F.col("i").alias("node")).agg(F.sum(F.col("w") * F.col("xr")).alias("or"), F.sum(F.col("w") * F.col("xc")).alias("oc"))
            own = own.join(off, "node", "left").select("node", (F.col("xr") - F.coalesce("or", F.lit(0.0))).alias("xr"), (F.col("xc") - F.coalesce("oc", F.lit(0.0))).alias("xc")).unionByName(solved)
        solved = cut(own)
    rooted = solved.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mean = rooted.groupBy("root").agg(F.avg("xr").alias("mr"), F.avg("xc").alias("mc"))
    return rooted.join(mean, "root").select("node", (F.col("xr") - F.col("mr")).alias("xr"), (F.col("xc") - F.col("mc")).alias("xc"))


def predicted_offsets(moved: DataFrame) -> DataFrame:
    """``fov_num, r, c, xr, xc`` with offsets beyond FAILED replaced by a linear fit of the others over the tiles' positions.

    The fit's normal equations are sums over all tiles: a dozen numbers reach the driver.
    """
    far = (F.abs("xr") > FAILED) | (F.abs("xc") > FAILED)
    near = moved.filter(~far)
    if moved.filter(far).isEmpty():
        return moved
    centre = near.agg(F.avg("r"), F.avg("c")).first()
    if centre[0] is None:
        return moved
    u = [F.lit(1.0), F.col("r") - centre[0], F.col("c") - centre[1]]
    sums = near.agg(*(F.sum(x * y) for x in u for y in [*u, F.col("xr"), F.col("xc")])).first()
    m = np.array(sums, float).reshape(3, 5)
    fit = np.linalg.pinv(m[:, :3]) @ m[:, 3:]
    line = lambda k: F.lit(float(fit[0, k])) + u[1] * float(fit[1, k]) + u[2] * float(fit[2, k])
    # towards zero
    whole = lambda x: F.when(x < 0, F.ceil(x)).otherwise(F.floor(x)).cast("double")
    return moved.withColumns({name: F.when(far, whole(line(k))).otherwise(F.col(name)) for k, name in enumerate(("xr", "xc"))})


def global_offsets(pairs: DataFrame, tiles: DataFrame, anchor: int | None = None) -> DataFrame:
    """fov_num, r, c of the tiles after global stitching by the pair shifts (a, b, dr, dc).

    Pairs of ``USABLE`` pixels or more are not used. Of the least-squares solution the anchor's (the first tile's) is taken
    off, and the rest is cut to whole numbers. Offsets beyond FAILED are replaced by what the others predict.
    """
    solved = cut(least_squares_offsets(pairs.filter((F.abs("dr") < USABLE) & (F.abs("dc") < USABLE)), tiles))
    first = solved.filter(F.col("node") == anchor) if anchor is not None else solved
    first = first.agg(F.min(F.struct("node", "xr", "xc")).alias("_first"))  # one row
    # whole solutions come out a little above or below: not cut a pixel short
    off = lambda x: F.round(F.col(x) - F.col(f"_first.{x}"), 6)
    whole = lambda x: F.when(x < 0, F.ceil(x)).otherwise(F.floor(x)).cast("double")
    moved = solved.crossJoin(F.broadcast(first)).select(F.col("node").alias("_node"), whole(off("xr")).alias("xr"), whole(off("xc")).alias("xc"))
    placed = tiles.select("fov_num", "r", "c").join(moved, F.col("fov_num") == F.col("_node")).drop("_node")
    return predicted_offsets(placed).select(F.col("fov_num").cast("int").alias("fov_num"), (F.col("r") + F.col("xr")).alias("r"), (F.col("c") + F.col("xc")).alias("c"))
