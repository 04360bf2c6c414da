"""Operators against brute force, planted truths, and the fixed cases of their definitions."""

import random
import re

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dotweave.functions import arrays, codes
from dotweave.operators import affine, alignment, barcodes, bayes, cells, constellations, dedup, detection, geometry, graphs, images, quality, registration, selection, spatial
from dotweave.schema import DOTS, ERRORS, IMAGES, PIXELS
from dotweave.sources import catalogs, chunks

RC = ("r", "c")


def points(spark, rows, schema="dot_id long, r double, c double"):
    return spark.createDataFrame(rows, schema)


def cloud(n, seed, size=20):
    rng = random.Random(seed)
    return [(i, rng.randrange(size * 4) / 4, rng.randrange(size * 4) / 4) for i in range(n)]


@pytest.mark.parametrize("salt", [1, 3])
@pytest.mark.parametrize("strict", [False, True])
def test_radius_join_equals_brute_force(spark, salt, strict):
    a, b = cloud(150, 1), cloud(120, 2)
    got = {(r["dot_id"], r["r_dot_id"]) for r in spatial.radius_join(points(spark, a), points(spark, b), 1.5, RC, RC, strict=strict, salt=salt).collect()}
    near = lambda x, y: (x[1] - y[1]) ** 2 + (x[2] - y[2]) ** 2
    assert got == {(x[0], y[0]) for x in a for y in b if (near(x, y) < 2.25 if strict else near(x, y) <= 2.25)}


def test_joins_of_nulls_and_nothing(spark):
    some = points(spark, [(1, None, 2.0), (2, 1.0, None), (3, 1.0, 1.0)])
    assert [(r["dot_id"], r["r_dot_id"]) for r in spatial.radius_join(some, some, 5, RC, RC).collect()] == [(3, 3)]
    assert spatial.nearest_within(some.limit(0), some, 5, RC, RC, "dot_id", "dot_id").count() == 0
    same = points(spark, [(1, 0.0, 0.0), (2, 0.0, 0.0)])
    assert spatial.radius_join(same, same, 0, RC, RC).count() == 4


def test_nearest_ties_go_to_the_smaller_id(spark):
    near = spatial.nearest_within(points(spark, [(9, 0.0, 0.0)]), points(spark, [(5, 0.0, 1.0), (4, 1.0, 0.0), (3, 9.0, 9.0)]), 1, RC, RC, "dot_id", "dot_id").collect()
    assert [r["r_dot_id"] for r in near] == [4]


def test_merging_keeps_every_point_once(spark):
    a, b = points(spark, [(1, 0.0, 0.0), (2, 10.0, 10.0)]), points(spark, [(11, 1.0, 0.0), (12, 0.0, 1.5), (13, 30.0, 30.0)])
    merged = {r["dot_id"]: (r["r"], r["c"]) for r in spatial.merge_matched(a, b, 2, RC, "dot_id").collect()}
    assert merged == {1: (0.5, 0.0), 2: (10.0, 10.0), 12: (0.0, 1.5), 13: (30.0, 30.0)}


# tiles


def grid_tiles(spark, n=2, step=92.0):
    return spark.createDataFrame([(i, i // n * step, i % n * step) for i in range(n * n)], "fov_num int, r double, c double")


def test_adjacency_and_overlaps(spark):
    tiles = grid_tiles(spark)
    pairs = {(r["a"], r["b"]) for r in geometry.adjacent(tiles, 100).collect()}
    assert pairs == {(0, 1), (0, 2), (1, 3), (2, 3)}
    rects = {(r["a"], r["b"]): (r["r_tl"], r["r_br"], r["c_tl"], r["c_br"]) for r in geometry.overlaps(tiles, geometry.adjacent(tiles, 100), "top-left", 100, 100).collect()}
    assert rects[0, 1] == (0, 100, 92, 100) and rects[0, 2] == (92, 100, 0, 100)
    shifted = {(r["a"], r["b"]): (r["c_tl"], r["c_br"]) for r in geometry.overlaps(tiles, geometry.adjacent(tiles, 100), "top-right", 100, 100).collect()}
    assert shifted[0, 1] == (-8, 0)
    alone = spark.createDataFrame([(7, 0.0, 0.0)], "fov_num int, r double, c double")
    assert geometry.adjacent(alone, 100).count() == 0
    with pytest.raises(ValueError):
        geometry.tile_corners(alone, "NOT_DEFINED", 1)


def test_one_sided_adjacency_keeps_its_direction(spark):
    # tile 9 is far from the dense cluster: its nearest are in the cluster, but it is nobody's fourth nearest
    tiles = spark.createDataFrame([(i, float(i % 3), float(i // 3)) for i in range(9)] + [(20, 0.0, 5.0)], "fov_num int, r double, c double")
    got = {(r["a"], r["b"]) for r in geometry.adjacent(tiles, 100).collect()}
    assert any(a == 20 for a, _ in got) and not any(b == 20 for _, b in got)


def overlap(spark):
    return spark.createDataFrame([(0, 1, 0.0, 100.0, 90.0, 100.0, "top", "left"), (1, 2, 0.0, 100.0, 180.0, 190.0, "top", "left")], "a int, b int, r_tl double, r_br double, c_tl double, c_br double, a_row string, a_column string")


DEDUP = [
    (1, 0, "x", 50.0, 95.0), (2, 1, "x", 51.0, 95.0),  # same gene, near: 2 goes
    (3, 1, "y", 50.0, 95.0), (4, 1, "x", 50.0, 120.0),  # other gene; outside the box
    (5, 1, "x", 0.0, 95.0), (6, 0, "x", 0.0, 95.0),  # on the edge
    (7, 1, None, 50.0, 95.0), (8, 1, "x", 20.0, 185.0), (9, 2, "x", 21.0, 185.0),  # no gene; second pair: 9 goes
]


def test_duplicates_leave_the_second_tile(spark):
    dots = spark.createDataFrame(DEDUP, "dot_id long, fov_num int, gene string, r double, c double")
    ids = dedup.duplicated(dots, overlap(spark), 1, RC, "gene")
    assert sorted(r["dot_id"] for r in ids.collect()) == [2, 9]
    assert dedup.duplicated(dots, overlap(spark), 1, RC, "gene", strict=True).count() == 0
    kept, gone = dedup.split_by(dots, ids)
    assert kept.count() + gone.count() == len(DEDUP)
    assert dedup.duplicated(kept, overlap(spark), 1, RC, "gene").count() == 0  # once is enough


def test_clipping_cuts_once(spark):
    dots = spark.createDataFrame([(i, f, 50.0, c) for i, (f, c) in enumerate([(0, 94.0), (0, 95.0), (0, 96.0), (1, 94.0), (1, 96.0), (1, 184.0), (1, 186.0), (2, 186.0)])], "dot_id long, fov_num int, r double, c double")
    rects = overlap(spark)
    want = [0, 4, 5, 7]
    assert sorted(r["dot_id"] for r in dedup.clip(dots, rects, RC).collect()) == want
    assert sorted(r["dot_id"] for r in dedup.clip(dots, rects.orderBy(F.desc("a")), RC).collect()) == want


def test_chunks_give_the_remainder_to_the_last(spark):
    rows = sorted(tuple(r) for r in geometry.chunks(10, 5, 4, spark).collect())
    assert rows == [(0, 4, 0, 5), (4, 10, 0, 5)]


# barcodes


def naive_decode(dots, radius, length):
    """The definition, dot by dot."""
    pool, out = sorted(dots, key=lambda d: (d[1], d[0])), []
    for k in range(1, length + 1):
        ref, other = [d for d in pool if d[1] == k], [d for d in pool if d[1] != k]
        if not ref:
            continue
        if not other:
            return out + [(d[0], 1 << (k - 1)) for d in ref]
        bits, taken = {}, set()
        for o in other:
            d2, _, name = min(((o[2] - d[2]) ** 2 + (o[3] - d[3]) ** 2, i, d[0]) for i, d in enumerate(ref))
            if d2 <= radius * radius:
                bits[name] = bits.get(name, 0) | 1 << (o[1] - 1)
                taken.add(o[0])
        out += [(name, b | 1 << (k - 1)) for name, b in bits.items()]
        pool = [d for d in other if d[0] not in taken]
    return out


def test_decoding_three_ways(spark):
    rng = random.Random(3)
    rows = [(f, "c", f"{f}_{i:03d}", rng.randint(1, 6), rng.randrange(60) / 2, rng.randrange(60) / 2) for f in (1, 2) for i in range(160)]
    dots = spark.createDataFrame(rows, "fov_num int, channel string, dot_id string, round_num int, r double, c double")
    want = sorted(x for f in (1, 2) for x in naive_decode([(r[2], *r[3:]) for r in rows if r[0] == f], 1.5, 6))
    got = sorted((r["barcode_reference_dot_id"], r["code_bits"]) for r in barcodes.decode(dots, 1.5, 6, rc=RC).collect())
    assert got == want
    joined = barcodes.decode_joined(dots, 1.5, 6, ["fov_num", "channel"], RC)
    assert sorted((r["barcode_reference_dot_id"], r["code_bits"]) for r in joined.collect()) == want


@pytest.mark.parametrize("tile, most", [(2, 50_000), (3, 40), (32, 100), (2, 5)])
def test_clusters_over_tile_borders_and_oversized_ones(spark, monkeypatch, tile, most):
    """Pieces meet over the borders of small tiles; clusters and tiles of more dots than a task may hold go through joins."""
    monkeypatch.setattr(barcodes, "TILE", tile)
    monkeypatch.setattr(barcodes, "MOST_DOTS", most)
    rng = random.Random(tile * most)
    rows = [(f, "c", f"{f}_{i:03d}", rng.randint(1, 6), rng.randrange(-40, 80) / 2, rng.randrange(70) / 2) for f in (1, 2) for i in range(220)]
    rows += [(1, "c", f"x{i:02d}", 1 + i % 6, 5.0, -10.0 + i) for i in range(30)]  # one chain over many tiles
    dots = spark.createDataFrame(rows, "fov_num int, channel string, dot_id string, round_num int, r double, c double")
    want = sorted(x for f in (1, 2) for x in naive_decode([(r[2], *r[3:]) for r in rows if r[0] == f], 1.5, 6))
    assert sorted((r["barcode_reference_dot_id"], r["code_bits"]) for r in barcodes.decode(dots, 1.5, 6, rc=RC).collect()) == want


@pytest.mark.parametrize("length, words", [(16, 300), (32, 120), (64, 90), (64, 1), (33, 40), (1, 2)])
def test_multi_index_finds_the_nearest_codeword_of_any_length(spark, length, words):
    rng = random.Random(length + words)
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    book = [(f"g{i}", signed(rng.getrandbits(length)), i) for i in range(words)]
    near = [(i, signed((book[i % words][1] ^ (1 << rng.randrange(length)) ^ (1 << rng.randrange(length))) % (1 << 64))) for i in range(60)]
    rows = near + [(100 + i, signed(rng.getrandbits(length))) for i in range(60)] + [(999, None)]
    got = barcodes.nearest_codeword(spark.createDataFrame(rows, "id int, code_bits long"), spark.createDataFrame(book, "gene string, code_bits long, code_idx int"), length)
    found = {r["id"]: (r["decoded_genes"], round(r["hamming_distance"] * length)) for r in got.collect()}
    distance = lambda a, b: bin((a ^ b) % (1 << 64)).count("1")
    assert found == {i: min((distance(c, b), k, g) for g, b, k in book)[::-2] for i, c in rows if c is not None}
    plan = got._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_components_and_edge_colours(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(200)] + [(1000 + rng.randrange(40), 1000 + rng.randrange(40)) for _ in range(25)] + [(5000, k) for k in range(5001, 5040)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a int, b int")
    root = {}
    for a, b in edges:
        x, y = root.setdefault(a, {a}), root.setdefault(b, {b})
        if x is not y:
            x |= y
            root.update(dict.fromkeys(y, x))
    got = {r["node"]: r["root"] for r in graphs.components(df).collect()}
    assert got == {n: min(s) for n, s in root.items() if len(s) > 1}
    proper = [(a, b) for a, b in set(edges) if a != b and a < 5000]
    classes = graphs.edge_colours(spark.createDataFrame(proper, "a int, b int"))
    found = [[(r["a"], r["b"]) for r in c.collect()] for c in classes]
    assert sorted(sum(found, [])) == sorted(proper)
    for c in found:
        ends = [n for e in c for n in e]
        assert len(ends) == len(set(ends))


def test_singletons_and_failed_registrations(spark):
    schema = "fov_num int, channel string, dot_id string, round_num int, r double, c double"
    dots = spark.createDataFrame([(1, "c", "a", 1, 0.0, 0.0), (1, "c", "b", 2, 9.0, 9.0), (2, "c", "x", 1, 0.0, 0.0), (2, "c", "y", 2, None, None)], schema)
    # a is single while b is left; b is the last and comes out; tile 2 is not decoded
    assert [(r["barcode_reference_dot_id"], r["code_bits"]) for r in barcodes.decode(dots, 1, 4, rc=RC).collect()] == [("b", 2)]
    took = {r["dot_id"]: r["barcode_reference_dot_id"] for r in barcodes.members(dots, 1, 4, rc=RC).collect()}
    assert took == {"a": "a", "b": "b"}
    edge = spark.createDataFrame([(1, "c", "a", 1, 0.0, 0.0), (1, "c", "b", 2, 0.0, 3.0), (1, "c", "d", 2, 1.0, 0.0)], schema)
    assert [r["code_bits"] for r in barcodes.decode(edge, 3, 4, rc=RC).collect()] == [3]


def test_recollecting_passes(spark):
    book = spark.createDataFrame([("g", 0b1111, 0)], "gene string, code_bits long, code_idx int")
    schema = "fov_num int, channel string, dot_id string, round_num int, r double, c double"
    rows = [(1, "c", f"a{k}", k, 0.0, float(k) * 0.1) for k in (1, 2, 3, 4)] + [(1, "c", f"b{k}", k, *at) for k, at in enumerate([(50.0, 50.0), (50.0, 52.5), (52.5, 50.0), (50.0, 47.5)], 1)]
    got = {(r["barcode_reference_dot_id"], r["pass"]): r["code_bits"] for r in barcodes.decode_recollecting(spark.createDataFrame(rows, schema), book, length=16, rc=RC).collect()}
    assert got["a1", 1] == 15 and got["b1", 2] == 15 and ("a1", 2) not in got


def test_nearest_codeword_ties_and_flips(spark):
    book = spark.createDataFrame([("late", 0b0011, 1), ("early", 0b1100, 0)], "gene string, code_bits long, code_idx int")
    rows = spark.createDataFrame([(1, 0b0110), (2, 0b0111), (3, 0b0011)], "id long, code_bits long")
    got = {r["id"]: r for r in barcodes.nearest_codeword(rows, book, 4).collect()}
    assert got[1]["decoded_genes"] == "early" and got[1]["hamming_distance"] == 0.5
    assert got[2]["decoded_genes"] == "late" and got[2]["hamming_distance"] == 0.25 and got[2]["number_positive_bits"] == 3
    assert got[3]["hamming_distance"] == 0
    flips = {(r["position"], r["direction"]): r["n"] for r in barcodes.flip_summary(barcodes.nearest_codeword(rows, book, 4), 4).collect()}
    assert flips == {(2, -1): 1, (1, -1): 1, (3, 1): 1} or flips[(2, -1)] >= 1


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 1), min_size=1, max_size=16))
def test_bits_round_trip(bits):
    packed = sum(b << i for i, b in enumerate(bits))
    assert [(packed >> i) & 1 for i in range(len(bits))] == bits


def test_code_functions(spark):
    df = spark.createDataFrame([("[0110]", "x_Hybridization07", "Count00123_a", 0.5), ("0011", "y_Hybridization12", "none", 2.0)], "code string, name string, file string, v double")
    got = df.select(
        codes.pack_bits(codes.parse_codeword(F.col("code"))).alias("bits"), codes.unpack_bits(codes.pack_bits(codes.parse_codeword(F.col("code"))), 4).alias("back"), codes.round_of(F.col("name")).alias("round"),
        codes.count_code(F.col("file")).alias("code"), codes.to_uint16(F.col("v")).alias("u"), codes.to_uint16_truncated(F.col("v")).alias("t"), codes.none_to_null(F.lit("None")).alias("none"),
    ).collect()
    assert tuple(got[0])[0] == 6 and list(got[0]["back"]) == [0, 1, 1, 0] and got[1]["bits"] == 12
    assert [r["round"] for r in got] == [7, 12] and [r["code"] for r in got] == ["Count00123", ""]
    assert (got[0]["u"], got[0]["t"], got[1]["u"]) == (32768, 32767, 65535) and got[0]["none"] is None
    assert codes.elapsed(93_784) == "1 d 2 h 3 min 4 s" and codes.elapsed(5) == "5 s"


def test_wide_intensities(spark):
    decoded = points(spark, [(1, 5.0, 5.0), (2, 0.0, 0.0)], "barcode_reference_dot_id long, r double, c double").withColumn("fov_num", F.lit(1))
    pixels = spark.createDataFrame([(1, 1, 4, 6, 0.5), (1, 1, 5, 5, 0.25), (1, 2, 9, 9, 1.0), (1, 2, 1, 1, 0.75)], "fov_num int, round_num int, pr int, pc int, value double")
    wide = {r[0]: tuple(r)[1:] for r in barcodes.wide_intensities(barcodes.bit_intensities(decoded, pixels, 1, 10), 2).collect()}
    assert wide == {1: (0.5, 0.0), 2: (0.0, 0.75)}


# cells


def test_points_in_cells(spark):
    mask = spark.createDataFrame([(1, 1, 5), (2, 1, 3)], "r int, c int, cell_id long")
    dots = points(spark, [(1, 1.0, 1.0), (2, 1.5, 1.0), (3, 0.4, 1.0), (4, 1.49, 1.5), (5, None, 1.0), (6, 1.51, 1.0)])
    got = {r["dot_id"]: r["cell_id"] for r in cells.assign(dots, mask, RC).collect()}
    assert got == {1: 5, 2: 3, 3: -1, 4: 5, 5: -1, 6: 3}


def test_counts_and_matrix(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "b"), (-1, "a")], "cell_id long, gene string")
    counts = cells.gene_counts(rows, "gene")
    assert {tuple(r) for r in cells.matrix(counts, [1, 2], "gene").collect()} == {("a", 2, 0), ("b", 1, 1)}
    assert tuple(cells.medians(counts).first()) == (2.0, 1.5)
    assert [r["gene"] for r in cells.top_genes(counts, 1, most=False).collect()] == ["a"]


def test_objects_merge(spark):
    px = [(0, "a", i, 0) for i in range(30)] + [(1, "b", i, 0) for i in range(11, 40)] + [(1, "z", i, 9) for i in range(5)]
    pixels = spark.createDataFrame(px, "fov_num int, obj_id string, r int, c int")
    pairs = spark.createDataFrame([(0, 1)], "a int, b int")
    assert cells.shared_pixels(pixels, pairs, 20).count() == 0
    couples = cells.best_couples(cells.shared_pixels(pixels, pairs, 19))
    merged = {r["obj_id"]: r["area"] for r in cells.regions(cells.merged_regions(pixels, couples)).collect()}
    assert merged == {"a": 40, "z": 5}
    assert {r["cell_id"] for r in cells.label_canvas(cells.merged_regions(pixels, couples)).collect()} == {1, 2}


def test_labels_grow_to_the_nearest(spark):
    mask = spark.createDataFrame([(5, 5, 2), (5, 9, 1)], "r int, c int, cell_id long")
    got = {(r["r"], r["c"]): r["cell_id"] for r in cells.expand_labels(mask, 2, 20, 20).collect()}
    assert got[5, 5] == 2 and got[5, 6] == 2 and got[5, 8] == 1 and got[5, 7] == 1 and (5, 12) not in got and (7, 5) in got and (7, 6) not in got


# images and registration


def test_peaks_of_the_documented_example():
    img = np.zeros((7, 7))
    img[3, 4], img[3, 2] = 1, 1.5
    assert arrays.peaks(img, 1).tolist() == [[3, 2], [3, 4]]
    assert arrays.peaks(img, 2).tolist() == [[3, 2]]
    assert len(arrays.peaks(np.ones((5, 5)))) == 0
    assert arrays.peaks(img, 1, most=1).tolist() == [[3, 2]]


def test_labels_against_flood_fill():
    rng = np.random.default_rng(0)
    for p in (0.2, 0.5, 0.7):
        mask = rng.random((30, 40)) < p
        got = arrays.labels(mask)
        seen, name = np.zeros(mask.shape, int), 0
        for start in np.argwhere(mask):
            if seen[tuple(start)]:
                continue
            name += 1
            stack = [tuple(start)]
            while stack:
                r, c = stack.pop()
                if 0 <= r < 30 and 0 <= c < 40 and mask[r, c] and not seen[r, c]:
                    seen[r, c] = name
                    stack += [(r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)]
        assert (got == seen).all()


def test_filters_of_known_images():
    flat = np.full((20, 20), 3.0)
    assert np.allclose(arrays.gaussian(flat, 2), flat) and np.allclose(arrays.laplace_of_gaussian(flat, 1.5), 0, atol=1e-3)
    spot = np.zeros((31, 31))
    spot[15, 15] = 1
    smooth = arrays.gaussian(spot, 2)
    assert smooth.sum() == pytest.approx(1) and smooth.argmax() == 15 * 31 + 15
    assert (-arrays.laplace_of_gaussian(spot, 2)).argmax() == 15 * 31 + 15
    assert arrays.maximum_filter(spot, 3).sum() == 9 and arrays.dilate_disk(spot > 0, 1).sum() == 5


@settings(max_examples=20, deadline=None)
@given(st.integers(-20, 20), st.integers(-20, 20))
def test_planted_shifts_are_found(dr, dc):
    rng = np.random.default_rng(5)
    ref = rng.integers(25, 100, (40, 2)).astype(float)
    assert arrays.phase_shift(arrays.dot_image((128, 128), ref), arrays.dot_image((128, 128), ref - (dr, dc))).tolist() == [dr, dc]


def spots(seed, n=40, size=96):
    rng = np.random.default_rng(seed)
    at = rng.integers(8, size - 8, (n, 2))
    img = np.zeros((size, size))
    img[at[:, 0], at[:, 1]] = rng.uniform(0.8, 1.2, n)
    return arrays.gaussian(img, 1.2) * 8 + rng.random((size, size)) * 0.01, at


def test_detection_finds_planted_dots(spark):
    img, at = spots(1)
    found, chosen = images.detect(img, 2, 1, 200)
    assert chosen is not None and len(found) >= 30
    assert all((np.abs(at - p).sum(axis=1) <= 2).any() for p in found)
    assert images.detect(np.zeros((20, 20)), 2, 1, 9)[1] is None
    rows = [(1, "c", 1, [96, 96], "float64", bytearray(img.tobytes())), (2, "c", 1, [20, 20], "float64", bytearray(np.zeros((20, 20)).tobytes()))]
    params = {"CountingFishMinObjDistance": 2, "CountingFishMinObjSize": 1, "CountingFishMaxObjSize": 200, "LargeObjMinDistance": 2, "LargeObjMinSize": 1, "LargeObjMaxSize": 200}
    df = spark.createDataFrame(rows, PIXELS)
    got = images.dots(df, params)
    assert got.filter("fov_num = 1").count() == len(found) and got.filter("fov_num = 2 and dot_id is null").count() == 1
    assert {r["mapped_beads_type"] for r in images.beads(df, params, "both").filter("fov_num = 1").collect()} <= {"large", "small"}
    assert [x.split()[0] for x in DOTS.split(", ")] == got.columns


def test_every_filter_runs(spark):
    rng = np.random.default_rng(0)
    stack = (rng.random((17, 40, 40)) * 5000 + 1000).astype("uint16")
    df = spark.createDataFrame([(1, "c", 1, list(stack.shape), "uint16", bytearray(stack.tobytes()))], PIXELS)
    params = {
        "PreprocessingFishFlatFieldKernel": (1, 10, 10), "PreprocessingFishFilteringLaplacianKernel": (0.2, 0.5, 0.5), "PreprocessingStainingFlatFieldKernel": (1, 8, 8),
        "LargeObjRemovalPercentile": 95, "LargeObjRemovalMinObjSize": 10, "LargeObjRemovalSelem": 2,
    }
    for name in images.FILTERS:
        row = images.filtered(df, name, params, 0.001).first()
        out = np.frombuffer(row["pixels"]).reshape(row["shape"])
        assert out.shape == (40, 40) and np.isfinite(out).all(), name
    assert images.dark_image(stack).shape == (40, 40)
    sparse = catalogs.sparse_pixels(images.filtered(df, "fish", params))
    assert sparse.count() > 0


def bead_rows(fov, rounds, shift, n=30, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.integers(30, 90, (n, 2)).astype(float)
    return [(f"{fov}_{k}_{i}", fov, k, float(base[i, 0] - k * shift[0]), float(base[i, 1] - k * shift[1])) for k in rounds for i in range(n)]


def test_round_registration_and_error_codes(spark):
    rows = bead_rows(1, (1, 2, 3), (2, -1)) + bead_rows(2, (2, 4), (1, 1)) + [("3_0", 3, 1, None, None)]
    dots = spark.createDataFrame(rows, "dot_id string, fov_num int, round_num int, r double, c double")
    shifts = registration.round_shifts(dots, 1, 4, (128, 128), 3, 5, RC)
    got = {(r["fov_num"], r["round_num"]): (r["dr"], r["dc"], r["n_match"]) for r in shifts.collect()}
    assert got[1, 1] == (0, 0, 1000) and got[1, 2] == (2, -1, 30) and got[1, 3] == (4, -2, 30) and got[1, 4] == (None, None, ERRORS["missing_in_round"])
    assert got[2, 1] == (None, None, -4) and got[2, 2][2] == 1000 and got[2, 3][2] == -3 and got[2, 4] == (2, 2, 30)
    assert {v[2] for k, v in got.items() if k[0] == 3} == {-5}
    done = registration.register(dots, shifts, RC)
    one = {r["dot_id"]: r for r in done.filter("fov_num = 1").collect()}
    assert one["1_3_0"]["r_px_registered"] == one["1_1_0"]["r_px_registered"]
    few = spark.createDataFrame([(1, 1, 0.0, 0.0, 3)], "fov_num int, round_num int, dr double, dc double, n_match int")
    assert registration.register(dots.filter("fov_num = 1 and round_num = 1"), few, RC, least=5).first()["min_number_matching_dots_registration"] == -2
    assert spark.range(1).select(quality.status(F.lit(-2)).alias("s")).first()["s"] == "too_few_matches"


def test_bead_kinds_fall_back(spark):
    rows = [(*r, "large") for r in bead_rows(1, (1, 2), (1, 0))] + [(*r, "small") for r in bead_rows(2, (1, 2), (0, 2))]
    dots = spark.createDataFrame(rows, "dot_id string, fov_num int, round_num int, r double, c double, mapped_beads_type string")
    got = {(r["fov_num"], r["round_num"]): (r["dr"], r["dc"]) for r in registration.round_shifts_by_kind(dots, reference=1, rounds=2, shape=(128, 128), rc=RC).collect()}
    assert got[1, 2] == (1, 0) and got[2, 2] == (0, 2)


def test_image_shifts_and_stacks(spark):
    img, _ = spots(3, size=64)
    moved = np.roll(img, (3, -2), (0, 1))
    rows = [(1, "c", k, [64, 64], "float64", bytearray(x.tobytes())) for k, x in ((1, img), (2, moved))]
    df = spark.createDataFrame(rows, PIXELS)
    shifts = registration.image_shifts(df, 1)
    assert {(r["round_num"], r["dr"], r["dc"]) for r in shifts.collect()} == {(1, 0, 0), (2, -3, 2)}
    stack = registration.registered_stack(df, shifts).first()
    planes = np.frombuffer(stack["pixels"]).reshape(stack["shape"])
    assert np.allclose(planes[0], planes[1], atol=1e-9)


def dense_offsets(pairs, tiles):
    """The smallest least-squares solution, all at once."""
    names = sorted(tiles)
    place = {t: i for i, t in enumerate(names)}
    good = [p for p in pairs if abs(p[2]) < 20 and abs(p[3]) < 20]
    m = np.zeros((len(good), len(names)))
    for row, (a, b, *_) in enumerate(good):
        m[row, place[b]] += 1
        m[row, place[a]] -= 1
    x = np.linalg.lstsq(m, np.array([p[2:] for p in good], float).reshape(-1, 2), rcond=None)[0] if good else np.zeros((len(names), 2))
    return dict(zip(names, x))


@pytest.mark.parametrize("block, width, height", [(2, 11, 9), (8, 23, 20), (3, 40, 1)])
def test_offsets_agree_with_a_dense_solution(spark, monkeypatch, block, width, height):
    """Noisy and contradicting shifts, failed pairs, repeated ones, tiles in parts and alone."""
    monkeypatch.setattr(registration, "BLOCK", block)
    rng = random.Random(width)
    tiles = {i: (i // width * 90.0 + rng.random(), i % width * 90.0) for i in range(width * height)}
    tiles[9000], tiles[9001] = (5000.0, 5000.0), (-300.0, 20.0)
    pairs = [(a, b, rng.uniform(-15, 15), rng.uniform(-15, 15)) for a in tiles for b in (a + 1, a + width) if a < 9000 and b in tiles and (b - a == width or b % width) and b % width != 7 and rng.random() < 0.9]
    pairs += [(b, a, -dr + 1, -dc) for a, b, dr, dc in pairs[::9]] + [(0, 1, 1000.0, 1000.0), (1, 2, 3.0, 20.0), (0, 77_777, 1.0, 1.0)]
    frame = spark.createDataFrame(pairs, "a int, b int, dr double, dc double")
    places = spark.createDataFrame([(k, *v) for k, v in tiles.items()], "fov_num int, r double, c double")
    known = [p for p in pairs if p[1] in tiles]
    want = dense_offsets(known, tiles)
    got = {r["node"]: (r["xr"], r["xc"]) for r in registration.least_squares_offsets(frame.filter("abs(dr) < 20 AND abs(dc) < 20"), places).collect()}
    assert got.keys() == want.keys() and max(np.abs(np.array(got[t]) - want[t]).max() for t in want) < 1e-6
    moved = {r["fov_num"]: (r["r"], r["c"]) for r in registration.global_offsets(frame, places).collect()}
    assert moved == {t: tuple(np.array(tiles[t]) + np.trunc(np.round(x - want[0], 6))) for t, x in want.items()}


def test_offsets_without_pairs_and_far_ones(spark):
    tiles = {i: (float(i), float(i * i % 7)) for i in range(40)}
    places = spark.createDataFrame([(k, *v) for k, v in tiles.items()], "fov_num int, r double, c double")
    none = spark.createDataFrame([], "a int, b int, dr double, dc double")
    assert {r["fov_num"]: (r["r"], r["c"]) for r in registration.global_offsets(none, places).collect()} == tiles
    rows = [(k, *v, 2 * v[0] + 3.0, -v[1], ) if k % 5 else (k, *v, 5000.0, 0.0) for k, v in tiles.items()]
    moved = spark.createDataFrame(rows, "fov_num int, r double, c double, xr double, xc double")
    got = {r["fov_num"]: (r["xr"], r["xc"]) for r in registration.predicted_offsets(moved).collect()}
    for k, (r, c) in tiles.items():
        assert abs(got[k][0] - (2 * r + 3)) <= 1 and abs(got[k][1] + c) <= 1


def test_pair_shifts(spark):
    rng = np.random.default_rng(2)
    at = rng.uniform([0, 90], [100, 100], (40, 2)).round()
    rows = [(0, float(r), float(c)) for r, c in at] + [(1, float(r + 3), float(c - 1)) for r, c in at]
    beads = spark.createDataFrame(rows, "fov_num int, r double, c double")
    got = {(r["a"], r["b"]): (r["dr"], r["dc"], r["err"]) for r in registration.pair_shifts(beads, overlap(spark)).collect()}
    assert got[0, 1][:2] == (-3, 1) and got[0, 1][2] < 0.3 and got[1, 2] == (1000, 1000, None)


# alignment, calls, checks, sources


def test_density_offset():
    rng = np.random.default_rng(0)
    a = rng.uniform(0, 200, (80, 2))
    b = np.concatenate([a - (4, -2.5) + rng.normal(0, 0.3, a.shape), rng.uniform(0, 200, (20, 2))])
    assert np.allclose(alignment.offset_of(a, b, 15, bandwidth=1.5), (4, -2.5), atol=0.5)
    assert alignment.offset_of(a, b + 10_000) is None


def _planted(rng, n, side):
    source = rng.uniform(0, side, (n, 2))
    return source, np.column_stack(alignment.transform_columns(source[:, 0], source[:, 1], 0.66, 0.5, (0.0, 0.0), (120.0, -40.0)))


def _placed_by(fit, source):
    return np.column_stack(alignment.transform_columns(source[:, 0], source[:, 1], fit["scale"], fit["degrees"], fit["centre"], fit["offset"]))


def test_affine_fit_recovers_what_was_planted(spark):
    rng = np.random.default_rng(1)
    frame = lambda x: spark.createDataFrame(pd.DataFrame(x, columns=["r", "c"]))
    source, there = _planted(rng, 120, 600)
    wrong = np.concatenate([there + rng.normal(0, 0.3, there.shape), rng.uniform(100, 400, (12, 2)), [[np.nan, 5.0]]])
    fit = affine.fit_affine(frame(wrong), frame(source), np.linspace(0.6, 0.72, 13), np.linspace(-2, 2, 9), radius=150, bins=6)
    assert np.abs(_placed_by(fit, source) - there).max() < 0.5
    moved = alignment.apply_affine(frame(source), fit, RC).toPandas()
    assert np.allclose(moved[["r_transformed", "c_transformed"]].to_numpy(), _placed_by(fit, source))


def test_affine_fit_meets_the_middle_of_a_turned_box(spark):
    """One far point at the start of a long strip: the strip's middle comes to lie 340 pixels off the middle of the turned strip."""
    rng = np.random.default_rng(3)
    source = np.concatenate([rng.uniform((0, 0), (40000, 400), (4000, 2)), [[100.0, 4000.0]]])
    there = np.column_stack(alignment.transform_columns(source[:, 0], source[:, 1], 0.66, 1.5, (0.0, 0.0), (120.0, -40.0)))
    frame = lambda x: spark.createDataFrame(pd.DataFrame(x, columns=["r", "c"]))
    fit = affine.fit_affine(frame(there), frame(source), [0.65, 0.66, 0.67], [0.5, 1.0, 1.5], radius=60)
    assert np.abs(_placed_by(fit, source) - there).max() < 1e-6


def test_affine_fit_finds_a_part_by_scanning_chunks(spark):
    source, there = _planted(np.random.default_rng(2), 800, 1500)
    part = there[(source > 750).all(axis=1)]  # a corner: middles of boxes are hundreds of pixels apart
    frame = lambda x: spark.createDataFrame(pd.DataFrame(x, columns=["r", "c"]))
    fit = affine.fit_affine(frame(part), frame(source), [0.65, 0.66, 0.67], [0.0, 0.5, 1.0], radius=60, centring="scan")
    assert np.abs(_placed_by(fit, source) - there).max() < 1e-6 and fit["matched"] == len(part)


def test_affine_fit_places_all_points_for_few_guesses_only(spark, monkeypatch):
    """Only the first, small window is tried by the grid of guesses; a window of many points by two at most, and there are few windows."""
    rng = np.random.default_rng(5)
    source = rng.uniform((0, 0), (20000, 500), (6000, 2))
    there = np.column_stack(alignment.transform_columns(source[:, 0], source[:, 1], 0.663, 0.7, (0.0, 0.0), (120.0, -40.0)))
    wrong = np.concatenate([(there + rng.normal(0, 0.3, there.shape))[:4000], rng.uniform(there.min(axis=0), there.max(axis=0), (2000, 2))])
    frame = lambda x: spark.createDataFrame(pd.DataFrame(x, columns=["r", "c"]))
    placed, whole = [], affine.guessed
    monkeypatch.setattr(affine, "guessed", lambda source, guesses, reach: placed.append(len(guesses)) or whole(source, guesses, reach))
    fit = affine.fit_affine(frame(wrong), frame(source), [0.65 + 0.01 * i for i in range(4)], [0.0, 0.5, 1.0], radius=150)
    assert np.abs(_placed_by(fit, source) - there).max() < 0.5
    assert placed[0] == 12 and max(placed[1:]) <= affine.BEAM and len(placed) <= 6


def test_parts_tell_the_votes_of_the_neighbours_of_a_guess(spark):
    rng = np.random.default_rng(6)
    near = rng.uniform(-400, 400, (3000, 2))
    u, w, offset = 0.02, np.deg2rad(-1.0), (12.0, -6.0)
    there = np.column_stack([near[:, 0] * (1 + u) - near[:, 1] * w + offset[0], near[:, 0] * w + near[:, 1] * (1 + u) + offset[1]])
    moved = pd.DataFrame(near, columns=["r", "c"]).assign(guess=0)
    rows = affine._parted(spark.createDataFrame(pd.DataFrame(there, columns=["r", "c"])), spark.createDataFrame(moved), 800, 10)[0]
    assert len(rows) <= affine.PARTS**2 * (2 * affine.SEEN + 1) ** 2
    d = (np.floor(there / 10)[:, None] - np.floor(near / 10)[None]).reshape(-1, 2)
    assert rows[:, 3].sum() == (np.abs(d) <= affine.SEEN).all(axis=1).sum()
    ways = [(x, y) for x in (-0.02, 0.0, 0.02) for y in np.deg2rad([-1.0, 0.0, 1.0])]
    tried = affine._around(rows, ways, 10.0)
    best = max(range(len(ways)), key=lambda x: tried[x][0])
    assert ways[best] == (u, w)
    got = affine._settled(rows, *ways[best], tried[best][1], (True, True), 10.0)
    # a tenth of a cell at the edge
    assert abs(got[0] - u) * 400 < 1 and abs(got[1] - w) * 400 < 1 and np.allclose(got[2], offset, atol=1)
    # votes that are the same everywhere speak for no neighbour, though some lead beyond what is seen
    even = np.array([(p, i, j, 50.0, (p // 8 - 3.5) * 100, (p % 8 - 3.5) * 100) for p in range(64) for i in range(-4, 5) for j in range(-4, 5)])
    assert max(abs(z) for z, _ in affine._around(even, [(x, y) for x in (-0.05, 0.0, 0.05) for y in (-0.05, 0.0, 0.05)], 10.0)) < 1e-6
    # a scale that is given stays
    assert affine._settled(rows, 0.0, w, (10.0, -10.0), (False, True), 10.0)[0] == 0.0


def test_affine_fit_of_places_that_many_points_share(spark):
    source, there = _planted(np.random.default_rng(7), 60, 500)
    many = lambda x: spark.createDataFrame(pd.DataFrame(x, columns=["r", "c"])).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(40))))
    fit = affine.fit_affine(many(there), many(source), [0.65, 0.66, 0.67], [0.0, 0.5, 1.0], radius=60)
    assert np.abs(_placed_by(fit, source) - there).max() < 1e-6 and fit["matched"] == 60


def test_affine_fit_of_nothing_is_none(spark):
    some, none = (spark.createDataFrame(x, "r double, c double") for x in ([(1.0, 2.0)], [(None, 1.0)]))
    assert affine.fit_affine(some, none, [1.0], [0.0]) is None and affine.fit_affine(none, some, [1.0], [0.0]) is None
    assert affine.chunks(none).count() == 0
    with pytest.raises(ValueError):
        affine.fit_affine(some, some, [0.0, 1.0], [0.0])


def test_votes_equal_counts_of_cell_pairs(spark):
    rng = np.random.default_rng(3)
    one, two = rng.uniform(-60, 60, (70, 2)), rng.uniform(-60, 60, (90, 2))
    moved = pd.DataFrame(two, columns=["r", "c"]).assign(guess=np.arange(90) % 3)
    got = affine.votes(spark.createDataFrame(pd.DataFrame(one, columns=["r", "c"])), spark.createDataFrame(moved), 20, 5).toPandas().set_index("guess")
    for g in range(3):
        d = (np.floor(one / 5)[:, None] - np.floor(two[g::3] / 5)[None]).reshape(-1, 2)
        d = d[(np.abs(d) <= 4).all(axis=1)]
        found, n = np.unique(d, axis=0, return_counts=True)
        assert got.loc[g, "n"] == n.max() and n[(found == got.loc[g, ["dr", "dc"]].to_numpy(float) / 5).all(axis=1)] == n.max()
        assert np.isclose(got.loc[g, "z"], (n.max() - len(d) / 81) / np.sqrt(len(d) / 81 + 1))


def test_chunks_hold_the_points_inside_their_windows(spark):
    points = np.random.default_rng(4).uniform(0, 1, (300, 2)) * (400, 900)
    got = affine.chunks(spark.createDataFrame(pd.DataFrame(points, columns=["r", "c"])), 0.25, 3, least=5).toPandas()
    low, step = points.min(axis=0), (points.max(axis=0) - points.min(axis=0)) * 0.25 / 3
    assert len(got) > 50
    for w in got.itertuples():
        start = low - 2 * step + np.array([w.i, w.j]) * step
        at = (points - start) / (2 * step)
        # the ends of the box lie on edges of windows, to the last bit either in or out
        inside, most = (at[(at > e).all(axis=1) & (at < 1 - e).all(axis=1)] for e in (1e-9, -1e-9))
        assert len(inside) <= w.n <= len(most) and w.n > 5 and np.allclose((w.r, w.c), start + step)
        if len(inside) == len(most):
            assert np.isclose(w.evenness, w.n / np.histogram2d(*inside.T, range=[[0, 1], [0, 1]], bins=30)[0].std())


def test_trimmed_median():
    assert alignment.trimmed_median(np.array([1.0] * 50 + [2.0] * 50 + [1e6])) == 1.5


def test_trimmed_medians_of_groups_equal_that_of_each(spark):
    rng = np.random.default_rng(5)
    values = {"a": rng.exponential(3, 400), "b": np.full(5, 2.0), None: np.concatenate([rng.normal(0, 1, 90), [1e6, -1e9]]), "c": np.array([7.0])}
    rows = [(k, 0, float(v)) for k, x in values.items() for v in x] + [("a", 0, None), ("a", 0, float("nan")), ("d", 0, None)]
    got = alignment.trimmed_medians(spark.createDataFrame(rows, "k string, j int, v double"), "v", ["k", "j"]).collect()
    assert {r["k"] for r in got} == set(values)
    for r in got:
        assert np.isclose(r["median"], alignment.trimmed_median(values[r["k"]])) and r["n"] <= len(values[r["k"]])


def test_dark_pixels_are_medians_of_planes(spark):
    planes = [("x", 0, 0, v) for v in (1.0, 5.0, 3.0, None)] + [("x", 0, 1, 4.0), ("y", 0, 0, None), ("y", 2, 2, 9.0)]
    df = spark.createDataFrame(planes, "channel string, r int, c int, value double")
    dark = images.dark_pixels(df)
    assert {(r["channel"], r["r"], r["c"]): (r["dark"], r["planes"]) for r in dark.collect()} == {("x", 0, 0): (3.0, 3), ("x", 0, 1): (4.0, 1), ("y", 2, 2): (9.0, 1)}
    left = images.without_dark(spark.createDataFrame([("x", 0, 0, 5.0), ("x", 0, 0, 1.0), ("z", 0, 0, 2.0)], df.schema), dark).collect()
    assert sorted((r["channel"], r["value"]) for r in left) == [("x", 0.0), ("x", 2.0), ("z", 2.0)]


def test_bayes_calls_planted_codes(spark):
    rng = np.random.default_rng(0)
    book = [("a", 0b0011), ("b", 0b1100), ("c", 0b0110)]
    rows = [(i, book[i % 3][1], 0.0, (bayes.as_bits(np.array([book[i % 3][1]]), 4)[0] + rng.normal(0.2, 0.1, 4)).tolist(), book[i % 3][0]) for i in range(600)]
    df = spark.createDataFrame(rows, "barcode_reference_dot_id long, code_bits long, hamming_distance double, bit_intensity array<double>, gene string")
    called = bayes.call_bayes(df, bayes.fit_bayes(df, 4), book, 4)
    assert called.filter("gene = bayes_gene and probability >= 0.5").count() > 570
    # rows without whole intensities are neither fitted nor called; an empty table gives no row
    broken = spark.createDataFrame([(1000, 3, 0.0, None, "a"), (1001, 3, 0.0, [1.0, None, 0.0, 0.0], "a"), (1002, 3, 0.0, [1.0], "a"), (1003, None, 0.0, [float("nan")] * 4, "a")], df.schema)
    assert bayes.call_bayes(df.union(broken), bayes.fit_bayes(df.union(broken), 4), book, 4).count() == called.count()
    assert bayes.call_bayes(df.limit(0), bayes.fit_bayes(df.limit(0), 4), book, 4).count() == 0
    assert bayes.look_up(None, np.zeros(2)).tolist() == [1e-6] * 2


def test_densities_by_diffusion():
    rng = np.random.default_rng(0)
    one = rng.normal(0.1, 0.05, 4000)
    two = np.concatenate([rng.normal(-0.6, 0.02, 4000), rng.normal(0.6, 0.02, 4000)])
    cells = lambda x: np.bincount(np.floor((x + 1) * bayes.CELLS / 2).astype(int), minlength=bayes.CELLS)
    for x, sigma, n in [(one, 0.05, 4000), (two, 0.02, 4000)]:
        counts = cells(x)
        h = bayes.bandwidth(counts)
        # about the best width for a normal peak of so many rows, which the normal-reference rule misses by far for two peaks
        assert h * 2 / bayes.CELLS == pytest.approx(1.06 * sigma * n**-0.2, rel=0.25)
        # a fixed point, by cosine sums written out
        k, m = np.arange(1, bayes.CELLS)[:, None], (np.arange(bayes.CELLS)[None] + 0.5) / bayes.CELLS
        a = 2 * (counts / counts.sum() * np.cos(np.pi * k * m)).sum(axis=1)
        t, total = (h / bayes.CELLS) ** 2, counts.sum()
        k = k[:, 0].astype(float)
        norm = lambda s, at: 0.5 * np.pi ** (2 * s) * np.sum(k ** (2 * s) * a**2 * np.exp(-((k * np.pi) ** 2) * at))
        f = norm(7, t)
        for s in (6, 5, 4, 3, 2):
            odd = np.prod([2 * j - 1 for j in range(1, s + 1)])
            f = norm(s, (2 * (1 + 2.0 ** -(s + 0.5)) / 3 * odd / np.sqrt(2 * np.pi) / (total * f)) ** (2 / (3 + 2 * s)))
        assert (2 * total * np.sqrt(np.pi) * f) ** -0.4 == pytest.approx(t, rel=1e-6)
        # every kernel summed on its own
        y, at = bayes.density(counts, h), (np.arange(bayes.CELLS) - bayes.CELLS / 2 + 0.5) / (bayes.CELLS / 2)
        reach = h * 2 / bayes.CELLS * np.sqrt(5)
        want = [np.maximum(0.75 / reach * (1 - ((z - x) / reach) ** 2), 0).mean() for z in at[::64]]
        assert np.allclose(y[1:-1:64], want, atol=0.02 * max(want)) and np.allclose(bayes.look_up(y, at[::64])[np.array(want) > 0.1], y[1:-1:64][np.array(want) > 0.1])
    assert bayes.bandwidth(np.bincount([7] * 5, minlength=bayes.CELLS)) == 1


GOOD = {
    "Stitching_type": "large-beads", "Experiment_type": "eel-barcoded", "Barcode_length": 16, "Barcode": "True", "Codebooks": {"c1": "book", "c2": "None"}, "Machine": "ROBOFISH2",
    "Operator": "o", "Overlapping_percentage": "8", "Probes_FASTA": {"c1": "p"}, "Species": "s", "Start_date": "d", "Strain": "s", "Tissue": "t", "Pipeline": "p",
}


@pytest.mark.parametrize(
    "change, faults",
    [({}, 0), ({"Machine": "X"}, 1), ({"Barcode_length": 8}, 1), ({"Codebooks": {"c1": "lost"}}, 1), ({"Codebooks": None}, 1), ({"Probes_FASTA": {"c": "lost"}}, 1), ({"Barcode": "yes"}, 1), ({"Stitching_type": "no"}, 1)],
)
def test_configuration_checks(change, faults):
    assert len(quality.check_config(GOOD | change, {"book"}, {"p"})) == faults
    assert quality.check_config({}, set(), set())


def test_selections(spark):
    df = spark.createDataFrame([(i, "c" if i % 2 else "d", i % 3, f"{i}") for i in range(12)], "fov_num int, channel string, round_num int, x string")
    assert selection.fov_range(df, 3, 5).count() == 3 and selection.channel(df, "c").count() == 6 and selection.one_round(df, 0).count() == 4
    assert selection.fov_list(df, [1, 99]).count() == 1 and selection.fov_list(df, df.limit(2)).count() == 2
    assert selection.not_processed(df, df.filter("fov_num < 4")).count() == 8
    named = selection.with_dot_id(df.withColumn("fov_num", F.lit(1)), ["x"])
    assert named.select("dot_id").distinct().count() == 12
    assert selection.overwrite(df, {"channel": "z"}, F.col("fov_num") == 0).filter("channel = 'z'").count() == 1
    rows = spark.createDataFrame([("a", 0.0), ("b", 0.1), (None, 0.0)], "decoded_genes string, hamming_distance double")
    assert selection.plotting_extract(rows, 0, ["decoded_genes"]).count() == 1 and selection.plotting_extract(rows, 0.2, ["decoded_genes"]).count() == 2
    assert selection.interior(spark.createDataFrame([(5.0, 5.0, 0.1), (0.0, 5.0, 0.1)], "r double, c double, hamming_distance double"), "r", "c", 1, 10).count() == 1


def test_catalogs(spark, tmp_path):
    import json

    meta = {"metadata": {"g1/.zattrs": {"fov_num": 3, "channel": "Cy5", "round_num": 2, "barcode": "True", "strain": "None", "codebook": "None"}, "g1/.zarray": {}, ".zgroup": {"zarr_format": 2}}}
    (tmp_path / "zmeta.json").write_text(json.dumps(meta))
    row = catalogs.zarr_catalog(spark, str(tmp_path / "zmeta.json")).collect()
    assert len(row) == 1 and row[0]["fov_num"] == 3 and row[0]["barcode"] is True and row[0]["codebook"] is None and row[0]["grp_name"] == "g1"
    assert catalogs.zarr_catalog(spark, str(tmp_path / "zmeta.json")).columns == [x.split()[0] for x in IMAGES.split(", ")]
    (tmp_path / "1_Cy5_2_1x2x3.raw").write_bytes(np.arange(6, dtype="uint16").tobytes())
    raw = catalogs.raw_pixels(spark, str(tmp_path)).first()
    assert images.to_array(raw).tolist() == [[[0, 1, 2], [3, 4, 5]]]
    book = catalogs.codebook(spark.createDataFrame([("[0110]", "g2"), ("[1000]", "g1")], "Barcode string, Gene string"), channel="Cy5").orderBy("code_idx").collect()
    assert [(r["gene"], r["code_bits"]) for r in book] == [("g1", 1), ("g2", 6)]
    catalogs.write_config(spark, {"a": {"b": {"c": {"k": 1}}}}, str(tmp_path / "conf"))
    files = spark.createDataFrame([("/x/Count00001_Hybridization03.nd2", "Europium", "t")], "path string, channel string, target_name string")
    parsed = catalogs.parsed_files(files, spark.createDataFrame([("/x/y_Count00001.pkl",)], "path string"), "Europium").first()
    assert (parsed["round_num"], parsed["processing_type"], parsed["side_path"]) == (3, "beads", "/x/y_Count00001.pkl")
    assert catalogs.parameters({"a": {"b": {"c": {"k": 1}}}}, "a", "b", "c") == {"k": 1}
    with pytest.raises(ValueError):
        catalogs.parameters({}, "a", "b", "c")
    counts = spark.createDataFrame([(1, "a", 2), (1, "b", 1)], "cell_id long, gene string, n long")
    catalogs.write_matrix(counts, spark.createDataFrame([(1,), (2,)], "cell_id long"), {"k": "v"}, str(tmp_path / "m"))
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "m/cells")).collect()} == {(1, 3), (2, 0)}
    stage = str(tmp_path / "stage")
    catalogs.write_stage(spark.createDataFrame([(1, "a"), (2, "b")], "fov_num int, x string"), stage)
    plan = catalogs.stage(spark, stage).filter("fov_num = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fov_num" in plan


def moved_points(seed=0, n=40):
    rng = np.random.default_rng(seed)
    a = rng.uniform(0, 100, (n, 2))
    t = np.deg2rad(7)
    m = 1.1 * np.array([[np.cos(t), -np.sin(t)], [np.sin(t), np.cos(t)]])
    return a, m


def test_constellations_find_a_rotation(spark):
    a, _ = moved_points()
    t = np.deg2rad(20)
    b = a @ np.array([[np.cos(t), -np.sin(t)], [np.sin(t), np.cos(t)]]).T + (5, -9)
    frame = lambda x: spark.createDataFrame([(1, i, float(r), float(c)) for i, (r, c) in enumerate(x)], "fov_num int, dot_id int, r double, c double")
    sig = [constellations.signatures(frame(x), 4, 60, RC, "dot_id", ["fov_num"]) for x in (a, b)]
    found = constellations.matches(*sig, 0.01, "dot_id", ["fov_num"], RC)
    assert found.filter("dot_id = r_dot_id").count() == found.count() > 30
    fit = constellations.group_similarities(found, ["fov_num"], RC, 0.5).first()
    assert fit["scale"] == pytest.approx(1) and fit["degrees"] == pytest.approx(20) and fit["dr"] == pytest.approx(5, abs=1e-6) and fit["inliers"] == found.count()
    none = constellations.group_similarities(found.limit(2), ["fov_num"], RC, 0.5).first()
    assert none["inliers"] == 0 and none["scale"] is None


def test_similarities_ignore_wrong_matches(spark):
    a, m = moved_points()
    b = a @ m.T + (3, 4)
    b[:12] += np.random.default_rng(1).uniform(20, 50, (12, 2))
    rows = [(None, *map(float, (*x, *y))) for x, y in zip(a, b)] + [(None, None, 1.0, 1.0, 1.0)]
    rows += [(1, 5.0, 5.0, 6.0, 6.0)] * 4 + [(2, 0.0, 0.0, 1.0, 1.0), (2, 1.0, 0.0, 2.0, 1.0)]
    found = spark.createDataFrame(rows, "fov_num int, r double, c double, r_r double, r_c double")
    fits = {x["fov_num"]: x for x in constellations.group_similarities(found, ["fov_num"], RC, 0.5).collect()}
    # a null group is one as well; the least squares over all right matches
    x, y = a[12:] - a[12:].mean(axis=0), b[12:] - b[12:].mean(axis=0)
    p, q = (x * y).sum() / (x * x).sum(), (x[:, 0] * y[:, 1] - x[:, 1] * y[:, 0]).sum() / (x * x).sum()
    got = fits[None]
    assert got["inliers"] == 28 and got["scale"] == pytest.approx(np.hypot(p, q)) and got["degrees"] == pytest.approx(np.degrees(np.arctan2(q, p)))
    assert (got["dr"], got["dc"]) == pytest.approx((3, 4))
    # matches all at one place, and two of them only: no similarity
    assert all(fits[k]["inliers"] == 0 and fits[k]["scale"] is None for k in (1, 2))
    assert constellations.group_similarities(found.limit(0), ["fov_num"], RC, 0.5).count() == 0


def test_round_shifts_of_dots_half_a_frame_apart(spark):
    """Circular correlation has a second peak of the same height half a frame away, under which fewer dots meet."""
    rows = []
    for tile, pair in enumerate([[(20, 30), (84, 30)], [(20, 30), (20, 94)], [(20, 30), (84, 94)], [(54, 94), (118, 30)]]):
        rows += [(tile, k, r + 2.0 * (k - 1), c - 1.0 * (k - 1)) for k in (1, 2, 3) for r, c in pair]
    dots = spark.createDataFrame(rows, "fov_num int, round_num int, r double, c double")
    got = registration.round_shifts(dots, 1, 3, (128, 128), 0.5, 5, RC).filter("round_num > 1").collect()
    assert len(got) == 8 and {(x["dr"] + 2 * (x["round_num"] - 1), x["dc"] - (x["round_num"] - 1), x["n_match"]) for x in got} == {(0.0, 0.0, 2)}


def test_strips_are_handed_on_before_a_batch_ends(monkeypatch):
    monkeypatch.setattr(registration, "STRIP_BYTES", 1 << 16)
    over = [{"side": s, "a": 1, "b": 2, "high": 24, "wide": 80, "a_row": "top", "a_column": "left"} for s in "ab"]
    rows = pd.DataFrame([{"shape": [64, 80], "dtype": "uint16", "pixels": np.full((64, 80), i, "uint16").tobytes(), "overlaps": over} for i in range(50)])
    made = list(registration.cut_strips(iter([rows])))
    assert max(sum(map(len, m["pixels"])) for m in made) < 2 << 16 and sum(map(len, made)) == 100
    assert [np.frombuffer(p)[0] for p in pd.concat(made)["pixels"]] == [i for i in range(50) for _ in "ab"]


def test_image_pair_shifts_meet_the_strips_of_every_order(spark):
    rng = np.random.default_rng(4)
    canvas = rng.uniform(0, 1, (80, 90))
    # tile 0 above left, 1 above right, 2 below left, 3 below right; 30 x 40 pixels shared; 4 has no image
    corners = {0: (0, 0), 1: (0, 40), 2: (30, 0), 3: (30, 40)}
    cut = {k: canvas[r : r + 50, c : c + 50] for k, (r, c) in corners.items()}
    images_of = [(k, [50, 50], "float64", bytearray(x.tobytes())) for k, x in cut.items()] + [(4, [50, 50], "float64", None)]
    df = spark.createDataFrame(images_of, "fov_num int, shape array<int>, dtype string, pixels binary")
    rows = [(0, 3, "top", "left"), (3, 0, "bottom", "right"), (1, 2, "top", "right"), (2, 1, "bottom", "left"), (0, 4, "top", "left"), (5, 6, "top", "left"), (1, 3, "above", "left")]
    rects = spark.createDataFrame([(a, b, 30.0, 50.0, 40.0, 50.0, r, c) for a, b, r, c in rows], "a int, b int, r_tl double, r_br double, c_tl double, c_br double, a_row string, a_column string")
    got = {(x["a"], x["b"]): (x["dr"], x["dc"], x["err"]) for x in registration.image_pair_shifts(df, rects).collect()}
    assert len(got) == len(rows)
    for pair in [(0, 3), (3, 0), (1, 2), (2, 1)]:
        assert got[pair][:2] == (0, 0) and got[pair][2] < 1e-6
    for pair in [(0, 4), (5, 6), (1, 3)]:
        assert got[pair] == (1000, 1000, None)
    strips = {(x["a"], x["side"]): np.frombuffer(x["pixels"]).reshape(x["shape"]) for x in registration.overlap_strips(df, rects.filter("a = 1 AND b = 2")).collect()}
    assert (strips[1, "a"] == canvas[30:50, 40:50]).all() and (strips[1, "b"] == canvas[30:50, 40:50]).all()
    assert registration.image_pair_shifts(df.limit(0), rects).filter("dr = 1000").count() == len(rows)


def test_triangles_equal_brute_force(spark):
    import itertools

    rng = np.random.default_rng(4)
    a = rng.uniform(0, 30, (25, 2))
    frame = lambda x: spark.createDataFrame([(1, i, float(r), float(c)) for i, (r, c) in enumerate(x)], "k int, dot_id int, r double, c double")
    side = lambda p, q: float(np.hypot(*(a[p] - a[q])))
    want = {t for t in itertools.combinations(range(25), 3) if max(side(t[0], t[1]), side(t[0], t[2]), side(t[1], t[2])) <= 10}
    made = constellations.triangles(frame(a), 10, RC, "dot_id", ["k"])
    assert {(r["p"], r["q"], r["s"]) for r in made.collect()} == want
    other = constellations.triangles(frame(a + (40, 3)), 10, RC, "dot_id", ["k"])
    found = constellations.triangle_matches(made, other, ["k"], 1.0)
    assert found.count() == len(want) and found.filter("p = r_p and q = r_q and s = r_s").count() == len(want)


def test_registration_groups(spark):
    files = spark.createDataFrame([("a_channel_Eu_fov_1_dots",), ("a_channel_Cy5_fov_1_dots",), ("a_channel_Cy5_fov_12_dots",), ("noise",)], "path string")
    got = {r["fov_num"]: (r["reference"], r["others"]) for r in constellations.registration_groups(files, "Eu").collect()}
    assert got == {1: (["a_channel_Eu_fov_1_dots"], ["a_channel_Cy5_fov_1_dots"]), 12: ([], ["a_channel_Cy5_fov_12_dots"])}


def test_parameters():
    from dotweave.plans import parameters

    assert parameters.selected("fish", {"fish": {"CountingFishMinObjSize": 9}, "RegistrationTollerancePxl": 4})["CountingFishMinObjSize"] == 9
    assert parameters.selected("staining")["RegistrationTollerancePxl"] == 3
    with pytest.raises(ValueError):
        parameters.selected("nothing")


def test_near_offsets_against_all_pairs():
    rng = np.random.default_rng(4)
    a, b = rng.uniform(-50, 90, (300, 2)), rng.uniform(-50, 90, (9000, 2))
    d = a[:, None] - b[None]
    want = d[(d**2).sum(axis=2) <= 49]
    got = alignment.near_offsets(a, b, 7.0)
    assert np.allclose(got[np.lexsort(got.T)], want[np.lexsort(want.T)])
    assert alignment.offset_of(a[:0], b, 7.0) is None


@pytest.mark.parametrize("k", [1, 4])
def test_k_nearest_of_crowds_repeats_and_far_points(spark, k):
    rng = random.Random(k)
    rows = [(i, rng.random() * 100, rng.random() * 7) for i in range(150)] + [(300 + i, 5.0, 5.0) for i in range(80)] + [(500, 1e5, -1e5), (501, 1e5, -1e5 + 3), (502, None, 1.0)]
    rows += [(600 + i, 50 + rng.random() * 1e-3, 3.0) for i in range(80)]
    got = spatial.k_nearest(spark.createDataFrame(rows, "id int, r double, c double"), k, RC, "id").collect()
    some = [x for x in rows if x[1] is not None]
    want = [(i, j, rank) for i, r, c in some for rank, (_, j) in enumerate(sorted(((x - r) ** 2 + (y - c) ** 2, j) for j, x, y in some if j != i)[:k], 1)]
    assert sorted((r["a"], r["b"], r["rank"]) for r in got) == sorted(want)
    few = spark.createDataFrame([(1, 0.0, 0.0), (2, 3.0, 4.0)], "id int, r double, c double")
    assert sorted((r["a"], r["b"], r["d2"], r["rank"]) for r in spatial.k_nearest(few, 5, RC, "id").collect()) == [(1, 2, 25.0, 1), (2, 1, 25.0, 1)]
    assert spatial.k_nearest(few.limit(0), 2, RC, "id").count() == 0


def test_tiles_of_dots_are_decoded_many_at_once(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(rng.randrange(2), "ch1", f"d{i}", rng.randrange(1, 5), rng.random() * 3000, rng.random() * 40) for i in range(4000)]
    dots = spark.createDataFrame(rows, "fov_num int, channel string, dot_id string, round_num int, r double, c double")
    by = ("fov_num", "channel")
    want = sorted(map(tuple, barcodes.decode_joined(dots, 2.0, 4, list(by), RC).collect()))
    for some in (100, 20_000):
        monkeypatch.setattr(barcodes, "RUN_DOTS", some, raising=False)
        assert sorted(map(tuple, barcodes.decode(dots, 2.0, 4, by, RC).collect())) == want
    # a call a run of tiles, not a call a tile
    plan = barcodes._decoded_tiles(dots, 2.0, 4, by)._jdf.queryExecution().analyzed().toString()
    assert re.search(r"FlatMapGroupsInPandas \[(\w+)#", plan)[1] == "_run"


def _shuffled(spark, from_stage=0):
    """Rows that stages from ``from_stage`` on have written to shuffles, and the next stage."""
    gateway = spark.sparkContext._gateway
    stages = spark._jsc.sc().statusStore().stageList(gateway.jvm.java.util.ArrayList(), False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    stages = [stages.apply(i) for i in range(stages.size())]
    return sum(x.shuffleWriteRecords() for x in stages if x.stageId() >= from_stage), max([x.stageId() + 1 for x in stages], default=0)


def test_group_similarities_deal_no_matches_by_group(spark, monkeypatch):
    rng = random.Random(9)
    rows = []
    for i in range(4000):
        g, r, c, off = i % 2 or None, rng.random() * 100, rng.random() * 100, 50.0 if i % 5 < 2 else rng.random() * 0.1
        rows.append((g, i, r, c, 2 * c + off, -2 * r + 3 + off))
    found = spark.createDataFrame(rows, "g int, i int, r double, c double, r_r double, r_c double")
    fits = lambda: sorted(map(str, constellations.group_similarities(found, ["g"], RC, 1.0, order=("i",)).select("g", F.round("degrees", 3), F.round("scale", 2), "inliers").collect()))
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _, stage = _shuffled(spark)
        got = fits()
        assert [x for x in got if "inliers=1200" in x] == got and len(got) == 2
        assert _shuffled(spark, stage)[0] < len(rows)
        monkeypatch.setattr(constellations, "HANDED", 0, raising=False)
        assert fits() == got
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_objects_are_linked_by_numbers_and_named_by_their_first_run(spark, monkeypatch):
    nodes, link = [], detection.components
    monkeypatch.setattr(detection, "components", lambda edges: nodes.append(edges.schema["a"].dataType.simpleString()) or link(edges))
    pixels = [("x", 4, 1, 1), ("x", 3, 2, 5), ("x", 2, 3, 1), ("x", 2, 4, 1), ("x", 9, 9, 1), ("y", 2, 3, 1), (None, 2, 3, 1)]
    df = spark.createDataFrame(pixels, "image string, r int, c int, value int")
    got = {(x["image"], x["r"], x["first"]): tuple(x["object"]) for x in detection.objects(df, ["image"]).collect()}
    assert got == {("x", 4, 1): ("x", 2, 3), ("x", 3, 2): ("x", 2, 3), ("x", 2, 3): ("x", 2, 3), ("x", 9, 9): ("x", 9, 9), ("y", 2, 3): ("y", 2, 3), (None, 2, 3): (None, 2, 3)}
    assert nodes == ["bigint"]


@pytest.mark.parametrize("block", [40, 20_000])
def test_k_nearest_in_blocks_shuffles_points_not_pairs(spark, monkeypatch, block):
    rng = random.Random(block)
    monkeypatch.setattr(spatial, "BLOCK", block, raising=False)
    rows = [(i, float(rng.randrange(400)), float(int(rng.expovariate(0.1)))) for i in range(3000)] + [(5000 + i, 1000.0 + rng.random(), -3.0) for i in range(100)]
    _, stage = _shuffled(spark)
    got = spatial.k_nearest(spark.createDataFrame(rows, "id int, r double, c double").coalesce(1), 3, RC, "id").collect()
    at = np.array([x[1:] for x in rows])
    ids = np.array([x[0] for x in rows])
    want = []
    for i, x in enumerate(at):
        d2 = ((at - x) ** 2).sum(axis=1)
        d2[i] = np.inf
        want += [(int(ids[i]), int(ids[j]), float(d2[j]), rank) for rank, j in enumerate(np.lexsort((ids, d2))[:3], 1)]
    assert sorted(map(tuple, got)) == sorted(want)
    if block != 40:
        assert _shuffled(spark, stage)[0] < 4 * len(rows)


@pytest.mark.parametrize("distance, block", [(3, 256), (40, 256), (3, 8), (12, 8), (0, 16)])
def test_label_growth_is_the_nearest_label(spark, monkeypatch, distance, block):
    monkeypatch.setattr(cells, "BLOCK", block)
    rng = random.Random(distance)
    rows = [(rng.randrange(-2, 60), rng.randrange(-2, 70), rng.randrange(-3, 9)) for _ in range(70)] + [(5, 5, None)]
    got = {(r["r"], r["c"]): r["cell_id"] for r in cells.expand_labels(spark.createDataFrame(rows, "r int, c int, cell_id int"), distance, 60, 70).collect()}
    nearest = {(r, c): min(((x - r) ** 2 + (y - c) ** 2, n) for x, y, n in rows if n is not None) for r in range(60) for c in range(70)}
    assert got == {at: n for at, (d, n) in nearest.items() if d <= distance * distance}


def merged_plainly(points, rects, radius, least):
    """One pair after another on {id: [tile, gene, r, c]}."""
    now = {k: list(v) for k, v in points.items()}
    for a, b, r0, r1, c0, c1 in rects:
        side = {t: [k for k, v in now.items() if v[0] == t and r0 <= v[2] <= r1 and c0 <= v[3] <= c1] for t in (a, b)}
        if min(map(len, side.values())) <= least:
            continue
        d2 = lambda x, y: (now[x][2] - now[y][2]) ** 2 + (now[x][3] - now[y][3]) ** 2
        near = {y: min((d2(x, y), x) for x in side[a]) for y in side[b]}
        took = {}
        for y, (d, x) in near.items():
            if d <= radius**2 and d == min(e for e, z in near.values() if z == x) and now[x][1] == now[y][1]:
                took[x] = min(y, took.get(x, y))
        for x, y in took.items():
            now[x][2:] = [(now[x][2] + now[y][2]) / 2, (now[x][3] + now[y][3]) / 2]
        for y in took.values():
            del now[y]
    return now


@pytest.mark.parametrize("links", [[(0, 1), (1, 2), (2, 3), (3, 4)], [(a, b) for a in range(9) for b in (a + 1, a + 3) if b < 9 and (b - a == 3 or b % 3)]])
def test_merging_over_all_pairs_is_the_sequence(spark, links):
    rng = random.Random(len(links))
    points = {i: [rng.randrange(9), rng.choice("gh"), rng.randrange(80) / 4, rng.randrange(80) / 4] for i in range(700)}
    rects = spark.createDataFrame([(a, b, 0.0, 18.0 - a, 1.0, 20.0 if b != 3 else 2.0) for a, b in links], "a int, b int, r_tl double, r_br double, c_tl double, c_br double")
    order = [tuple(r) for c in graphs.edge_colours(rects) for r in c.select("a", "b", "r_tl", "r_br", "c_tl", "c_br").collect()]
    assert len(order) == len(links)
    df = spark.createDataFrame([(i, *v) for i, v in points.items()], "dot_id int, fov_num int, gene string, r double, c double")
    got = {r["dot_id"]: [r["fov_num"], r["gene"], r["r"], r["c"]] for r in spatial.merge_overlaps(df, rects, 1.0, RC, identity="gene").collect()}
    want = merged_plainly(points, order, 1.0, 10)
    assert got == want and len(want) < len(points)


def test_counts_in_chunks(spark):
    df = points(spark, [(1, 0.0, 0.0), (2, 99.0, 45.5), (3, 39.0, 39.9), (4, 41.0, 80.0), (5, 80.0, 5.0)], "id int, r double, c double")
    got = sorted(map(tuple, geometry.count_in_chunks(df, 40).collect()))
    assert got == [(0, 40, 0, 40, 2), (40, 100, 0, 40, 1), (40, 100, 40, 81, 2)]


def test_nearest_k_within_is_k_nearest_cut(spark):
    points = spark.createDataFrame([(i, float(i * 37 % 101), float(i * 53 % 97)) for i in range(60)], "id int, r double, c double")
    want = {tuple(x) for x in spatial.k_nearest(points, 4, ("r", "c"), "id").filter("d2 < 400").collect()}
    assert {tuple(x) for x in spatial.nearest_k_within(points, 4, 20.0, ("r", "c"), "id").collect()} == want and want


def test_long_codes_are_an_error(spark):
    codes = spark.createDataFrame([(1, 3)], "ref int, code_bits long")
    with pytest.raises(ValueError):
        barcodes.nearest_codeword(codes, spark.createDataFrame([("g", 3, 0)], "gene string, code_bits long, code_idx int"), 65)


def test_chunked_arrays_are_written_read_and_pruned(spark, tmp_path):
    rng = np.random.default_rng(3)
    stacks = {(f, c, k): rng.integers(0, 60_000, (3, 50, 70)).astype("uint16") for f in (1, 2) for c in ("a", "b") for k in (1, 2)}
    rows = [(f, c, k, list(x.shape), "uint16", bytearray(x.tobytes())) for (f, c, k), x in stacks.items()]
    path = str(tmp_path / "store")
    chunks.write(spark.createDataFrame(rows, PIXELS), path, "1,32,0")
    back = chunks.read(spark, path)
    found = {key: np.zeros((3, 50, 70), "uint16") for key in stacks}
    for r in back.collect():
        part = np.frombuffer(r["pixels"], r["dtype"]).reshape(r["shape"])
        found[r["fov_num"], r["channel"], r["round_num"]][tuple(slice(o, o + n) for o, n in zip(r["origin"], r["shape"]))] = part
    assert all((found[k] == x).all() for k, x in stacks.items())
    assert back.rdd.getNumPartitions() == 8 * 3 * 2
    some = back.filter("fov_num = 2 AND channel IN ('b') AND round_num >= 2")
    assert some.rdd.getNumPartitions() == 3 * 2 and some.count() == 6
    assert back.filter("fov_num = 2 AND chunk = '0.1.0' AND dtype = 'uint16'").rdd.getNumPartitions() == 4
    assert back.filter("fov_num = 9").count() == 0
    # without pixels no chunk is opened
    lost = tmp_path / "store" / "1_a_1" / "pixels" / "0.0.0"
    lost.write_bytes(b"broken")
    assert chunks.read(spark, path, "fov_num int, chunk string").count() == 48
    with pytest.raises(Exception):
        back.collect()
    # an absent chunk is zeros; appended images stand beside the others, written again they are replaced
    lost.unlink()
    first = back.filter("grp_name = '1_a_1' AND chunk = '0.0.0'").first()
    assert not np.frombuffer(first["pixels"], "uint16").any()
    more = [(1, "a", 1, [2, 2], "float64", bytearray(np.eye(2).tobytes())), (7, "a", 1, [2, 2], "float64", bytearray(np.eye(2).tobytes()))]
    chunks.write(spark.createDataFrame(more, PIXELS), path, "0", packed=False, mode="append")
    again = chunks.read(spark, path)
    assert again.select("grp_name").distinct().count() == 9
    assert sorted((r["fov_num"], tuple(r["at"]), r["value"]) for r in chunks.sparse(again.filter("dtype = 'float64'")).collect()) == [(f, (i, i), 1.0) for f in (1, 7) for i in (0, 1)]


@pytest.mark.parametrize("diagonal", [True, False])
def test_objects_and_peaks_on_sparse_pixels(spark, monkeypatch, diagonal):
    monkeypatch.setattr(detection, "STRIP", 3)
    rng = np.random.default_rng(5)
    images_ = {k: np.where(rng.random((30, 40)) < 0.45, rng.integers(1, 9, (30, 40)), 0) for k in (1, 2)}
    rows = [(k, int(r), int(c), int(x[r, c])) for k, x in images_.items() for r, c in np.argwhere(x)]
    want = []
    for k, x in images_.items():
        label, left = {}, {tuple(at) for at in np.argwhere(x)}
        while left:
            stack, group = [min(left)], set()
            while stack:
                r, c = stack.pop()
                if (r, c) in left:
                    left.discard((r, c))
                    group.add((r, c))
                    stack += [(r + i, c + j) for i in (-1, 0, 1) for j in (-1, 0, 1) if diagonal or not (i and j)]
            if 2 <= len(group) <= 30:
                top = [(r, c) for r, c in group if 2 <= r < 28 and 2 <= c < 38 and x[r, c] >= max(x[p] for p in group if max(abs(p[0] - r), abs(p[1] - c)) <= 2)]
                want += [(k, r, c, int(x[r, c]), len(group)) for r, c in sorted(top, key=lambda p: (-x[p], p))[:2]]
    df = spark.createDataFrame(rows, "image int, r int, c int, value int")
    got = detection.peaks(df, ["image"], 2, 2, 30, per_object=2, frame=(30, 40), diagonal=diagonal)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert detection.peaks(df.limit(0), ["image"], 2, 2, 30).count() == 0


def test_images_are_made_and_written_by_chunks(spark, tmp_path):
    rng = np.random.default_rng(4)
    shape = (70, 45)
    dots = {(int(f), int(r), int(c)): int(n) for f, r, c, n in zip(rng.integers(0, 2, 150), rng.integers(0, 40, 150), rng.integers(0, 45, 150), rng.integers(1, 9, 150))}
    dots[0, 69, 44] = 3
    pixels = spark.createDataFrame([(f, "a", 1, *at, n) for (f, *at), n in dots.items()], "fov_num int, channel string, round_num int, r int, c int, n long")
    by = ["fov_num", "channel", "round_num"]
    pieces = images.from_sparse(pixels, by, shape, chunk=(16, 20))
    assert all(len(p["pixels"]) <= 16 * 20 * 2 and p["whole"] == list(shape) for p in pieces.collect())
    path = str(tmp_path / "pieces")
    chunks.write(pieces, path, "16,20")
    chunks.write(images.from_sparse(pixels, by, shape), str(tmp_path / "whole"), "16,20")
    place = ["fov_num", "chunk", "origin", "shape"]
    back, whole = (chunks.read(spark, p).select(*place, "pixels").collect() for p in (path, str(tmp_path / "whole")))
    assert len(back) == 2 * 5 * 3 and sorted(back) == sorted(whole)
    assert {(r["fov_num"], *r["at"]): int(r["value"]) for r in chunks.sparse(chunks.read(spark, path)).collect()} == dots
    with pytest.raises(Exception, match="cut between chunks"):
        chunks.write(pieces, str(tmp_path / "bad"), "16,16")


@pytest.mark.parametrize("cells", [1, 3])
def test_matches_of_equal_and_of_close_signatures(spark, cells):
    rng = random.Random(8)
    sign = lambda: tuple(sorted(rng.randrange(33) / 8 for _ in range(3)))
    some, others = ({f"{side}{i:03}": (i % 2, sign()) for i in range(150)} for side in "ab")
    made = lambda x: spark.createDataFrame([(f, i, 1.0, 2.0, list(s)) for i, (f, s) in x.items()], "fov int, id string, r double, c double, signature array<double>")
    # 30,000 equal ones on each side, which would be 9e8 pairs
    crowd = lambda side: spark.range(30_000).selectExpr("7 AS fov", f"concat('{side}', lpad(id, 6, '0')) AS id", "1D AS r", "2D AS c", "array(90D, 91D, 92D) AS signature")
    got = constellations.matches(made(some).union(crowd("a")), made(others).union(crowd("b")), 0.5, "id", ["fov"], ("r", "c"), cells).collect()
    want = {}
    for i, (f, s) in some.items():
        near = [(sum(d), j) for j, (g, t) in others.items() if g == f and max(d := [abs(x - y) for x, y in zip(s, t)]) <= 0.5]
        if near:
            want[i] = min(near)
    assert {r["id"]: (r["total"], r["r_id"]) for r in got if r["fov"] != 7} == want and len(want) > 20
    assert {(r["r_id"], r["total"]) for r in got if r["fov"] == 7} == {("b000000", 0.0)} and len(got) == len(want) + 30_000
