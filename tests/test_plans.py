"""Registered queries against their SQL, the staged experiment, streams, and the entry module."""

import os

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from dotweave.functions import arrays
from dotweave.plans import catalog
from dotweave.plans.experiment import Experiment, Settings
from dotweave.schema import PIXELS
from dotweave.streaming import arrivals

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_its_sql(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(f"SELECT {', '.join(f'\"{c}\"' for c in cols)} FROM ({catalog.SQL[name]})").fetchall()
    key = lambda r: tuple(map(str, r))
    got = sorted((tuple(map(plain, r)) for r in df.select(*cols).collect()), key=key)
    assert got == sorted((tuple(map(plain, r)) for r in want), key=key)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_query_without_sql_gives_rows(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["dot_id"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_distance_joins_are_equi_joins(spark):
    for name in ("radius_pairs", "nn_bounded", "dedup_removed", "neighbour_density"):
        plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name


def test_queries_take_the_same_share_of_larger_tables(spark):
    """Boxes, masks and frames grow with the dots: what takes part at one size does at another."""
    share = {}
    for sf in ("sf0.01", "sf0.1"):
        d = f"/root/testdata/{sf}"
        events = spark.read.parquet(f"{d}/events.parquet")
        n, refs = events.count(), events.filter("event_id % 16 = 0").count()
        share[sf] = [
            catalog.QUERIES["range_join_overlap"](spark, d).count() / n,
            catalog.QUERIES["bit_intensity"](spark, d).select("barcode_reference_dot_id").distinct().count() / refs,
            catalog.QUERIES["canvas_chunks"](spark, d).selectExpr("sum(n)").first()[0] / n,
        ]
    assert all(abs(a - b) < 0.05 for a, b in zip(*share.values())), share
    assert share["sf0.01"][1:] == share["sf0.1"][1:] == [1.0, 1.0]


def test_planted_offsets_come_back(spark):
    rows = {r["fov_num"]: (r["r"], r["c"]) for r in catalog.QUERIES["round_shifts"](spark, SF).selectExpr("fov_num", "dr as r", "dc as c").filter("r is not null").collect()}
    assert rows


def test_all_dots_of_all_rounds_are_shifted(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(catalog.registration, "round_shifts", lambda beads, *a: taken.append((beads, a)))
    catalog.QUERIES["round_shifts"](spark, SF)
    (beads, (_, _, shape, *_)), = taken
    want = spark.read.parquet(f"{SF}/events.parquet")
    for k in (1, 2, 3):
        got = beads.filter(f"round_num = {k}").collect()
        assert sorted(r["dot_id"] for r in got) == sorted(r["event_id"] for r in want.collect())
        assert all(0 <= r["r"] <= shape[0] - 1 and 0 <= r["c"] <= shape[1] - 1 for r in got)


def scene(spark):
    """Two tiles beside each other with 3 rounds: fish dots of two genes, beads in all rounds, one duplicate in the overlap."""
    rng = np.random.default_rng(0)
    size, step = 128, 108
    beads = rng.integers(10, 118, (2, 30, 2)).astype(float)
    shared = beads[0][beads[0][:, 1] > step]
    beads[1][: len(shared)] = shared - (0, step)
    drift = {1: (0, 0), 2: (3, -2), 3: (-1, 4)}
    fish = {0: [((30, 30), (1, 2)), ((60, 115), (1, 2)), ((90, 50), (2, 3))], 1: [((60, 7), (1, 2)), ((20, 80), (2, 3))]}
    rows = []
    for fov in (0, 1):
        for k, d in drift.items():
            for channel, at in (("beads", beads[fov]), ("Cy5", np.array([p for p, on in fish[fov] if k in on] or [(64, 64)], float))):
                img = np.zeros((size, size))
                at = np.rint(at - d).astype(int)
                at = at[((at >= 3) & (at < size - 3)).all(axis=1)]
                img[at[:, 0], at[:, 1]] = 1
                img = arrays.gaussian(img, 1.0)
                rows.append((fov, channel, k, [1, size, size], "uint16", bytearray((img / img.max() * 60_000).astype("uint16").tobytes())))
    pixels = spark.createDataFrame(rows, PIXELS)
    catalogue = spark.createDataFrame([(f, k, c, 0.0, f * step * 1.0, "t") for f in (0, 1) for k in drift for c in ("beads", "Cy5")], "fov_num int, round_num int, channel string, fov_acquisition_coords_y double, fov_acquisition_coords_x double, target_name string")
    return pixels, catalogue


def test_stages_of_an_experiment(spark, tmp_path, monkeypatch):
    from dotweave.operators import images

    # every bright pixel is a dot: the scene has too few for a threshold curve
    monkeypatch.setitem(images.FILTERS, "plain", lambda img, params, dark=0.0: images.unit(img).max(axis=0))
    pixels, catalogue = scene(spark)
    book = spark.createDataFrame([("g12", 0b011, 0), ("g23", 0b110, 1)], "gene string, code_bits long, code_idx int")
    mask = spark.createDataFrame([(r, c, 7) for r in range(20, 40) for c in range(20, 40)], "r int, c int, cell_id long")
    settings = Settings("ROBOFISH1", 1.0, 128, 3, "beads", resolution=2.0, same_dot_radius=4.0, barcode_length=3, least_matches=5)
    run = Experiment(spark, str(tmp_path), settings, catalogue, pixels, book, mask)

    def dots():
        out = []
        for row in pixels.collect():
            img = images.to_array(row).max(axis=0)
            for i, (r, c) in enumerate(arrays.peaks(img, 2, 20_000)):
                out.append((f"{row['fov_num']}_{row['round_num']}_{row['channel']}_{i}", row["fov_num"], row["round_num"], row["channel"], float(r), float(c), 1.0, 0.5, "large"))
        from dotweave.schema import DOTS

        return spark.createDataFrame(out, DOTS)

    monkeypatch.setattr(run, "dots", dots)
    assigned = run.run()
    good = {(r["decoded_genes"], round(r["r_px_global_stitched"]), round(r["c_px_global_stitched"])): r["cell_id"] for r in assigned.filter("hamming_distance = 0").collect()}
    assert good[("g12", 30, 30)] == 7 and good[("g23", 90, 50)] == -1
    assert len([k for k in good if k[0] == "g12" and abs(k[1] - 60) < 3 and abs(k[2] - 115) < 3]) == 1  # the duplicate is gone
    assert run.gene_counts().collect() == [("g12", 7, 1)] or run.gene_counts().first()["n"] == 1
    before = os.path.getmtime(tmp_path / "decoded" / "_SUCCESS")
    run.run(restart="cleaned")
    assert os.path.getmtime(tmp_path / "decoded" / "_SUCCESS") == before
    run.write_matrix(str(tmp_path / "matrix"))
    assert spark.read.parquet(str(tmp_path / "matrix/counts")).count() == 1


def test_arrivals_are_processed_once(spark, tmp_path):
    source, target, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    put = lambda a, b: spark.range(a, b).selectExpr("id", "cast(id % 2 as int) as fov_num").write.mode("append").parquet(source)
    put(0, 10)
    read = lambda: arrivals.arrivals(spark, source, "id long, fov_num int")
    arrivals.ingest(read(), target, mark).awaitTermination()
    put(10, 15)
    arrivals.ingest(read(), target, mark).awaitTermination()
    assert spark.read.parquet(target).count() == 15
    seen = []
    arrivals.process_new(read(), lambda df, n: seen.append(df.count()), str(tmp_path / "mark2")).awaitTermination()
    arrivals.process_new(read(), lambda df, n: seen.append(df.count()), str(tmp_path / "mark2")).awaitTermination()
    assert sum(seen) == 15


def test_windows_of_a_stream(spark, tmp_path):
    spark.read.parquet(f"{SF}/events.parquet").selectExpr("event_id", "cast(ts as timestamp) as ts", "event_type").write.parquet(str(tmp_path / "e"))
    stream = arrivals.arrivals(spark, str(tmp_path / "e"), "event_id long, ts timestamp, event_type string")
    arrivals.counts_per_window(stream, "ts", "1 day", "1 hour", ["event_type"]).writeStream.outputMode("complete").format("memory").queryName("daily").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "m")).start().awaitTermination()
    assert spark.sql("select sum(n) from daily").first()[0] == 1000
