"""Every registered query of the point-analytics operators, with its SQL twin.

The tables at hand stand in for microscopy: events are dots (gene: event_type, row: user_id, column: value cut
to quarters, round and tile from event_id), suppliers are tiles on a grid, parts a codebook, line items images.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import codes
from ..functions.lineage import shared_dir
from ..operators import affine, alignment, barcodes, bayes, cells, constellations, dedup, detection, geometry, images, quality, registration, selection, spatial
from ..sources import chunks

RC = ("r", "c")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dots(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    return _table(spark, sf_dir, "events").select(
        e.alias("dot_id"), F.col("event_type").alias("gene"), F.col("user_id").cast("double").alias("r"), (F.floor(F.col("value") * 4) / 4.0).alias("c"),
        (e % 16 + 1).cast("int").alias("round_num"), (e % 6).cast("int").alias("fov_num"), F.concat(F.lit("ch"), (F.floor(e / 16) % 2).cast("string")).alias("channel"),
    )


_DOTS = """dots AS (SELECT event_id AS dot_id, event_type AS gene, CAST(user_id AS DOUBLE) AS r, floor(value * 4) / 4.0 AS c,
  CAST(event_id % 16 + 1 AS INT) AS round_num, CAST(event_id % 6 AS INT) AS fov_num, 'ch' || CAST((event_id // 16) % 2 AS VARCHAR) AS channel FROM events)"""


def _tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers on a grid of 10 columns with 92 pixels between tiles of 100."""
    k = F.col("s_suppkey")
    return _table(spark, sf_dir, "supplier").select(k.cast("int").alias("fov_num"), (F.floor(k / 10) * 92.0).alias("r"), (k % 10 * 92.0).alias("c"))


_TILES = "tiles AS (SELECT CAST(s_suppkey AS INT) AS fov_num, (s_suppkey // 10) * CAST(92.0 AS DOUBLE) AS r, (s_suppkey % 10) * CAST(92.0 AS DOUBLE) AS c FROM supplier)"

#: Rows of the canvas of dots.
_HIGH = "(SELECT max(user_id) + 1 FROM events)"


#: Side of a square image that holds all dots.
_SQUARE = "(SELECT CAST(greatest(max(user_id), floor(max(value))) AS INT) + 1 FROM events)"


def _high(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: the number of rows of the canvas of dots."""
    return F.broadcast(_table(spark, sf_dir, "events").agg((F.max("user_id") + 1).alias("high")))


#: Overlaps of the six tiles that dots fall in, in a chain: boxes on a canvas of 150 rows, stretched to the rows of the dots.
_RECT_ROWS = [(0, 1, 10.0, 60.0, 5.0, 60.0), (1, 2, 0.0, 100.0, 20.0, 50.0), (2, 3, 30.0, 120.0, 0.0, 30.0), (3, 4, 5.0, 90.0, 10.0, 100.0), (4, 5, 20.0, 149.0, 40.0, 80.0)]
_RECTS = (
    f"rects AS (SELECT a, b, r0 * {_HIGH} / 150 AS r_tl, r1 * {_HIGH} / 150 AS r_br, c_tl, c_br, a_row, a_column FROM (VALUES "
    + ", ".join(f"({a}, {b}, {w}::DOUBLE, {x}::DOUBLE, {y}::DOUBLE, {z}::DOUBLE, '{'top' if a % 2 == 0 else 'bottom'}', '{'left' if a % 3 else 'right'}')" for a, b, w, x, y, z in _RECT_ROWS)
    + ") v(a, b, r0, r1, c_tl, c_br, a_row, a_column))"
)


def _rects(spark: SparkSession, sf_dir: str) -> DataFrame:
    high = _high(spark, sf_dir).first()["high"]
    rows = [(a, b, r0 * high / 150, r1 * high / 150, c0, c1, "top" if a % 2 == 0 else "bottom", "left" if a % 3 else "right") for a, b, r0, r1, c0, c1 in _RECT_ROWS]
    return spark.createDataFrame(rows, "a int, b int, r_tl double, r_br double, c_tl double, c_br double, a_row string, a_column string")


def _codebook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen-bit words for every kind of part (brand and type), from its first part."""
    kinds = _table(spark, sf_dir, "part").groupBy(F.concat_ws(" ", "p_brand", "p_type").alias("gene")).agg(F.min("p_partkey").alias("code_idx"))
    return kinds.select("gene", ((F.col("code_idx") * 40503 + 977) % 65536).alias("code_bits"), "code_idx")


_BOOK = "book AS (SELECT p_brand || ' ' || p_type AS gene, (min(p_partkey) * 40503 + 977) % 65536 AS code_bits, min(p_partkey) AS code_idx FROM part GROUP BY 1)"
#: Dots of a user in a strip of eight columns are one barcode: one bit a round.
_BITS = "bits AS (SELECT CAST(r AS BIGINT) * 1000 + CAST(floor(c / 8) AS BIGINT) AS ref, bit_or(CAST(1 AS BIGINT) << (round_num - 1)) AS code_bits FROM dots GROUP BY 1)"


def _bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return barcodes.barcode_bits(_dots(spark, sf_dir).withColumn("ref", F.col("r").cast("bigint") * 1000 + F.floor(F.col("c") / 8)), "ref")


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return barcodes.nearest_codeword(_bits(spark, sf_dir), _codebook(spark, sf_dir))


_DECODED = """decoded AS (SELECT ref, b.code_bits, k.gene AS decoded_genes, k.code_bits AS codeword_bits, bit_count(xor(b.code_bits, k.code_bits)) / 16.0 AS hamming_distance,
  CAST(bit_count(b.code_bits) AS BIGINT) AS number_positive_bits FROM bits b, book k
  QUALIFY row_number() OVER (PARTITION BY ref ORDER BY bit_count(xor(b.code_bits, k.code_bits)), code_idx) = 1)"""


def _mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels of cells: orders stand for pixels, each label an id of a customer."""
    o = F.col("o_orderkey")
    pixels = _table(spark, sf_dir, "orders").crossJoin(_high(spark, sf_dir))
    return pixels.groupBy((o % F.col("high")).alias("r"), (F.floor(o / F.col("high")) % 100).alias("c")).agg(F.min(F.col("o_custkey") % 50 + 1).alias("cell_id"))


_MASK = f"mask AS (SELECT o_orderkey % {_HIGH} AS r, (o_orderkey // {_HIGH}) % 100 AS c, min(o_custkey % 50 + 1) AS cell_id FROM orders GROUP BY 1, 2)"


def _pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of two neighbouring tiles that share pixels: line items."""
    k = F.col("l_partkey")
    return _table(spark, sf_dir, "lineitem").select(
        (F.col("l_linenumber") % 2).alias("fov_num"), F.concat_ws("-", (F.col("l_linenumber") % 2).cast("string"), (F.col("l_suppkey") % 7).cast("string")).alias("obj_id"),
        (k % 40).cast("int").alias("r"), F.col("l_quantity").cast("int").alias("c"),
    ).distinct()


_PIXELS = "pixels AS (SELECT DISTINCT l_linenumber % 2 AS fov_num, CAST(l_linenumber % 2 AS VARCHAR) || '-' || CAST(l_suppkey % 7 AS VARCHAR) AS obj_id, CAST(l_partkey % 40 AS INT) AS r, CAST(l_quantity AS INT) AS c FROM lineitem)"

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    """Register a function under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# selections


@_query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey BETWEEN 100 AND 700")
def select_range(spark, d):
    return selection.fov_range(_table(spark, d, "orders"), 100, 700, "o_custkey").select("o_orderkey", "o_custkey")


@_query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (3, 5, 8, 13, 21)")
def select_in(spark, d):
    return selection.fov_list(_table(spark, d, "orders"), [3, 5, 8, 13, 21], "o_custkey").select("o_orderkey", "o_custkey")


@_query("SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_discount > 0.08)")
def select_in_table(spark, d):
    named = _table(spark, d, "lineitem").filter("l_discount > 0.08").select(F.col("l_partkey").alias("p_partkey"))
    return selection.fov_list(_table(spark, d, "part"), named, "p_partkey").select("p_partkey", "p_name")


@_query(f"WITH {_DOTS} SELECT dot_id, gene, r, c FROM dots WHERE channel = 'ch1' AND round_num = 3 AND fov_num = 2")
def select_point(spark, d):
    return selection.one_image(_dots(spark, d), "ch1", 3, 2).select("dot_id", "gene", "r", "c")


@_query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def resume_anti(spark, d):
    done = _table(spark, d, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return selection.not_processed(_table(spark, d, "customer"), done, "c_custkey").select("c_custkey", "c_name")


@_query(
    f"WITH {_DOTS} SELECT CAST(count(DISTINCT channel) AS BIGINT) AS channels, CAST(count(DISTINCT fov_num) AS BIGINT) AS fovs, CAST(max(round_num) AS BIGINT) AS rounds, arg_min(gene, dot_id) AS first_gene FROM dots"
)
def metadata_collect(spark, d):
    row = quality.metadata_row(_dots(spark, d), ["dot_id"], ["gene"])
    return row.select(F.size("channels").cast("long").alias("channels"), F.size("fovs").cast("long").alias("fovs"), F.col("rounds").cast("long").alias("rounds"), F.col("gene").alias("first_gene"))


@_query(f"WITH {_DOTS} SELECT fov_num, dot_id, c FROM dots QUALIFY row_number() OVER (PARTITION BY fov_num ORDER BY c, round_num, dot_id) = 1")
def qc_min_per_group(spark, d):
    return quality.worst_registration(_dots(spark, d), "fov_num", "c", ["round_num", "dot_id"]).select("fov_num", "dot_id", "c")


@_query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 1000 AND o_totalprice < 50000 AND o_custkey > 10 AND o_custkey < 500")
def box_strict(spark, d):
    box = tuple(map(F.lit, (1000, 50000, 10, 500)))
    return _table(spark, d, "orders").filter(selection.in_box(F.col("o_totalprice"), F.col("o_custkey"), box, True)).select("o_orderkey", "o_totalprice")


@_query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 AND l_linenumber BETWEEN 2 AND 4")
def box_inclusive(spark, d):
    box = tuple(map(F.lit, (10, 20, 2, 4)))
    return _table(spark, d, "lineitem").filter(selection.in_box(F.col("l_quantity"), F.col("l_linenumber"), box, False)).select("l_orderkey", "l_linenumber")


@_query(f"WITH {_DOTS} SELECT dot_id, fov_num || '_' || round_num || '_' || channel || '_' || (row_number() OVER (PARTITION BY fov_num, round_num, channel ORDER BY dot_id) - 1) AS name FROM dots")
def dot_names(spark, d):
    named = selection.with_dot_id(_dots(spark, d).withColumnRenamed("dot_id", "n"), ["n"])
    return named.select(F.col("n").alias("dot_id"), F.col("dot_id").alias("name"))


@_query("SELECT c_custkey AS k, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def union_outer(spark, d):
    a = _table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = _table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))
    return selection.union_outer([a, b])


@_query("SELECT o_orderkey, CAST(least(o_orderkey // 64, (SELECT count(*) FROM orders) // 64 - 1) AS BIGINT) AS chunk FROM orders")
def chunk_batches(spark, d):
    rows = _table(spark, d, "orders").select("o_orderkey")
    return selection.batches(rows, "o_orderkey", 64, rows.count()).select("o_orderkey", F.col("chunk").cast("bigint").alias("chunk"))


@_query("SELECT gene, bool_or(c IS NULL) AS has_null FROM (SELECT event_type AS gene, CASE WHEN event_type = 'click' AND event_id % 1000 = 7 THEN NULL ELSE value END AS c FROM events) GROUP BY gene")
def null_guard(spark, d):
    rows = _table(spark, d, "events").select(F.col("event_type").alias("gene"), F.when(~((F.col("event_type") == "click") & (F.col("event_id") % 1000 == 7)), F.col("value")).alias("c"))
    return selection.any_null(rows, "c", ["gene"])


@_query(f"WITH {_DOTS}, {_BITS}, {_BOOK}, {_DECODED} SELECT ref, decoded_genes FROM decoded WHERE hamming_distance < 0.25 AND decoded_genes IS NOT NULL")
def plotting_extract(spark, d):
    return selection.plotting_extract(_decoded(spark, d), 0.25, ["ref", "decoded_genes"])


@_query(f"WITH {_DOTS} SELECT d.dot_id, o.s_name AS target FROM dots d LEFT JOIN (SELECT CAST(s_suppkey % 6 AS INT) AS fov_num, 'ch' || (s_suppkey // 6) % 2 AS channel, CAST(s_suppkey // 12 + 1 AS INT) AS round_num, s_name FROM supplier) o USING (fov_num, channel, round_num)")
def metadata_join(spark, d):
    k = F.col("s_suppkey")
    images = _table(spark, d, "supplier").select((k % 6).cast("int").alias("fov_num"), F.concat(F.lit("ch"), (F.floor(k / 6) % 2).cast("string")).alias("channel"), (F.floor(k / 12) + 1).cast("int").alias("round_num"), F.col("s_name").alias("target"))
    return selection.with_metadata(_dots(spark, d), images).select("dot_id", "target")


@_query(f"WITH {_DOTS} SELECT dot_id FROM dots WHERE r > 20 AND r < 80 AND c > 20 AND c < 80 AND dot_id % 5 <= 2")
def interior_dots(spark, d):
    rows = _dots(spark, d).withColumn("hamming_distance", F.col("dot_id") % 5 / 16)
    return selection.interior(rows, "r", "c", 20, 100).select("dot_id")


@_query(f"WITH {_DOTS} SELECT dot_id FROM dots WHERE channel <> 'ch0' AND dot_id % 5 < 3")
def valid_rna(spark, d):
    rows = _dots(spark, d).withColumn("hamming_distance", F.col("dot_id") % 5 / 16)
    return selection.valid_rna(rows, "ch0", 3 / 16).select("dot_id")


@_query(f"WITH {_DOTS} SELECT dot_id FROM dots WHERE channel = 'ch0' AND dot_id % 3 = 0 AND round_num = 1 AND dot_id % 7 <> 0")
def large_beads(spark, d):
    k = F.col("dot_id")
    rows = _dots(spark, d).withColumns({"mapped_beads_type": F.when(k % 3 == 0, "large").otherwise("small"), "c": F.when(k % 7 != 0, F.col("c"))})
    return selection.large_beads(rows, "ch0", ["r", "c"]).select("dot_id")


@_query(f"WITH {_DOTS} SELECT dot_id FROM dots WHERE channel = 'ch1' AND dot_id % 2 = 0 AND dot_id % 5 IN (1, 2)")
def flip_candidates(spark, d):
    k = F.col("dot_id")
    rows = _dots(spark, d).withColumns({"hamming_distance": k % 5 / 16, "barcode_reference_dot_id": k + k % 2})
    return selection.flip_candidates(rows, "ch1", 16).select("dot_id")


@_query(f"WITH {_DOTS} SELECT dot_id, CASE WHEN channel = 'ch0' THEN 'beads' ELSE gene END AS gene FROM dots")
def literal_overwrite(spark, d):
    return selection.overwrite(_dots(spark, d), {"gene": "beads"}, F.col("channel") == "ch0").select("dot_id", "gene")


@_query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) = 1")
def first_of_each(spark, d):
    return selection.first_of(_table(spark, d, "lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey"]).select("l_orderkey", "l_linenumber", "l_partkey")


@_query("SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 45)")
def singletons(spark, d):
    matched = _table(spark, d, "lineitem").filter("l_quantity >= 45").select(F.col("l_partkey").alias("p_partkey"))
    return selection.singletons(_table(spark, d, "part"), matched, "p_partkey").select("p_partkey")


# distance joins


@_query(f"WITH {_DOTS} SELECT x.dot_id AS a, y.dot_id AS b FROM dots x JOIN dots y ON x.gene = y.gene AND x.dot_id < y.dot_id AND (x.r - y.r) * (x.r - y.r) + (x.c - y.c) * (x.c - y.c) <= 1")
def radius_pairs(spark, d):
    p = _dots(spark, d).select("dot_id", "gene", "r", "c")
    pairs = spatial.radius_join(p, p, 1.0, RC, RC, ["gene"])
    return pairs.filter("dot_id < r_dot_id").select(F.col("dot_id").alias("a"), F.col("r_dot_id").alias("b"))


@_query(
    f"WITH {_DOTS} SELECT x.dot_id AS a, y.dot_id AS b FROM dots x JOIN dots y ON x.round_num <> 1 AND y.round_num = 1 AND (x.r - y.r) * (x.r - y.r) + (x.c - y.c) * (x.c - y.c) <= 4 QUALIFY row_number() OVER (PARTITION BY x.dot_id ORDER BY (x.r - y.r) * (x.r - y.r) + (x.c - y.c) * (x.c - y.c), y.dot_id) = 1"
)
def nn_bounded(spark, d):
    p = _dots(spark, d)
    near = spatial.nearest_within(p.filter("round_num <> 1").select("dot_id", "r", "c"), p.filter("round_num = 1").select("dot_id", "r", "c"), 2.0, RC, RC, "dot_id", "dot_id")
    return near.select(F.col("dot_id").alias("a"), F.col("r_dot_id").alias("b"))


@_query(f"WITH {_DOTS} SELECT gene, count(*) AS n_match FROM dots x WHERE round_num <> 1 AND EXISTS (SELECT 1 FROM dots y WHERE y.round_num = 1 AND y.gene = x.gene AND (x.r - y.r) * (x.r - y.r) + (x.c - y.c) * (x.c - y.c) <= 4) GROUP BY gene")
def radius_match_count(spark, d):
    p = _dots(spark, d)
    return spatial.match_count(p.filter("round_num <> 1").select("dot_id", "gene", "r", "c"), p.filter("round_num = 1").select("dot_id", "gene", "r", "c"), 2.0, RC, RC, "dot_id", ["gene"])


@_query(f"WITH {_DOTS} SELECT x.dot_id, count(*) AS neighbours FROM dots x JOIN dots y ON (x.r - y.r) * (x.r - y.r) + (x.c - y.c) * (x.c - y.c) <= 1 GROUP BY x.dot_id")
def neighbour_density(spark, d):
    return spatial.neighbour_count(_dots(spark, d), 1.0, RC, "dot_id")


@_query(f"WITH {_DOTS} SELECT x.dot_id FROM dots x JOIN dots y ON (x.r - y.r) * (x.r - y.r) + (x.c - y.c) * (x.c - y.c) <= 1 GROUP BY x.dot_id HAVING count(*) < 4")
def drop_crowded(spark, d):
    return spatial.drop_crowded(_dots(spark, d), 1.0, RC, "dot_id", 4).select("dot_id")


#: Each tile of the chain with the next: dots of the first side and of the second, by the number of the pair.
_PAIRED = "a AS (SELECT *, fov_num AS pair FROM dots WHERE fov_num < 5), b AS (SELECT *, fov_num - 1 AS pair FROM dots WHERE fov_num > 0)"


def _paired(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p, fov = _dots(spark, sf_dir), F.col("fov_num")
    return p.filter(fov < 5).withColumn("pair", fov), p.filter(fov > 0).withColumn("pair", fov - 1)


@_query(
    f"""WITH {_DOTS}, {_PAIRED},
near AS (SELECT a.pair, b.dot_id AS kb, a.dot_id AS ka, a.gene AS ga, b.gene AS gb, (a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c) AS d2 FROM a JOIN b ON a.pair = b.pair AND (a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c) <= 9
  QUALIFY row_number() OVER (PARTITION BY b.dot_id ORDER BY (a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c), a.dot_id) = 1),
best AS (SELECT * FROM near QUALIFY rank() OVER (PARTITION BY ka ORDER BY d2) = 1)
SELECT pair, ka AS key_a, kb AS key_b, d2 FROM best WHERE ga = gb QUALIFY row_number() OVER (PARTITION BY ka ORDER BY kb) = 1"""
)
def mutual_match(spark, d):
    a, b = _paired(spark, d)
    return spatial.mutual_matches(a, b, 3.0, RC, "dot_id", "gene", on=["pair"]).select("pair", "key_a", "key_b", "d2")


@_query(
    f"WITH {_DOTS}, {_PAIRED} SELECT pair, count(*) AS pairs, sum(b.r - a.r) AS sum_dr, sum(b.c - a.c) AS sum_dc FROM a JOIN b USING (pair) WHERE (a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c) <= 25 GROUP BY pair"
)
def neighbour_offsets(spark, d):
    off = spatial.neighbour_offsets(*_paired(spark, d), 5.0, RC, ["pair"])
    return off.groupBy("pair").agg(F.count("*").alias("pairs"), F.sum("dr").alias("sum_dr"), F.sum("dc").alias("sum_dc"))


# tiles


@_query(f"WITH {_TILES} SELECT x.fov_num AS a, y.fov_num AS b, (x.r - y.r) * (x.r - y.r) + (x.c - y.c) * (x.c - y.c) AS d2 FROM tiles x JOIN tiles y ON x.fov_num <> y.fov_num QUALIFY row_number() OVER (PARTITION BY x.fov_num ORDER BY (x.r - y.r) * (x.r - y.r) + (x.c - y.c) * (x.c - y.c), y.fov_num) <= 4")
def knn_adjacency(spark, d):
    return spatial.k_nearest(_tiles(spark, d), 4, RC, "fov_num").select("a", "b", "d2")


_ADJ = """near AS (SELECT x.fov_num AS a, y.fov_num AS b, (x.r - y.r) * (x.r - y.r) + (x.c - y.c) * (x.c - y.c) AS d2 FROM tiles x JOIN tiles y ON x.fov_num <> y.fov_num
  QUALIFY row_number() OVER (PARTITION BY x.fov_num ORDER BY (x.r - y.r) * (x.r - y.r) + (x.c - y.c) * (x.c - y.c), y.fov_num) <= 4),
adj AS (SELECT a, b FROM near n WHERE d2 < 10000 AND NOT (a > b AND EXISTS (SELECT 1 FROM near m WHERE m.a = n.b AND m.b = n.a AND m.d2 < 10000)))"""


@_query(f"WITH {_TILES}, {_ADJ} SELECT a, b FROM adj")
def tile_pairs(spark, d):
    return geometry.adjacent(_tiles(spark, d), 100)


@_query(
    f"""WITH {_TILES}, {_ADJ} SELECT a, b, greatest(x.r, y.r) AS r_tl, least(x.r, y.r) + 100 AS r_br, greatest(x.c, y.c) - 100 AS c_tl, least(x.c, y.c) AS c_br,
CASE WHEN x.r > y.r THEN 'bottom' ELSE 'top' END AS a_row, CASE WHEN x.c > y.c THEN 'right' ELSE 'left' END AS a_column FROM adj JOIN tiles x ON x.fov_num = a JOIN tiles y ON y.fov_num = b"""
)
def tile_overlaps(spark, d):
    tiles = _tiles(spark, d)
    return geometry.overlaps(tiles, geometry.adjacent(tiles, 100), "top-right", 100, 100)


@_query(
    "WITH x AS (SELECT CAST(s_suppkey AS INT) AS fov_num, -CAST(s_suppkey % 10 AS DOUBLE) AS x, CAST(s_suppkey // 10 AS DOUBLE) AS y FROM supplier) SELECT fov_num, (y - (SELECT min(y) FROM x)) / 0.25 AS r, (x - (SELECT min(x) FROM x)) / 0.25 AS c FROM x"
)
def tile_axes(spark, d):
    k = F.col("s_suppkey")
    stage = _table(spark, d, "supplier").select(k.cast("int").alias("fov_num"), (k % 10).cast("double").alias("x"), F.floor(k / 10).cast("double").alias("y"))
    return geometry.tile_corners(stage, "ROBOFISH2", 0.25)


@_query(
    "WITH x AS (SELECT CAST(s_suppkey AS INT) AS fov_num, -CAST(s_suppkey % 10 AS DOUBLE) AS x, CAST(s_suppkey // 10 AS DOUBLE) AS y FROM supplier) SELECT fov_num, ((SELECT max(y) FROM x) - y) / 0.25 AS r, ((SELECT max(x) FROM x) - x) / 0.25 AS c FROM x"
)
def tile_axes_mirrored(spark, d):
    k = F.col("s_suppkey")
    stage = _table(spark, d, "supplier").select(k.cast("int").alias("fov_num"), (-(k % 10)).cast("double").alias("x"), F.floor(k / 10).cast("double").alias("y"))
    return geometry.tile_corners_mirrored(stage, 0.25)


@_query(
    f"""WITH {_DOTS}, {_TILES}, s AS (SELECT dot_id, d.fov_num, t.r AS tr, t.c AS tc, d.r, d.c FROM dots d JOIN tiles t ON t.fov_num = d.fov_num)
SELECT dot_id, 'top-left' AS corner, tr + r AS row, tc + c AS col FROM s UNION ALL SELECT dot_id, 'top-right', tr + r, tc - (100 - c) FROM s
UNION ALL SELECT dot_id, 'bottom-left', tr + (100 - r), tc + c FROM s UNION ALL SELECT dot_id, 'bottom-right', tr + (100 - r), tc - (100 - c) FROM s UNION ALL SELECT dot_id, 'mirrored', tr - r, tc - c FROM s"""
)
def corner_stitch(spark, d):
    frames = []
    for corner in ("top-left", "top-right", "bottom-left", "bottom-right", "mirrored"):
        out = geometry.stitch(_dots(spark, d), _tiles(spark, d), corner, 100, 100, RC)
        frames.append(out.select("dot_id", F.lit(corner).alias("corner"), F.col("r_px_microscope_stitched").alias("row"), F.col("c_px_microscope_stitched").alias("col")))
    return selection.union_outer(frames)


@_query(f"WITH {_DOTS}, {_RECTS} SELECT dot_id, a, b FROM dots JOIN rects ON fov_num IN (a, b) AND r > r_tl AND r < r_br AND c > c_tl AND c < c_br")
def range_join_overlap(spark, d):
    return geometry.in_overlaps(_dots(spark, d), _rects(spark, d), RC).select("dot_id", "a", "b")


@_query(
    f"""WITH {_DOTS}, n AS (SELECT greatest({_HIGH} // 40, 1) AS rows, greatest((SELECT CAST(floor(max(c)) AS BIGINT) + 1 FROM dots) // 40, 1) AS cols),
e AS (SELECT r, c, least(CAST(r AS BIGINT) // 40, rows - 1) AS i, least(CAST(floor(c) AS BIGINT) // 40, cols - 1) AS j, rows, cols FROM dots, n)
SELECT i * 40 AS r0, CASE WHEN i = rows - 1 THEN {_HIGH} ELSE (i + 1) * 40 END AS r1, j * 40 AS c0, CASE WHEN j = cols - 1 THEN (SELECT CAST(floor(max(c)) AS BIGINT) + 1 FROM dots) ELSE (j + 1) * 40 END AS c1, count(*) AS n FROM e GROUP BY 1, 2, 3, 4"""
)
def canvas_chunks(spark, d):
    """Dots in each chunk of their canvas, the last ones with the remainder."""
    return geometry.count_in_chunks(_dots(spark, d), 40, RC)


_DUP = f"""{_DOTS}, {_RECTS}, inside AS (SELECT dot_id, gene, r, c, a, b, fov_num = a AS first FROM dots JOIN rects ON fov_num IN (a, b) AND r > r_tl AND r < r_br AND c > c_tl AND c < c_br),
gone AS (SELECT DISTINCT y.dot_id FROM inside y JOIN inside x ON x.first AND NOT y.first AND x.a = y.a AND x.b = y.b AND x.gene = y.gene AND (x.r - y.r) * (x.r - y.r) + (x.c - y.c) * (x.c - y.c) <= 4)"""


@_query(f"WITH {_DUP} SELECT dot_id FROM gone")
def dedup_removed(spark, d):
    return dedup.duplicated(_dots(spark, d), _rects(spark, d), 2.0, RC, "gene")


@_query(f"WITH {_DUP} SELECT fov_num, dot_id FROM dots WHERE dot_id NOT IN (SELECT dot_id FROM gone)")
def dedup_cleaned(spark, d):
    dots = _dots(spark, d)
    return dedup.split_by(dots, dedup.duplicated(dots, _rects(spark, d), 2.0, RC, "gene"))[0].select("fov_num", "dot_id")


@_query(f"WITH {_DUP.replace('<= 4)', '< 4)')} SELECT dot_id FROM gone")
def dedup_removed_strict(spark, d):
    return dedup.duplicated(_dots(spark, d), _rects(spark, d), 2.0, RC, "gene", strict=True)


@_query(
    f"""WITH {_DOTS}, {_RECTS}, boxes AS (SELECT a, b, r_tl AS r0, r_br AS r1, c_tl AS c0, c_br AS c1, a_row AS ar, a_column AS ac FROM rects),
cuts AS (SELECT a, b, c1 - c0 > r1 - r0 AS by_rows, CASE WHEN c1 - c0 > r1 - r0 THEN r0 + (r1 - r0) * 0.5 ELSE c0 + (c1 - c0) * 0.25 END AS cut, CASE WHEN c1 - c0 > r1 - r0 THEN ar = 'top' ELSE ac = 'left' END AS below FROM boxes),
v AS (SELECT dot_id FROM dots JOIN cuts ON fov_num IN (a, b) WHERE CASE WHEN below = (fov_num = a) THEN (CASE WHEN by_rows THEN r ELSE c END) >= cut ELSE (CASE WHEN by_rows THEN r ELSE c END) <= cut END)
SELECT fov_num, dot_id FROM dots WHERE dot_id NOT IN (SELECT dot_id FROM v)"""
)
def clip_halfplane(spark, d):
    return dedup.clip(_dots(spark, d), _rects(spark, d), RC, 0.5, 0.25).select("fov_num", "dot_id")


# barcodes


@_query(f"WITH {_DOTS}, {_BITS} SELECT ref, code_bits FROM bits")
def barcode_bits(spark, d):
    return _bits(spark, d)


@_query(f"WITH {_DOTS}, {_BITS} SELECT ref, CAST(bit_count(code_bits) AS BIGINT) AS positive FROM bits")
def positive_bits(spark, d):
    return _bits(spark, d).select("ref", codes.positive_bits(F.col("code_bits")).alias("positive"))


@_query(f"WITH {_DOTS}, {_BITS}, {_BOOK}, {_DECODED} SELECT ref, code_bits, decoded_genes, CAST(hamming_distance AS DOUBLE) AS hamming_distance, number_positive_bits FROM decoded")
def hamming_nearest(spark, d):
    return _decoded(spark, d).select("ref", "code_bits", "decoded_genes", "hamming_distance", "number_positive_bits")


@_query(
    f"""WITH {_DOTS}, {_BITS}, {_BOOK}, {_DECODED}, i AS (SELECT unnest(range(16)) AS i)
SELECT CAST(i AS INT) AS position, CAST(((codeword_bits >> i) & 1) - ((code_bits >> i) & 1) AS INT) AS direction, count(*) AS n FROM decoded, i
WHERE hamming_distance > 0 AND hamming_distance < 3 / 16.0 AND (xor(code_bits, codeword_bits) >> i) & 1 = 1 GROUP BY 1, 2"""
)
def flip_positions(spark, d):
    return barcodes.flip_summary(_decoded(spark, d))


@_query(f"WITH {_DOTS}, {_BITS}, {_BOOK}, {_DECODED} SELECT ref, CASE WHEN hamming_distance = 0 THEN decoded_genes END AS zero_genes, CASE WHEN hamming_distance < 2 / 16.0 THEN decoded_genes END AS below2_genes, CASE WHEN hamming_distance < 3 / 16.0 THEN decoded_genes END AS below3_genes FROM decoded")
def barcode_tiers(spark, d):
    return _decoded(spark, d).select("ref", *(c.alias(k) for k, c in codes.tiers(F.col("decoded_genes"), F.col("hamming_distance"), 16).items()))


@_query("SELECT p_partkey, CAST((p_partkey * 40503 + 977) % 65536 AS BIGINT) AS code_bits FROM part")
def codeword_parse(spark, d):
    bits = (F.col("p_partkey") * 40503 + 977) % 65536
    text = F.concat(F.lit("'["), F.reverse(F.lpad(F.bin(bits), 16, "0")), F.lit("]"))
    return _table(spark, d, "part").select("p_partkey", codes.pack_bits(codes.parse_codeword(F.regexp_replace(text, "^'", ""))).alias("code_bits"))


@_query(f"WITH {_DOTS} SELECT dot_id, CAST(round_even(least(greatest(c / 200, 0), 1) * 65535, 0) AS INT) AS rounded, CAST(trunc(least(greatest(c / 200, 0), 1) * 65535) AS INT) AS cut FROM dots")
def pixel_conversion(spark, d):
    unit = F.col("c") / 200
    return _dots(spark, d).select("dot_id", codes.to_uint16(unit).alias("rounded"), codes.to_uint16_truncated(unit).alias("cut"))


def _unrolled(name: str, source: str, squared: float) -> str:
    """The rounds of sequential decoding as tables: {name}_codes, and {name}_owner: each dot with the reference that took it."""
    made = [f"{name}0 AS MATERIALIZED (SELECT fov_num, channel, CAST(dot_id AS VARCHAR) AS dot_id, round_num, r, c FROM {source})"]
    for k in range(1, 17):
        pool = f"{name}{k - 1}"
        made.append(f"""{name}{k}_near AS MATERIALIZED (SELECT o.dot_id, o.round_num, x.dot_id AS ref FROM {pool} o JOIN {pool} x ON o.fov_num = x.fov_num AND o.channel = x.channel AND o.round_num <> {k} AND x.round_num = {k}
  AND (o.r - x.r) * (o.r - x.r) + (o.c - x.c) * (o.c - x.c) <= {squared} QUALIFY row_number() OVER (PARTITION BY o.dot_id ORDER BY (o.r - x.r) * (o.r - x.r) + (o.c - x.c) * (o.c - x.c), x.dot_id) = 1)""")
        made.append(f"""{name}{k}_codes AS (SELECT x.*, coalesce(b.bits, 0) | (CAST(1 AS BIGINT) << {k - 1}) AS code_bits FROM {pool} x LEFT JOIN (SELECT ref, bit_or(CAST(1 AS BIGINT) << (round_num - 1)) AS bits FROM {name}{k}_near GROUP BY 1) b ON b.ref = x.dot_id
  WHERE x.round_num = {k} AND (b.ref IS NOT NULL OR (x.fov_num, x.channel) NOT IN (SELECT (fov_num, channel) FROM {pool} WHERE round_num <> {k})))""")
        made.append(f"{name}{k} AS MATERIALIZED (SELECT * FROM {pool} WHERE round_num <> {k} AND dot_id NOT IN (SELECT dot_id FROM {name}{k}_near))")
    rounds = range(1, 17)
    made.append(f"{name}_codes AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM {name}{k}_codes" for k in rounds) + ")")
    owners = [f"SELECT dot_id, ref FROM {name}{k}_near UNION ALL SELECT dot_id, dot_id FROM {name}{k - 1} WHERE round_num = {k}" for k in rounds]
    return ",\n".join([*made, f"{name}_owner AS (" + " UNION ALL ".join(owners) + ")"])


def _called(name: str) -> str:
    """{name}_called: the codes with their nearest codeword."""
    return f"""{name}_called AS MATERIALIZED (SELECT x.fov_num, x.channel, x.dot_id AS barcode_reference_dot_id, x.round_num, x.r, x.c, x.code_bits, k.gene AS decoded_genes,
  bit_count(xor(x.code_bits, k.code_bits)) / CAST(16 AS DOUBLE) AS hamming_distance, k.code_bits AS codeword_bits, CAST(bit_count(x.code_bits) AS BIGINT) AS number_positive_bits FROM {name}_codes x, book k
  QUALIFY row_number() OVER (PARTITION BY x.dot_id ORDER BY bit_count(xor(x.code_bits, k.code_bits)), k.code_idx) = 1)"""


@_query(f"WITH {_DOTS}, {_BOOK}, {_unrolled('p', 'dots', 4)}, {_called('p')} SELECT * FROM p_called")
def decode_sequential(spark, d):
    dots = _dots(spark, d).select("fov_num", "channel", "dot_id", "round_num", "r", "c")
    return barcodes.nearest_codeword(barcodes.decode(dots, 2.0, rc=RC), _codebook(spark, d))


@_query(
    f"""WITH {_DOTS}, {_BOOK}, {_unrolled('p', 'dots', 4)}, {_called('p')},
rest AS MATERIALIZED (SELECT * FROM dots WHERE CAST(dot_id AS VARCHAR) NOT IN (SELECT o.dot_id FROM p_owner o JOIN p_called g ON o.ref = g.barcode_reference_dot_id WHERE g.hamming_distance <= 2 / 16.0)),
{_unrolled('q', 'rest', 9)}, {_called('q')} SELECT *, 1 AS pass FROM p_called UNION ALL SELECT *, 2 AS pass FROM q_called"""
)
def decode_recollecting(spark, d):
    dots = _dots(spark, d).select("fov_num", "channel", "dot_id", "round_num", "r", "c")
    return barcodes.decode_recollecting(dots, _codebook(spark, d), rc=RC)


@_query(
    f"""WITH {_DOTS}, px AS (SELECT fov_num, round_num, CAST(r AS INT) AS pr, CAST(floor(c) AS INT) AS pc, max(dot_id % 100 + 0.5) AS value FROM dots GROUP BY ALL)
SELECT x.dot_id AS barcode_reference_dot_id, p.round_num, CAST(max(p.value) AS DOUBLE) AS intensity FROM dots x JOIN px p ON p.fov_num = x.fov_num AND p.pr BETWEEN greatest(CAST(trunc(x.r - 2) AS INT), 0) AND least(CAST(trunc(x.r + 2) AS INT), {_SQUARE})
AND p.pc BETWEEN greatest(CAST(trunc(x.c - 2) AS INT), 0) AND least(CAST(trunc(x.c + 2) AS INT), {_SQUARE}) WHERE x.round_num = 1 GROUP BY 1, 2"""
)
def bit_intensity(spark, d):
    dots = _dots(spark, d)
    px = dots.groupBy("fov_num", "round_num", F.col("r").cast("int").alias("pr"), F.floor("c").cast("int").alias("pc")).agg(F.max(F.col("dot_id") % 100 + F.lit(0.5).cast("double")).alias("value"))
    refs = dots.filter("round_num = 1").select("fov_num", F.col("dot_id").alias("barcode_reference_dot_id"), "r", "c")
    square = _table(spark, d, "events").agg(F.greatest(F.max("user_id"), F.floor(F.max("value"))).cast("int") + 1).first()[0]
    return barcodes.bit_intensities(refs, px, 2, square)


# cells


@_query(f"WITH {_DOTS}, {_MASK} SELECT dot_id, CAST(coalesce(min(cell_id), -1) AS BIGINT) AS cell_id FROM dots d LEFT JOIN mask m ON m.r BETWEEN d.r - 0.5 AND d.r + 0.5 AND m.c BETWEEN d.c - 0.5 AND d.c + 0.5 GROUP BY dot_id")
def point_in_cell(spark, d):
    return cells.assign(_dots(spark, d), _mask(spark, d), RC).select("dot_id", "cell_id")


_COUNTS = f"{_DOTS}, {_MASK}, hit AS (SELECT dot_id, gene, min(cell_id) AS cell_id FROM dots d JOIN mask m ON m.r BETWEEN d.r - 0.5 AND d.r + 0.5 AND m.c BETWEEN d.c - 0.5 AND d.c + 0.5 GROUP BY 1, 2), counts AS (SELECT cell_id, gene, count(*) AS n FROM hit GROUP BY 1, 2)"


def _counts(spark, d):
    return cells.gene_counts(cells.assign(_dots(spark, d), _mask(spark, d), RC), "gene")


@_query(f"WITH {_COUNTS} SELECT cell_id, gene, n FROM counts")
def cell_gene_counts(spark, d):
    return _counts(spark, d)


@_query(f"WITH {_COUNTS} SELECT cell_id, CAST(sum(n) AS BIGINT) AS molecules, count(DISTINCT gene) AS genes FROM counts GROUP BY 1")
def cell_totals(spark, d):
    return cells.molecules(_counts(spark, d))


@_query(f"WITH {_COUNTS} SELECT gene, " + ", ".join(f"CAST(coalesce(sum(n) FILTER (WHERE cell_id = {i}), 0) AS BIGINT) AS \"{i}\"" for i in range(1, 51)) + " FROM counts GROUP BY gene")
def cell_gene_pivot(spark, d):
    return cells.matrix(_counts(spark, d), list(range(1, 51)), "gene")


@_query(f"WITH {_COUNTS} SELECT gene, CAST(sum(n) AS BIGINT) AS total FROM counts GROUP BY gene ORDER BY total DESC, gene LIMIT 3")
def summary_topk_genes(spark, d):
    return cells.top_genes(_counts(spark, d), 3)


@_query(f"WITH {_COUNTS} SELECT gene, CAST(sum(n) AS BIGINT) AS total FROM counts GROUP BY gene ORDER BY total, gene LIMIT 3")
def summary_rarest_genes(spark, d):
    return cells.top_genes(_counts(spark, d), 3, most=False)


@_query(f"WITH {_DOTS} SELECT min(r) AS r_min, max(r) AS r_max, min(c) AS c_min, max(c) AS c_max FROM dots")
def extent(spark, d):
    return cells.extent(_dots(spark, d))


@_query(f"WITH {_COUNTS}, m AS (SELECT sum(n) AS n, count(DISTINCT gene) AS g FROM counts GROUP BY cell_id) SELECT CAST(quantile_cont(n, 0.5) AS DOUBLE) AS median_molecules, CAST(quantile_cont(g, 0.5) AS DOUBLE) AS median_genes FROM m")
def median_molecules(spark, d):
    return cells.medians(_counts(spark, d))


@_query(f"WITH {_DOTS}, {_BITS}, {_BOOK}, {_DECODED} SELECT CAST(hamming_distance AS DOUBLE) AS hamming_distance, count(*) AS n FROM decoded GROUP BY 1")
def distance_histogram(spark, d):
    return cells.distance_histogram(_decoded(spark, d))


@_query(f"WITH {_PIXELS} SELECT x.obj_id AS obj_a, y.obj_id AS obj_b, count(*) AS shared FROM pixels x JOIN pixels y ON x.fov_num = 0 AND y.fov_num = 1 AND x.r = y.r AND x.c = y.c GROUP BY 1, 2 HAVING count(*) >= 20")
def object_overlap(spark, d):
    return cells.shared_pixels(_pixels(spark, d), spark.createDataFrame([(0, 1)], "a int, b int"), 20)


@_query(f"WITH {_PIXELS} SELECT obj_id, count(*) AS area, round(avg(r), 6) AS centroid_r, round(avg(c), 6) AS centroid_c FROM pixels GROUP BY obj_id")
def region_properties(spark, d):
    return cells.regions(_pixels(spark, d)).withColumns({c: F.round(c, 6) for c in ("centroid_r", "centroid_c")})


@_query(
    f"""WITH {_PIXELS}, s AS (SELECT x.obj_id AS a, y.obj_id AS b, count(*) AS n FROM pixels x JOIN pixels y ON x.fov_num = 0 AND y.fov_num = 1 AND x.r = y.r AND x.c = y.c GROUP BY 1, 2 HAVING count(*) >= 20),
best AS (SELECT a, b FROM s QUALIFY row_number() OVER (PARTITION BY a ORDER BY n DESC, b) = 1), into_ AS (SELECT b, min(a) AS a FROM best GROUP BY b)
SELECT coalesce(i.a, obj_id) AS obj_id, count(DISTINCT (r, c)) AS area FROM pixels LEFT JOIN into_ i ON obj_id = i.b GROUP BY 1"""
)
def object_merge(spark, d):
    px = _pixels(spark, d)
    couples = cells.best_couples(cells.shared_pixels(px, spark.createDataFrame([(0, 1)], "a int, b int"), 20))
    return cells.merged_regions(px, couples).groupBy("obj_id").agg(F.count("*").alias("area"))


@_query(f"WITH {_PIXELS}, n AS (SELECT obj_id, row_number() OVER (ORDER BY obj_id) AS cell_id FROM (SELECT DISTINCT obj_id FROM pixels)) SELECT r, c, max(cell_id) AS cell_id FROM pixels JOIN n USING (obj_id) GROUP BY 1, 2")
def label_canvas(spark, d):
    return cells.label_canvas(_pixels(spark, d))


#: The same labels strewn over a canvas that is larger than the table, so that there is background to grow into.
_SPARSE = "mask AS (SELECT o_orderkey * 37 % 1201 AS r, o_orderkey * 101 % 1301 AS c, min(o_custkey % 50 + 1) AS cell_id FROM orders GROUP BY 1, 2)"


@_query(
    f"""WITH {_SPARSE}, o AS (SELECT i.i - 3 AS i, j.j - 3 AS j FROM range(7) i(i), range(7) j(j) WHERE (i.i - 3) * (i.i - 3) + (j.j - 3) * (j.j - 3) <= 9)
SELECT r + i AS r, c + j AS c, cell_id FROM mask, o WHERE r + i BETWEEN 0 AND 1200 AND c + j BETWEEN 0 AND 1300 QUALIFY row_number() OVER (PARTITION BY r + i, c + j ORDER BY i * i + j * j, cell_id) = 1"""
)
def label_expansion(spark, d):
    o = F.col("o_orderkey")
    mask = _table(spark, d, "orders").groupBy((o * 37 % 1201).alias("r"), (o * 101 % 1301).alias("c")).agg(F.min(F.col("o_custkey") % 50 + 1).alias("cell_id"))
    return cells.expand_labels(mask, 3, 1201, 1301)


# detection

#: Pixels of an image of each tile and channel: dots on a canvas of a pixel a row and two columns, brighter where several fall.
_LIT = "px AS (SELECT fov_num, channel, CAST(r AS INT) AS r, CAST(floor(c / 2) AS INT) AS c, CAST(sum(dot_id % 7 + 1) AS BIGINT) AS value FROM dots GROUP BY ALL)"
_OBJECTS = f"""WITH RECURSIVE {_DOTS}, {_LIT}, e AS MATERIALIZED (SELECT x.fov_num, x.channel, x.r, x.c, y.r AS r2, y.c AS c2 FROM px x JOIN px y ON x.fov_num = y.fov_num AND x.channel = y.channel AND abs(x.r - y.r) <= 1 AND abs(x.c - y.c) <= 1),
reach AS (SELECT fov_num, channel, r, c, r AS hr, hr * 100000 + c AS h FROM px UNION SELECT e.fov_num, e.channel, e.r2, e.c2, p.hr, p.h FROM reach p JOIN e USING (fov_num, channel, r, c)),
lab AS MATERIALIZED (SELECT fov_num, channel, r, c, min(h) AS h FROM reach GROUP BY ALL), sizes AS (SELECT fov_num, channel, h, count(*) AS size FROM lab GROUP BY ALL),
lit AS MATERIALIZED (SELECT fov_num, channel, h, r, c, value, size FROM lab JOIN sizes USING (fov_num, channel, h) JOIN px USING (fov_num, channel, r, c))"""


def _lit(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = [F.col("r").cast("int").alias("r"), F.floor(F.col("c") / 2).cast("int").alias("c")]
    return _dots(spark, sf_dir).groupBy("fov_num", "channel", *at).agg(F.sum(F.col("dot_id") % 7 + 1).alias("value"))


@_query(f"{_OBJECTS} SELECT CAST(size AS BIGINT) AS size, count(*) AS objects FROM sizes GROUP BY 1")
def object_sizes(spark, d):
    """How many objects of connected pixels have each size."""
    return detection.object_sizes(detection.objects(_lit(spark, d), ["fov_num", "channel"])).groupBy(F.col("n").alias("size")).agg(F.count("*").alias("objects"))


@_query(
    f"""{_OBJECTS}, top AS (SELECT * FROM lit p WHERE size BETWEEN 2 AND 200 AND NOT EXISTS (SELECT 1 FROM lit q WHERE q.fov_num = p.fov_num AND q.channel = p.channel AND q.h = p.h AND abs(q.r - p.r) <= 1 AND abs(q.c - p.c) <= 1 AND q.value > p.value))
SELECT fov_num, channel, r, c, value, CAST(size AS BIGINT) AS size FROM top QUALIFY row_number() OVER (PARTITION BY fov_num, channel, h ORDER BY value DESC, r, c) <= 2"""
)
def detected_dots(spark, d):
    """Peaks of objects of 2 to 200 pixels, two of each object at most."""
    return detection.peaks(_lit(spark, d), ["fov_num", "channel"], 1, 2, 200, per_object=2, diagonal=True)


# chunked arrays


@_query(f"WITH {_DOTS}, px AS (SELECT fov_num, channel, round_num, CAST(r AS INT) AS r, CAST(floor(c) AS INT) AS c, count(*) AS n FROM dots GROUP BY ALL) SELECT fov_num, channel, round_num, r, c, CAST(n AS DOUBLE) AS value FROM px")
def chunk_round_trip(spark, d):
    """Images of all dots, a tile, channel and round each, written as chunked arrays and read back."""
    high, wide = _dots(spark, d).agg(F.max("r").cast("int") + 1, F.floor(F.max("c")).cast("int") + 1).first()
    pixels = _dots(spark, d).groupBy("fov_num", "channel", "round_num", F.col("r").cast("int").alias("r"), F.floor("c").cast("int").alias("c")).agg(F.count("*").alias("n"))
    path = f"{shared_dir(spark)}/chunks-{uuid.uuid4().hex}"
    chunks.write(images.from_sparse(pixels, ["fov_num", "channel", "round_num"], (high, wide), chunk=(2048, 2048)), path, "2048,2048")
    found = chunks.sparse(chunks.read(spark, path))
    return found.select("fov_num", "channel", "round_num", F.col("at")[0].alias("r"), F.col("at")[1].alias("c"), "value")


# curves, checks, alignment


@_query(f"WITH {_DOTS}, h AS (SELECT CAST(floor(c / 10) AS BIGINT) AS thr, count(*) AS n FROM dots GROUP BY 1) SELECT thr, n, CAST(coalesce((lead(n) OVER w - lag(n) OVER w) / 2, lead(n) OVER w - n, n - lag(n) OVER w) AS DOUBLE) AS gradient FROM h WINDOW w AS (ORDER BY thr)")
def threshold_gradient(spark, d):
    h = _dots(spark, d).groupBy(F.floor(F.col("c") / 10).cast("bigint").alias("thr")).agg(F.count("*").alias("n"))
    return codes.gradient(h.withColumn("g", F.lit(0)), "n", "thr", ["g"]).drop("g")


@_query(
    f"""WITH {_DOTS}, h AS (SELECT gene, CAST(floor(c / 10) AS BIGINT) AS thr, count(*) AS n FROM dots GROUP BY 1, 2), s AS (SELECT *, arg_min(thr, (n, thr)) OVER (PARTITION BY gene) AS x0 FROM (SELECT gene, -thr AS thr, n FROM h)),
e AS (SELECT gene, thr, n, x0, first_value(n) OVER w AS y0, last_value(thr) OVER w AS x1, last_value(n) OVER w AS y1 FROM s WHERE thr >= x0 WINDOW w AS (PARTITION BY gene ORDER BY thr ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
a AS (SELECT gene, thr, n, abs((x1 - x0) * (y0 - n) - (x0 - thr) * (y1 - y0)) / sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)) AS away FROM e WHERE thr > x0 AND thr < x1)
SELECT gene, thr, n, round(away, 6) AS distance FROM a QUALIFY row_number() OVER (PARTITION BY gene ORDER BY away DESC, thr) = 1"""
)
def elbow(spark, d):
    h = _dots(spark, d).groupBy("gene", (-F.floor(F.col("c") / 10)).cast("bigint").alias("thr")).agg(F.count("*").alias("n"))
    return codes.elbow(h, "thr", "n", ["gene"]).withColumn("distance", F.round("distance", 6))


@_query(f"WITH {_DOTS} SELECT CAST(floor(r / 7) AS BIGINT) AS bin_r, CAST(floor(c / 7) AS BIGINT) AS bin_c, count(*) AS n FROM dots GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 1")
def hist2d_peak(spark, d):
    return alignment.histogram_peak(_dots(spark, d), "r", "c", 7)


@_query(f"WITH {_DOTS} SELECT 'box' AS kind, (min(r) + max(r)) / 2 AS r, (min(c) + max(c)) / 2 AS c FROM dots UNION ALL SELECT 'mean', round(avg(r), 6), round(avg(c), 6) FROM dots")
def centres(spark, d):
    dots = _dots(spark, d)
    mean = alignment.mean_centre(dots).select(F.round("r", 6).alias("r"), F.round("c", 6).alias("c"))
    return alignment.box_centre(dots).withColumn("kind", F.lit("box")).unionByName(mean.withColumn("kind", F.lit("mean")))


_SIGNED = f"""{_DOTS}, near AS (SELECT x.fov_num, x.round_num, x.dot_id, x.r, x.c, sqrt((x.r - y.r) * (x.r - y.r) + (x.c - y.c) * (x.c - y.c)) AS d, row_number() OVER (PARTITION BY x.dot_id ORDER BY (x.r - y.r) * (x.r - y.r) + (x.c - y.c) * (x.c - y.c), y.dot_id) AS k
  FROM dots x JOIN dots y ON x.fov_num = y.fov_num AND x.round_num = y.round_num AND x.dot_id <> y.dot_id AND (x.r - y.r) * (x.r - y.r) + (x.c - y.c) * (x.c - y.c) <= 64),
signed AS (SELECT fov_num, round_num, dot_id, max(d) FILTER (WHERE k = 1) AS s1, max(d) FILTER (WHERE k = 2) AS s2, max(d) FILTER (WHERE k = 3) AS s3 FROM near WHERE k <= 3 GROUP BY 1, 2, 3 HAVING count(*) = 3)"""


def _signed(spark, d):
    return constellations.signatures(_dots(spark, d), 3, 8.0, RC, "dot_id", ["fov_num", "round_num"])


@_query(f"WITH {_SIGNED} SELECT dot_id, round(s1, 6) AS s1, round(s2, 6) AS s2, round(s3, 6) AS s3 FROM signed")
def constellation_signatures(spark, d):
    return _signed(spark, d).select("dot_id", *(F.round(F.col("signature")[i], 6).alias(f"s{i + 1}") for i in range(3)))


@_query(
    f"""WITH {_SIGNED}, coupled AS (SELECT x.dot_id AS a, y.dot_id AS b, 0.0 + abs(x.s1 - y.s1) + abs(x.s2 - y.s2) + abs(x.s3 - y.s3) AS total FROM signed x JOIN signed y ON x.round_num = 1 AND y.round_num = 3 AND x.fov_num = y.fov_num
  AND abs(x.s1 - y.s1) <= 0.5 AND abs(x.s2 - y.s2) <= 0.5 AND abs(x.s3 - y.s3) <= 0.5)
SELECT a, b, round(total, 6) AS total FROM coupled QUALIFY row_number() OVER (PARTITION BY a ORDER BY total, b) = 1"""
)
def constellation_matches(spark, d):
    rows = _signed(spark, d)
    found = constellations.matches(rows.filter("round_num = 1"), rows.filter("round_num = 3"), 0.5, "dot_id", ["fov_num"], RC, cells=3)
    return found.select(F.col("dot_id").alias("a"), F.col("r_dot_id").alias("b"), F.round("total", 6).alias("total"))


@_query(
    f"""WITH {_DOTS}, e AS (SELECT x.fov_num, x.round_num, x.dot_id AS p, y.dot_id AS q, sqrt((x.r - y.r) * (x.r - y.r) + (x.c - y.c) * (x.c - y.c)) AS d FROM dots x JOIN dots y ON x.fov_num = y.fov_num AND x.round_num = y.round_num AND x.dot_id < y.dot_id
  AND (x.r - y.r) * (x.r - y.r) + (x.c - y.c) * (x.c - y.c) <= 16)
SELECT a.p, a.q, b.q AS s, round(least(a.d, b.d, c.d), 6) AS shortest, round(greatest(a.d, b.d, c.d), 6) AS longest FROM e a JOIN e b ON a.p = b.p AND a.q < b.q JOIN e c ON c.p = a.q AND c.q = b.q"""
)
def triangles(spark, d):
    found = constellations.triangles(_dots(spark, d), 4.0, RC, "dot_id", ["fov_num", "round_num"])
    return found.select("p", "q", "s", F.round(F.col("sides")[0], 6).alias("shortest"), F.round(F.col("sides")[2], 6).alias("longest"))


_TURNED = f"""{_DOTS}, turned AS (SELECT *, (1 + 0.01 * fov_num) * (cos(radians(5 * fov_num + 1)) * r - sin(radians(5 * fov_num + 1)) * c) + 3 * fov_num + 1 + (dot_id % 3 - 1) * 0.1 AS r_r,
  (1 + 0.01 * fov_num) * (sin(radians(5 * fov_num + 1)) * r + cos(radians(5 * fov_num + 1)) * c) - 2 * fov_num - 1 + (dot_id % 7 - 3) * 0.05 AS r_c FROM dots)"""


@_query(
    f"""WITH {_TURNED}, s AS (SELECT fov_num, (covar_pop(r, r_r) + covar_pop(c, r_c)) / (var_pop(r) + var_pop(c)) AS p, (covar_pop(r, r_c) - covar_pop(c, r_r)) / (var_pop(r) + var_pop(c)) AS q,
  avg(r) AS mr, avg(c) AS mc, avg(r_r) AS nr, avg(r_c) AS nc, count(*) AS inliers FROM turned WHERE dot_id % 5 >= 2 GROUP BY 1)
SELECT fov_num, round(sqrt(p * p + q * q), 6) AS scale, round(degrees(atan2(q, p)), 6) AS degrees, round(nr - p * mr + q * mc, 6) AS dr, round(nc - q * mr - p * mc, 6) AS dc, inliers FROM s"""
)
def match_similarities(spark, d):
    """Turned, scaled and moved tiles, their matches a little off, two of five of them wrong: the least-squares similarity of the right ones."""
    f, k, r, c = (F.col(x) for x in ("fov_num", "dot_id", "r", "c"))
    angle, scale, wrong = F.radians(5 * f + 1), 1 + 0.01 * f, k % 5 < 2
    found = _dots(spark, d).select(
        "fov_num", "dot_id", "r", "c",
        (scale * (F.cos(angle) * r - F.sin(angle) * c) + 3 * f + 1 + (k % 3 - 1) * 0.1 + F.when(wrong, 40 + k % 37).otherwise(0)).alias("r_r"),
        (scale * (F.sin(angle) * r + F.cos(angle) * c) - 2 * f - 1 + (k % 7 - 3) * 0.05 - F.when(wrong, 30 + k % 29).otherwise(0)).alias("r_c"),
    )
    fits = constellations.group_similarities(found, ["fov_num"], RC, 2.0, order=("dot_id",))
    return fits.select("fov_num", *(F.round(x, 6).alias(x) for x in ("scale", "degrees", "dr", "dc")), "inliers")


@_query("SELECT CAST(event_id % 6 AS INT) AS fov_num, count(*) FILTER (WHERE event_type = 'click') AS reference, count(*) FILTER (WHERE event_type <> 'click') AS others, min('r' || event_id || '_channel_click_fov_' || event_id % 6) FILTER (WHERE event_type = 'click') AS first_reference FROM events GROUP BY 1")
def registration_groups(spark, d):
    e = F.col("event_id")
    path = F.concat(F.lit("r"), e.cast("string"), F.lit("_channel_"), "event_type", F.lit("_fov_"), (e % 6).cast("string"))
    found = constellations.registration_groups(_table(spark, d, "events").select(path.alias("path")), "click")
    return found.select("fov_num", F.size("reference").cast("bigint").alias("reference"), F.size("others").cast("bigint").alias("others"), F.get("reference", F.lit(0)).alias("first_reference"))


@_query(f"WITH {_DOTS} SELECT gene, round(avg(c), 6) AS mean, quantile_cont(c, 0.5) AS median, round(stddev_pop(c), 6) AS std, round(stddev_pop(c) / count(c), 6) AS std_by_n FROM dots GROUP BY gene")
def error_statistics(spark, d):
    return quality.error_statistics(_dots(spark, d), "c", ["gene"]).withColumns({c: F.round(c, 6) for c in ("mean", "std", "std_by_n")})


#: A file an order, with the code of its customer, or of nobody for each third order; a file a customer.
_NAMES = """left_ AS (SELECT 'Count' || lpad(CAST(o_custkey + CASE WHEN o_orderkey % 3 = 0 THEN 50000 ELSE 0 END AS VARCHAR), 5, '0') || '_x' || o_orderkey AS path FROM orders),
right_ AS (SELECT 'y_Count' || lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS path FROM customer)"""


def _names(spark, d):
    k = F.col("o_orderkey")
    code = F.lpad((F.col("o_custkey") + F.when(k % 3 == 0, 50000).otherwise(0)).cast("string"), 5, "0")
    left = _table(spark, d, "orders").select(F.concat(F.lit("Count"), code, F.lit("_x"), k.cast("string")).alias("path"))
    right = _table(spark, d, "customer").select(F.concat(F.lit("y_Count"), F.lpad(F.col("c_custkey").cast("string"), 5, "0")).alias("path"))
    return left, right


@_query(f"WITH {_NAMES} SELECT path, regexp_extract(path, 'Count[0-9]{{5}}') AS code FROM left_ WHERE regexp_extract(path, 'Count[0-9]{{5}}') NOT IN (SELECT regexp_extract(path, 'Count[0-9]{{5}}') FROM right_)")
def regex_fk_check(spark, d):
    return quality.unmatched_codes(*_names(spark, d), "path").select("path", "code")


@_query(f"WITH {_NAMES} SELECT l.path AS left_name, r.path AS right_name FROM left_ l JOIN right_ r ON regexp_extract(l.path, 'Count[0-9]{{5}}') = regexp_extract(r.path, 'Count[0-9]{{5}}')")
def regex_code_join(spark, d):
    return quality.with_partners(*_names(spark, d), "path").select("left_name", "right_name")


@_query(f"WITH {_NAMES} SELECT regexp_extract(path, 'Count[0-9]{{5}}') AS code, count(*) AS n FROM left_ GROUP BY 1 HAVING count(*) > 1")
def duplicate_codes(spark, d):
    return quality.duplicate_codes(_names(spark, d)[0], "path")


_SHIFT = "shifts AS (SELECT f.i AS fov_num, r.i + 1 AS round_num, CAST(f.i - r.i AS DOUBLE) AS dr, CAST(r.i AS DOUBLE) / 2 AS dc, CASE WHEN r.i = 0 THEN 1000 ELSE r.i * 2 END AS n_match FROM range(6) f(i), range(15) r(i))"


@_query(f"WITH {_DOTS}, {_SHIFT} SELECT dot_id, r + dr AS r_px_registered, c + dc AS c_px_registered, CAST(CASE WHEN n_match BETWEEN 0 AND 4 THEN -2 ELSE n_match END AS INT) AS matches FROM dots LEFT JOIN shifts USING (fov_num, round_num)")
def shift_application(spark, d):
    grid = spark.range(90).select((F.col("id") % 6).cast("int").alias("fov_num"), F.floor(F.col("id") / 6).cast("int").alias("k"))
    shifts = grid.select("fov_num", (F.col("k") + 1).alias("round_num"), (F.col("fov_num") - F.col("k")).cast("double").alias("dr"), (F.col("k") / 2).alias("dc"), F.when(F.col("k") == 0, 1000).otherwise(F.col("k") * 2).alias("n_match"))
    out = registration.register(_dots(spark, d), shifts, RC, least=5)
    return out.select("dot_id", "r_px_registered", "c_px_registered", F.col("min_number_matching_dots_registration").cast("int").alias("matches"))


@_query(
    f"""WITH {_DOTS}, w AS (SELECT CAST(max(floor(c / 110)) AS BIGINT) + 1 AS across FROM dots),
t AS (SELECT (((CAST(floor(r / 110) AS BIGINT) * across + CAST(floor(c / 110) AS BIGINT)) * 6 + fov_num) * 16 + round_num - 1) AS fov_num, count(*) AS n FROM dots, w GROUP BY 1)
SELECT CAST(fov_num AS INT) AS fov_num, CAST(k AS INT) AS round_num, CAST(CASE WHEN k > 1 THEN -2 * k ELSE 0 END AS DOUBLE) AS dr, CAST(CASE WHEN k > 1 THEN k ELSE 0 END AS DOUBLE) AS dc, CAST(CASE WHEN k = 1 THEN 1000 ELSE n END AS INT) AS n_match FROM t, (VALUES (1), (2), (3)) v(k)"""
)
def round_shifts(spark, d):
    """Shifts planted onto the dots of every round: each round of a tile is an image, registered with two moved copies of it."""
    dots = _dots(spark, d)
    across = F.broadcast(dots.agg((F.max(F.floor(F.col("c") / 110)) + 1).alias("across")))
    tile = F.floor(F.col("r") / 110) * F.col("across") + F.floor(F.col("c") / 110)
    # a margin of 9 pixels keeps the moved copies in the frame
    image = ((tile * 6 + F.col("fov_num")) * 16 + F.col("round_num") - 1).cast("int")
    first = dots.crossJoin(across).withColumns({"fov_num": image, "round_num": F.lit(1), "r": F.col("r") % 110 + 9, "c": F.floor(F.col("c")) % 110 + 9.0}).drop("across")
    moved = [first.withColumns({"round_num": F.lit(k), "r": F.col("r") + 2.0 * k, "c": F.col("c") - 1.0 * k}) for k in (2, 3)]
    return registration.round_shifts(selection.union_outer([first, *moved]), 1, 3, (128, 128), 0.5, 5, RC)


@_query()
def tile_pair_shifts(spark, d):
    """Rows only: shifts of overlapping tiles by phase correlation of their points."""
    return registration.pair_shifts(_dots(spark, d), _rects(spark, d))


@_query(
    f"""WITH t AS (SELECT CAST(range AS INT) AS f, range * 3 % 5 - 2 AS pr, range * 3 % 7 - 3 AS pc FROM range(0, (SELECT ((max(user_id) * 16 + 16 - 64) // 40 + 1) * 2 FROM events)))
SELECT x.f AS a, y.f AS b, CAST(CASE WHEN x.f % 13 = 5 OR y.f % 13 = 5 THEN 1000 ELSE x.pr - y.pr END AS DOUBLE) AS dr, CAST(CASE WHEN x.f % 13 = 5 OR y.f % 13 = 5 THEN 1000 ELSE x.pc - y.pc END AS DOUBLE) AS dc
FROM t x JOIN t y ON y.f = x.f + 2 OR (y.f = x.f + 1 AND x.f % 2 = 0)"""
)
def image_pair_shifts(spark, d):
    """Shifts of neighbouring tiles from their images: windows of 64 by 80 pixels, each moved a little, onto a canvas of all events; some have no image."""
    events = _table(spark, d, "events").select((F.col("user_id") * 16 + F.col("event_id") % 16).cast("int").alias("y"), F.pmod(F.floor("value"), F.lit(128)).cast("int").alias("x"))
    count = F.broadcast(_table(spark, d, "events").agg((F.floor((F.max("user_id") * 16 - 48) / 40) + 1).cast("int").alias("down")))
    f, row = F.col("fov_num"), F.floor(F.col("y") / 40).cast("int")
    seen = events.crossJoin(count).withColumn("i", F.explode(F.sequence(row - 2, row + 1))).filter("i >= 0 AND i < down").withColumn("j", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("fov_num", F.col("i") * 2 + F.col("j"))
    moved = seen.select("fov_num", (F.col("y") - F.col("i") * 40 + f * 3 % 5 - 2).cast("int").alias("r"), (F.col("x") - F.col("j") * 48 + f * 3 % 7 - 3).cast("int").alias("c"))
    pixels = moved.filter("r >= 0 AND r < 64 AND c >= 0 AND c < 80 AND fov_num % 13 <> 5").groupBy("fov_num", "r", "c").agg(F.count(F.lit(1)).alias("n"))
    tiles = count.select(F.explode(F.sequence(F.lit(0), F.col("down") * 2 - 1)).alias("fov_num")).select("fov_num", (F.floor(f / 2) * 40.0).alias("r"), (f % 2 * 48.0).alias("c"))
    rects = geometry.overlaps(tiles, geometry.adjacent(tiles, 50), "top-left", 80, 64)
    return registration.image_pair_shifts(images.from_sparse(pixels, ["fov_num"], (64, 80)), rects).select("a", "b", "dr", "dc")


def _planted(f):
    """Where a tile lies off its place."""
    return (f * 37 % 23 - 11) * 0.45, (f * 53 % 19 - 9) * 0.6


@_query(
    f"""WITH {_TILES}, x AS (SELECT *, (fov_num * 37 % 23 - 11) * CAST(0.45 AS DOUBLE) AS dr, (fov_num * 53 % 19 - 9) * CAST(0.6 AS DOUBLE) AS dc FROM tiles), o AS (SELECT arg_min(dr, fov_num) AS r0, arg_min(dc, fov_num) AS c0 FROM x)
SELECT fov_num, r + trunc(round(dr - r0, 6)) AS r, c + trunc(round(dc - c0, 6)) AS c FROM x, o"""
)
def tile_offsets(spark, d):
    """The least-squares solution of pair shifts that contradict each other.

    On top of planted offsets, what goes around each square of four tiles is added to its sides: no offsets explain it, and it
    leaves the least-squares solution where it is. Failed pairs are there too.
    """
    tiles = _tiles(spark, d)
    pairs = geometry.adjacent(tiles, 100).crossJoin(F.broadcast(tiles.agg(F.max("fov_num").alias("last"))))
    a, b, last = F.least("a", "b"), F.greatest("a", "b"), F.col("last")
    square = lambda k: F.when((k >= 0) & (k % 10 < 9) & (k + 11 <= last), (k * 7 % 5 - 2) * 0.7).otherwise(0.0)
    around = F.when(b - a == 1, square(a) - square(a - 10)).otherwise(F.when(a % 10 > 0, square(a - 1)).otherwise(0.0) - square(a)) * F.when(F.col("a") < F.col("b"), 1).otherwise(-1)
    (ar, ac), (br, bc) = _planted(F.col("a")), _planted(F.col("b"))
    shifts = pairs.select("a", "b", (br - ar + around).alias("dr"), (bc - ac - around).alias("dc"))
    return registration.global_offsets(shifts.unionByName(shifts.select("a", "b", F.lit(1000.0).alias("dr"), F.lit(1000.0).alias("dc"))), tiles)


def _merged(step: str, source: str, which: str) -> str:
    """{step}: the dots of ``source`` after merging over the overlaps where ``which`` holds."""
    return f"""{step}_in AS MATERIALIZED (SELECT x.*, a, b, fov_num = a AS first FROM {source} x JOIN rects ON fov_num IN (a, b) AND {which} AND r BETWEEN r_tl AND r_br AND c BETWEEN c_tl AND c_br),
{step}_on AS (SELECT a, b FROM {step}_in GROUP BY a, b HAVING count(*) FILTER (WHERE first) > 10 AND count(*) FILTER (WHERE NOT first) > 10),
{step}_near AS (SELECT x.a, x.b, x.dot_id AS ka, y.dot_id AS kb, x.gene AS ga, y.gene AS gb, x.r AS ar, x.c AS ac, y.r AS br, y.c AS bc, (x.r - y.r) * (x.r - y.r) + (x.c - y.c) * (x.c - y.c) AS d2
  FROM {step}_in y JOIN {step}_on USING (a, b) JOIN {step}_in x ON x.a = y.a AND x.b = y.b AND x.first AND NOT y.first AND (x.r - y.r) * (x.r - y.r) + (x.c - y.c) * (x.c - y.c) <= 4
  QUALIFY row_number() OVER (PARTITION BY y.a, y.b, y.dot_id ORDER BY (x.r - y.r) * (x.r - y.r) + (x.c - y.c) * (x.c - y.c), x.dot_id) = 1),
{step}_best AS (SELECT * FROM {step}_near QUALIFY rank() OVER (PARTITION BY a, b, ka ORDER BY d2) = 1),
{step}_one AS MATERIALIZED (SELECT * FROM {step}_best WHERE ga = gb QUALIFY row_number() OVER (PARTITION BY a, b, ka ORDER BY kb) = 1),
{step} AS MATERIALIZED (SELECT dot_id, gene, fov_num, CASE WHEN ka IS NULL THEN r ELSE (ar + br) / 2 END AS r, CASE WHEN ka IS NULL THEN c ELSE (ac + bc) / 2 END AS c
  FROM {source} LEFT JOIN {step}_one ON ka = dot_id WHERE dot_id NOT IN (SELECT kb FROM {step}_one))"""


@_query(f"WITH {_DOTS}, {_RECTS}, {_merged('even', 'dots', 'a % 2 = 0')}, {_merged('odd', 'even', 'a % 2 = 1')} SELECT dot_id, fov_num, r, c FROM odd")
def merge_overlaps(spark, d):
    """All overlaps merged, each pair on the positions that the pairs before it have left."""
    dots = _dots(spark, d).select("dot_id", "gene", "fov_num", "r", "c")
    return spatial.merge_overlaps(dots, _rects(spark, d), 2.0, RC, identity="gene", order=F.col("a") % 2).select("dot_id", "fov_num", "r", "c")


@_query(
    f"""WITH {_DOTS}, p AS (SELECT gene, CAST(r AS INT) AS r, CAST(floor(c * 4) AS INT) AS c, min(dot_id) AS id FROM dots GROUP BY ALL)
SELECT a.id AS a, b.id AS b, CAST(d2 AS BIGINT) AS d2, CAST(rank AS BIGINT) AS rank FROM (SELECT x.id AS i, y.id AS j, (x.r - y.r) * (x.r - y.r) + (x.c - y.c) * (x.c - y.c) AS d2, row_number() OVER (PARTITION BY x.id ORDER BY (x.r - y.r) * (x.r - y.r) + (x.c - y.c) * (x.c - y.c), y.id) AS rank
  FROM p x JOIN p y ON x.id <> y.id QUALIFY row_number() OVER (PARTITION BY x.id ORDER BY (x.r - y.r) * (x.r - y.r) + (x.c - y.c) * (x.c - y.c), y.id) <= 3) n JOIN p a ON a.id = i JOIN p b ON b.id = j"""
)
def knn_dots(spark, d):
    """The three nearest other places of every place with a dot of a gene, without a radius."""
    places = _dots(spark, d).groupBy("gene", F.col("r").cast("int").alias("r"), F.floor(F.col("c") * 4).cast("int").alias("c")).agg(F.min("dot_id").alias("id"))
    return spatial.k_nearest(places, 3, RC, "id").select("a", "b", F.col("d2").cast("long").alias("d2"), F.col("rank").cast("long").alias("rank"))


@_query(f"WITH {_DOTS} SELECT CAST(fov_num * 2 AS INT) AS a, CAST(fov_num * 2 + 1 AS INT) AS b, -3 AS dr, 2 AS dc, count(*) AS n_a, count(*) AS n_b FROM dots GROUP BY fov_num")
def pair_density_offset(spark, d):
    """The densest offset of each tile and a copy of it that is moved by (3, -2), to whole pixels."""
    # spread out, so that a dot is nearer to its copy than to most others
    dots = _dots(spark, d).select("fov_num", (F.col("r") * 40).alias("r"), (F.col("c") * 40).alias("c"))
    copy = dots.select((F.col("fov_num") * 2 + 1).alias("fov_num"), (F.col("r") + 3).alias("r"), (F.col("c") - 2).alias("c"))
    rects = spark.createDataFrame([(2 * k, 2 * k + 1, -1e3, 1e9, -1e3, 1e9) for k in range(6)], "a int, b int, r_tl double, r_br double, c_tl double, c_br double")
    found = alignment.pair_offsets(dots.withColumn("fov_num", F.col("fov_num") * 2).unionByName(copy), rects, RC, 10)
    return found.withColumns({x: F.round(x).cast("int") for x in ("dr", "dc")})


@_query(
    f"""WITH {_DOTS}, g AS (SELECT gene, count(*) AS n, (max(r) - min(r)) * (max(c) - min(c)) AS area FROM dots GROUP BY 1),
p AS (SELECT x.gene, count(*) AS met FROM dots x JOIN dots y ON x.gene = y.gene AND (x.r - y.r) * (x.r - y.r) + (x.c - y.c) * (x.c - y.c) <= 1 GROUP BY 1)
SELECT gene, n, met - n AS pairs, round(area * (met - n) / (n * (n - 1)) / (pi() * CAST(1 AS DOUBLE)) * n, 6) AS clusteredness FROM g JOIN p USING (gene)"""
)
def clusteredness(spark, d):
    """How much closer than by chance the dots of a gene lie to one another."""
    found = affine.clusteredness(_dots(spark, d), 1.0, RC, ["gene"])
    return found.withColumn("clusteredness", F.round("clusteredness", 6))


def _trimming(rounds: int) -> str:
    """Bounds b0, b1, ... of a gene's values, each three deviations around the mean of what the one before has left."""
    steps = ["b0 AS MATERIALIZED (SELECT DISTINCT event_type AS gene, CAST('-Infinity' AS DOUBLE) AS lo, CAST('Infinity' AS DOUBLE) AS hi FROM events)"]
    for k in range(rounds):
        steps.append(
            f"b{k + 1} AS MATERIALIZED (SELECT gene, greatest(any_value(lo), avg(value) - 3 * stddev_pop(value)) AS lo, least(any_value(hi), avg(value) + 3 * stddev_pop(value)) AS hi FROM b{k} JOIN events ON event_type = gene AND value BETWEEN lo AND hi GROUP BY 1)"
        )
    return ", ".join(steps)


@_query(f"WITH {_trimming(31)} SELECT gene, median(value) AS median, count(*) AS n FROM b31 JOIN events ON event_type = gene AND value BETWEEN lo AND hi GROUP BY 1")
def trimmed_medians(spark, d):
    """Median of each gene's values, without what lies beyond three deviations, again and again."""
    return alignment.trimmed_medians(_table(spark, d, "events").select(F.col("event_type").alias("gene"), "value"), "value", ["gene"])


@_query(
    f"""WITH {_TILES}, {_PIXELS}, o AS (SELECT fov_num + 1 AS fov_num, obj_id, avg(r) AS r, avg(c) AS c, count(*) AS n, min(r) AS r0, max(r) AS r1, min(c) AS c0, max(c) AS c1 FROM pixels GROUP BY 1, 2)
SELECT o.fov_num, obj_id, n, t.r + (50 - o.r) AS centre_r, t.c + o.c AS centre_c, t.r + (50 - r1) AS r_low, t.r + (50 - r0) AS r_high, t.c + c0 AS c_low, t.c + c1 AS c_high FROM o LEFT JOIN tiles t ON t.fov_num = o.fov_num"""
)
def stitched_objects(spark, d):
    """Centroids of objects on the canvas, and the box of their stitched pixels."""
    pixels = _pixels(spark, d).withColumn("fov_num", F.col("fov_num") + 1)
    moved, centres = geometry.stitch_objects(pixels, _tiles(spark, d), "bottom-left", 60, 50)
    r, c = "r_px_stitched", "c_px_stitched"
    box = moved.groupBy("fov_num", "obj_id").agg(F.min(r).alias("r_low"), F.max(r).alias("r_high"), F.min(c).alias("c_low"), F.max(c).alias("c_high"))
    return centres.select("fov_num", "obj_id", "n", F.col(r).alias("centre_r"), F.col(c).alias("centre_c")).join(box, ["fov_num", "obj_id"])


@_query(f"WITH {_DOTS} SELECT dot_id, nullif(gene, 'click') AS target_name, r, c FROM dots WHERE gene <> 'click'")
def serial_extract(spark, d):
    """Dots of serial rounds that have a target."""
    dots = _dots(spark, d).withColumn("target_name", F.nullif("gene", F.lit("click")))
    return selection.serial_extract(dots, ["dot_id", "target_name", "r", "c"])


_PLANES = "planes AS (SELECT 'ch' || CAST((event_id // 16) % 2 AS VARCHAR) AS channel, user_id // 8 AS r, event_id % 8 AS c, event_id AS plane, CAST(value AS DOUBLE) AS value FROM events)"


def _planes(spark, d) -> DataFrame:
    """Planes of a stack: every event lights one pixel of its channel."""
    e = F.col("event_id")
    return _table(spark, d, "events").select(F.concat(F.lit("ch"), (F.floor(e / 16) % 2).cast("string")).alias("channel"), F.floor(F.col("user_id") / 8).alias("r"), (e % 8).alias("c"), e.alias("plane"), F.col("value").cast("double").alias("value"))


@_query(f"WITH {_PLANES}, dark AS (SELECT channel, r, c, median(value) AS dark FROM planes GROUP BY ALL) SELECT plane, round(greatest(value - dark, 0), 6) AS value FROM planes JOIN dark USING (channel, r, c)")
def dark_subtracted(spark, d):
    """Planes less the median of each pixel over all of its channel's planes."""
    planes = _planes(spark, d)
    return images.without_dark(planes, images.dark_pixels(planes)).select("plane", F.round("value", 6).alias("value"))


def _beads(spark, d) -> DataFrame:
    """Dots spread out to beads, some 40 pixels apart, with a number of their own inside them."""
    k = F.col("event_id")
    return _table(spark, d, "events").select(k.alias("dot_id"), (k % 6).cast("int").alias("fov_num"), (F.col("user_id") * 40 + k * 37 % 40).cast("double").alias("r"), (F.col("value") * 40).cast("double").alias("c"))


@_query("SELECT CAST(event_id % 6 AS INT) AS fov_num, CAST(0.66 AS DOUBLE) AS scale, CAST(0.5 AS DOUBLE) AS degrees, count(*) AS n FROM events WHERE event_id % 6 > 1 GROUP BY 1")
def affine_fit(spark, d):
    """All beads against a copy that is turned, scaled and moved, in which those of two tiles lie elsewhere: beads of each tile that the fit brings to within half a pixel of their copy."""
    beads = _beads(spark, d)
    # the wrong third is mirrored, so that it neither fits nor gives itself away by its box
    high = F.broadcast(beads.agg(F.max("r").alias("high")))
    copies = beads.join(high).withColumn("r", F.when(F.col("fov_num") > 1, F.col("r")).otherwise(F.col("high") - F.col("r")))
    r, c = alignment.transform_columns(F.col("r"), F.col("c"), 0.66, 0.5, (0.0, 0.0), (120.0, -40.0))
    target = copies.select("dot_id", r.alias("r"), c.alias("c"))
    fit = affine.fit_affine(target, beads, [0.6 + 0.01 * i for i in range(13)], [-2 + 0.5 * i for i in range(9)], radius=200)
    moved = alignment.apply_affine(beads, fit, RC).join(target.withColumnsRenamed({"r": "tr", "c": "tc"}), "dot_id")
    near = moved.filter((spatial.squared(F.col("r_transformed"), F.col("c_transformed"), F.col("tr"), F.col("tc")) < 0.25) & (F.col("fov_num") > 1))
    return near.groupBy("fov_num").agg(F.lit(round(fit["scale"], 5)).alias("scale"), F.lit(round(fit["degrees"], 4)).alias("degrees"), F.count("*").alias("n"))


def _bayes_sql(width: float) -> str:
    """Histograms, densities of a kernel of deviation ``width``, and the posterior of every code of the book, as tables."""
    sixteen = lambda form, by=" + ": by.join(form.format(i=i) for i in range(16))
    reach = width * 2048 * 5**0.5
    weight = sum(1 - (d / reach) ** 2 for d in range(-int(reach), int(reach) + 1)) / 2048
    return f"""WITH {_BOOK}, n AS (SELECT gene, code_bits, row_number() OVER (ORDER BY code_idx) - 1 AS place FROM book),
raw AS (SELECT event_id AS ref, gene, code_bits, {sixteen("((code_bits >> {i}) & 1) * CAST(0.8 AS DOUBLE) + (event_id * (7919 + 1047 * {i}) + 31 * {i}) % 1000 / CAST(900 AS DOUBLE) AS v{i}", ", ")} FROM events JOIN n ON event_id % (SELECT count(*) FROM book) = place),
sized AS (SELECT *, sqrt({sixteen("v{i} * v{i}")}) AS norm FROM raw),
bits AS (SELECT ref, bit, (code_bits >> bit) & 1 AS own, x FROM ({sixteen("SELECT ref, code_bits, {i} AS bit, v{i} / norm AS x FROM sized", " UNION ALL ")})),
counts AS (SELECT bit, state, least(CAST(floor((x + 1) * 2048) AS INT), 4095) AS cell, count(*) AS n FROM (SELECT bit, x, 'all' AS state FROM bits UNION ALL SELECT bit, x, CASE WHEN own = 1 THEN 'on' ELSE 'off' END FROM bits) GROUP BY ALL),
totals AS (SELECT bit, state, sum(n) AS n FROM counts GROUP BY ALL),
dens AS (SELECT bit, state, cell + d AS i, sum(c.n * (1 - d * d / CAST({reach * reach!r} AS DOUBLE))) / (CAST({weight!r} AS DOUBLE) * any_value(t.n)) AS y FROM counts c JOIN totals t USING (bit, state), range(-{int(reach)}, {int(reach)} + 1) v(d) GROUP BY ALL),
ends AS (SELECT bit, state, min(i) AS lo, max(i) AS hi FROM dens GROUP BY ALL),
placed AS (SELECT *, (x + 1) * 2048 - 0.5 AS pos, CAST(floor((x + 1) * 2048 - 0.5) AS INT) AS i FROM bits),
looked AS (SELECT ref, bit, state, ln(CASE WHEN pos BETWEEN lo AND hi THEN greatest(coalesce(p.y, 0) * (1 - (pos - b.i)) + coalesce(q.y, 0) * (pos - b.i), 1e-300::DOUBLE) ELSE 1e-6::DOUBLE END) AS l
  FROM placed b CROSS JOIN (VALUES ('all'), ('on'), ('off')) s(state) LEFT JOIN ends USING (bit, state) LEFT JOIN dens p ON p.bit = b.bit AND p.state = s.state AND p.i = b.i LEFT JOIN dens q ON q.bit = b.bit AND q.state = s.state AND q.i = b.i + 1),
sides AS (SELECT ref, bit, max(l) FILTER (WHERE state = 'on') - max(l) FILTER (WHERE state = 'off') AS more, max(l) FILTER (WHERE state = 'off') - max(l) FILTER (WHERE state = 'all') + ln(0.5::DOUBLE) AS off FROM looked GROUP BY 1, 2),
wide AS (SELECT ref, sum(off) AS off, {sixteen("max(more) FILTER (WHERE bit = {i}) AS m{i}", ", ")} FROM sides GROUP BY 1),
scores AS MATERIALIZED (SELECT ref, gene, {sixteen("CASE WHEN code_bits & (1 << {i}) > 0 THEN m{i} ELSE 0 END")} AS l FROM wide, book),
best AS (SELECT ref, max(l) AS top, arg_max(gene, l) AS bayes_gene FROM scores GROUP BY 1),
shares AS (SELECT ref, any_value(bayes_gene) AS bayes_gene, 1 / sum(exp(l - top)) AS probability FROM scores JOIN best USING (ref) GROUP BY 1)
SELECT ref AS barcode_reference_dot_id, gene, bayes_gene, round(probability, 6) AS probability FROM shares JOIN raw USING (ref) WHERE probability >= 0.5"""


def _lit_codes(spark, d) -> tuple[DataFrame, list[tuple[str, int]]]:
    """Events as spots of every code of the book in turn, dimmer and brighter than by their bits; and that book, a row a kind of part."""
    book = sorted(map(tuple, _codebook(spark, d).select("code_idx", "gene", "code_bits").collect()))
    numbered = spark.createDataFrame([(k, g, b) for k, (_, g, b) in enumerate(book)], "place long, gene string, code_bits long")
    spots = _table(spark, d, "events").withColumn("place", F.col("event_id") % len(book)).join(numbered, "place")
    bright = lambda i: F.getbit("code_bits", i) * F.lit(0.8) + (F.col("event_id") * (7919 + 1047 * i) + 31 * i) % 1000 / 900.0
    lit = F.array(*(bright(F.lit(i).cast("int")) for i in range(16)))
    rows = spots.select(F.col("event_id").alias("barcode_reference_dot_id"), "code_bits", F.lit(0.0).alias("hamming_distance"), "gene", lit.alias("bit_intensity"))
    return rows, [(g, b) for _, g, b in book]


@_query(_bayes_sql(0.03))
def bayes_calls(spark, d):
    """Barcode calls of spots whose bits overlap in intensity, by kernel densities of a given width."""
    rows, book = _lit_codes(spark, d)
    called = bayes.call_bayes(rows, bayes.fit_bayes(rows, 16, 0.03), book, 16)
    return called.select("barcode_reference_dot_id", "gene", "bayes_gene", F.round("probability", 6).alias("probability"))


@_query()
def bayes_diffusion_calls(spark, d):
    """The same calls by densities whose widths the diffusion estimate finds for each bit and state."""
    rows, book = _lit_codes(spark, d)
    called = bayes.call_bayes(rows, bayes.fit_bayes(rows, 16), book, 16)
    return called.select("barcode_reference_dot_id", "gene", "bayes_gene", F.round("probability", 6).alias("probability"))
