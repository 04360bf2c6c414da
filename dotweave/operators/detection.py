"""Detection on sparse pixels: objects as connected runs, their sizes, and peaks inside them.

Pixels are rows (image columns, r, c, value); absent ones are background. Nothing is done an image at a time: runs are made by
windows over image rows, objects by joins of runs and connected components, sizes by aggregates, peaks by joins inside objects of
bounded size. So neither an image's size nor its number of objects has to fit into a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.lineage import cut
from .graphs import components

#: Columns of a strip in which the runs of two rows meet.
STRIP = 64


def runs(pixels: DataFrame, by: list[str]) -> DataFrame:
    """``by``, r, first, last, n: unbroken runs of pixels in an image row."""
    row = Window.partitionBy(*by, "r").orderBy("c")
    grouped = pixels.select(*by, "r", "c").distinct().withColumn("_g", F.col("c") - F.row_number().over(row))
    return grouped.groupBy(*by, "r", "_g").agg(F.min("c").alias("first"), F.max("c").alias("last"), F.count("*").alias("n")).drop("_g")


def _numbered(pixels: DataFrame, by: list[str], diagonal: bool) -> DataFrame:
    """:func:`runs` with ``object``, the number of one of its object's runs: rounds over numbers shuffle far less than names would."""
    made = cut(runs(pixels, by).withColumn("node", F.monotonically_increasing_id()))
    reach = 1 if diagonal else 0
    strips = lambda lo, hi: F.explode(F.sequence(F.floor(lo / STRIP), F.floor(hi / STRIP)))
    upper = made.select(*by, (F.col("r") + 1).alias("r"), F.col("first").alias("uf"), F.col("last").alias("ul"), F.col("node").alias("a"), strips(F.col("first") - reach, F.col("last") + reach).alias("_s"))
    lower = made.select(*by, "r", "first", "last", F.col("node").alias("b"), strips(F.col("first"), F.col("last")).alias("_s"))
    touching = upper.join(lower, [*by, "r", "_s"]).filter((F.col("first") <= F.col("ul") + reach) & (F.col("last") >= F.col("uf") - reach)).select("a", "b").distinct()
    return made.join(components(touching), "node", "left").withColumn("object", F.coalesce("root", "node")).drop("node", "root")


def objects(pixels: DataFrame, by: list[str], diagonal: bool = True) -> DataFrame:
    """:func:`runs` with ``object``, the (image, row, first column) of its object's first run: runs that touch across rows are one object."""
    numbered = _numbered(pixels, by, diagonal)
    names = numbered.groupBy("object").agg(F.min(F.struct(*by, "r", "first")).alias("_name"))
    return numbered.join(names, "object").withColumn("object", F.col("_name")).select(*by, "r", "first", "last", "n", "object")


def object_sizes(labelled: DataFrame) -> DataFrame:
    """``object``, n of :func:`objects`: runs carry their lengths, so no pixel is touched."""
    return labelled.groupBy("object").agg(F.sum("n").alias("n"))


def peaks(pixels: DataFrame, by: list[str], min_distance: int, min_size: int, max_size: int, per_object: int | None = None, frame: tuple[int, int] | None = None, diagonal: bool = False) -> DataFrame:
    """``by``, r, c, value, size of the brightest pixels of objects of fitting size.

    ``pixels`` are those above the threshold. A pixel is a peak if no pixel of its object within ``min_distance`` rows and
    columns is brighter; of an object's peaks the ``per_object`` brightest stay (ties to the first row, then column).
    With ``frame`` (rows, columns) peaks within ``min_distance`` of an edge are left out.
    """
    labelled = cut(_numbered(pixels, by, diagonal))
    fits = object_sizes(labelled).filter(F.col("n").between(min_size, max_size)).select("object", F.col("n").alias("size"))
    cells = labelled.join(fits, "object").select("object", "size", *by, "r", F.explode(F.sequence("first", "last")).alias("c"))
    lit = cut(cells.join(pixels.groupBy(*by, "r", "c").agg(F.max("value").alias("value")), [*by, "r", "c"]))
    # an object has at most max_size pixels, so these pairs are bounded
    other = lit.select("object", F.col("r").alias("_r"), F.col("c").alias("_c"), F.col("value").alias("_v"))
    near = (F.abs(F.col("r") - F.col("_r")) <= min_distance) & (F.abs(F.col("c") - F.col("_c")) <= min_distance)
    brighter = lit.join(other, "object").filter(near & (F.col("_v") > F.col("value"))).select("object", "r", "c").distinct()
    found = lit.join(brighter, ["object", "r", "c"], "left_anti")
    if frame:
        found = found.filter(F.col("r").between(min_distance, frame[0] - min_distance - 1) & F.col("c").between(min_distance, frame[1] - min_distance - 1))
    if per_object:
        best = Window.partitionBy("object").orderBy(F.desc("value"), "r", "c")
        found = found.withColumn("_k", F.row_number().over(best)).filter(F.col("_k") <= per_object)
    return found.select(*by, "r", "c", "value", "size")
