"""Scalar functions: barcodes as bits, pixel values, names, thresholds along a curve."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def parse_codeword(text: Column) -> Column:
    """'[0101]' -> array<tinyint>"""
    digits = F.regexp_extract(text, r"\[?([01]+)\]?$", 1)
    return F.transform(F.filter(F.split(digits, ""), lambda d: d != ""), lambda d: d.cast("tinyint"))


def pack_bits(code: Column) -> Column:
    """array of 0 and 1 -> long; bit k - 1 is round k."""
    marked = F.transform(code, lambda b, i: F.when(b > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(marked, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


def unpack_bits(bits: Column, length: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda i: F.call_function("shiftright", bits, i).bitwiseAND(F.lit(1).cast("long")).cast("tinyint"))


def positive_bits(bits: Column) -> Column:
    return F.bit_count(bits).cast("bigint")


def hamming(a: Column, b: Column, length: int) -> Column:
    """The share of bits that differ."""
    return F.bit_count(a.bitwiseXOR(b)) / F.lit(length)


def flips(raw: Column, code: Column, length: int) -> Column:
    """array of (position, direction) where the observed bits differ from the codeword's: direction = codeword - observed."""
    at = F.filter(F.sequence(F.lit(0), F.lit(length - 1)), lambda i: F.call_function("shiftright", raw.bitwiseXOR(code), i).bitwiseAND(F.lit(1).cast("long")) == 1)
    bit = lambda x, i: F.call_function("shiftright", x, i).bitwiseAND(F.lit(1).cast("long")).cast("int")
    return F.transform(at, lambda i: F.struct(i.alias("position"), (bit(code, i) - bit(raw, i)).alias("direction")))


def tiers(gene: Column, distance: Column, length: int) -> dict[str, Column]:
    """The gene at exact codes, and at fewer than two and three wrong bits."""
    return {
        "zero_genes": F.when(distance == 0, gene),
        "below2_genes": F.when(distance < 2 / length, gene),
        "below3_genes": F.when(distance < 3 / length, gene),
    }


def round_of(name: Column) -> Column:
    """'..._Hybridization07' -> 7"""
    return F.element_at(F.split(name, "Hybridization"), -1).cast("int")


def count_code(name: Column) -> Column:
    return F.regexp_extract(name, r"(Count\d{5})", 1)


def to_unit(pixel: Column) -> Column:
    return pixel / F.lit(65535.0)


def to_uint16(value: Column) -> Column:
    """Clipped to [0, 1] and rounded half to even, as image libraries do."""
    return F.rint(F.greatest(F.least(value, F.lit(1.0)), F.lit(0.0)) * 65535).cast("int")


def to_uint16_truncated(value: Column) -> Column:
    return (F.greatest(F.least(value, F.lit(1.0)), F.lit(0.0)) * 65535).cast("int")


def none_to_null(text: Column) -> Column:
    return F.when(text == "None", F.lit(None)).otherwise(text)


def nan_to_null(value: Column) -> Column:
    return F.when(F.isnan(value), F.lit(None)).otherwise(value)


def elapsed(seconds: float) -> str:
    """'1 d 2 h 3 min 4 s' without leading zero parts."""
    parts, rest = [], int(seconds)
    for size, unit in ((86_400, "d"), (3_600, "h"), (60, "min")):
        n, rest = divmod(rest, size)
        if n or parts:
            parts.append(f"{n} {unit}")
    return " ".join([*parts, f"{rest} s"])


def gradient(df: DataFrame, value: str, order: str, by: list[str] | None = None, out: str = "gradient") -> DataFrame:
    """Central differences along ``order``, one-sided at both ends; null for a single row."""
    w = Window.partitionBy(*(by or [])).orderBy(order)
    here, before, after = F.col(value), F.lag(value).over(w), F.lead(value).over(w)
    return df.withColumn(out, F.coalesce((after - before) / 2, (after - here).cast("double"), (here - before).cast("double")))


def elbow(df: DataFrame, x: str, y: str, by: list[str]) -> DataFrame:
    """Per group: the row, after the first minimum of ``y`` and without both ends, farthest from their chord."""
    grouped = Window.partitionBy(*by)
    start = F.min(F.struct(F.col(y), F.col(x))).over(grouped)[x]
    tail = df.withColumn("_x0", start).filter(F.col(x) >= F.col("_x0"))
    whole = grouped.orderBy(x).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = tail.withColumns({"_y0": F.first(y).over(whole), "_x1": F.last(x).over(whole), "_y1": F.last(y).over(whole)})
    dx, dy = F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0")
    away = F.abs(dx * (F.col("_y0") - F.col(y)) - (F.col("_x0") - F.col(x)) * dy) / F.sqrt(dx * dx + dy * dy)
    inner = ends.withColumn("distance", away).filter((F.col(x) > F.col("_x0")) & (F.col(x) < F.col("_x1")))
    best = Window.partitionBy(*by).orderBy(F.desc("distance"), x)
    return inner.withColumn("_k", F.row_number().over(best)).filter("_k = 1").select(*by, x, y, "distance")
