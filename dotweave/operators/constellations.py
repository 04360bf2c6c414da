"""Matching point sets by their neighbourhoods: distance signatures, triangles, and a robust similarity fit."""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.lineage import cut
from .spatial import radius_join


#: Hypotheses of all groups that every task is handed; more are joined with the matches by group.
HANDED = 100_000


def signatures(points: DataFrame, k: int, radius: float, rc: tuple[str, str], key: str, by: list[str]) -> DataFrame:
    """``by, key, r, c, signature``: ascending distances to the k nearest points of the same group within ``radius``; points with fewer are left out."""
    slim = points.select(*by, key, *rc)
    pairs = radius_join(slim, slim, radius, rc, rc, by).filter(F.col(key) != F.col(f"r_{key}"))
    near = pairs.withColumn("_k", F.row_number().over(Window.partitionBy(*by, key).orderBy("d2", f"r_{key}"))).filter(F.col("_k") <= k)
    made = near.groupBy(*by, key, *rc).agg(F.sort_array(F.collect_list(F.sqrt("d2"))).alias("signature"))
    return made.filter(F.size("signature") == k)


def matches(a: DataFrame, b: DataFrame, tolerance: float, key: str, by: list[str], rc: tuple[str, str], cells: int = 1) -> DataFrame:
    """Pairs whose signatures differ by at most ``tolerance`` in every distance, the closest of each point of ``a``.

    Signatures meet in cells of their first ``cells`` distances, an equi-join, and equal ones count as one: of ``b`` the smallest
    ``key`` stands for them. Cells are small at first: a match whose distances differ by less than a cell's side in sum can't be
    bettered by one in a farther cell, so only signatures without such a match go on to larger cells, the last as large as the tolerance.
    """
    right = cut(b.groupBy(*by, F.col("signature").alias("r_signature")).agg(F.min(F.struct(key, *rc)).alias("_b")))
    left, done = cut(a.select(*by, "signature").distinct()), []
    places = [f"_s{i}" for i in range(cells)]
    offsets = F.array(*[F.array(*map(F.lit, o)) for o in product((-1, 0, 1), repeat=cells)])
    off = F.zip_with("signature", "r_signature", lambda x, y: F.abs(x - y))
    for parts in (32, 8, 2, 1):
        side = tolerance / parts
        at = lambda column, i: F.floor(F.col(column)[i] / side)  # noqa: B023, E731
        spread = right.withColumn("_o", F.explode(offsets)).select(*by, "r_signature", "_b", *((at("r_signature", i) + F.col("_o")[i]).alias(x) for i, x in enumerate(places)))
        joined = left.withColumns({x: at("signature", i) for i, x in enumerate(places)}).join(spread, [*by, *places])
        near = joined.withColumns({"worst": F.array_max(off), "total": F.aggregate(off, F.lit(0.0), lambda x, y: x + y)}).filter(F.col("worst") <= tolerance)
        found = near.groupBy(*by, "signature").agg(F.min(F.struct("total", "_b")).alias("_m"))
        # a little less than the side, for rounding
        sure = cut(found.filter(F.col("_m.total") <= side * 0.999) if parts > 1 else found)
        done.append(sure)
        if parts == 1:
            break
        left = cut(left.join(sure.select(*by, "signature"), [*by, "signature"], "left_anti"))
        if left.isEmpty():
            break
    best = reduce(lambda x, y: x.unionByName(y), done)
    return a.join(best, [*by, "signature"]).select(*by, key, F.col(f"_m._b.{key}").alias(f"r_{key}"), *rc, *(F.col(f"_m._b.{x}").alias(f"r_{x}") for x in rc), F.col("_m.total").alias("total"))


def hypotheses(found: DataFrame, by: list[str], rc: tuple[str, str], trials: int = 64, order: tuple[str, ...] = ()) -> DataFrame:
    """``by, trial, p, q, tr, tc``: similarities through two matches each, r' = p r - q c + tr and c' = q r + p c + tc.

    The matches of a trial are the next two by the digest of ``order`` (of the coordinates, where none is given), so the table is
    the same on every run; it has at most ``trials`` rows a group. Ranks of so few rows are cut before the shuffle.
    """
    r, c, rr, rc_ = (F.col(x) for x in _coordinates(rc))
    digest = F.md5(F.concat_ws(":", *(order or _coordinates(rc))))
    pick = Window.partitionBy(*by).orderBy(digest, r, c, rr, rc_)
    drawn = found.withColumn("_n", F.row_number().over(pick)).filter(F.col("_n") <= 2 * trials)
    pairs = drawn.groupBy(*by, F.floor((F.col("_n") - 1) / 2).cast("int").alias("trial")).agg(
        *(F.min_by(x, "_n").alias(f"_{i}0") for i, x in enumerate((r, c, rr, rc_))), *(F.max_by(x, "_n").alias(f"_{i}1") for i, x in enumerate((r, c, rr, rc_)))
    )
    dr, dc, er, ec = (F.col(f"_{i}1") - F.col(f"_{i}0") for i in range(4))
    made = pairs.withColumn("_d", dr * dr + dc * dc).filter(F.col("_d") > 0)
    made = made.withColumns({"p": (dr * er + dc * ec) / F.col("_d"), "q": (dr * ec - dc * er) / F.col("_d")})
    offset = {"tr": F.col("_20") - F.col("p") * F.col("_00") + F.col("q") * F.col("_10"), "tc": F.col("_30") - F.col("q") * F.col("_00") - F.col("p") * F.col("_10")}
    return made.withColumns(offset).select(*by, "trial", "p", "q", "tr", "tc")


def _coordinates(rc: tuple[str, str]) -> tuple[str, ...]:
    return *rc, *(f"r_{x}" for x in rc)


def group_similarities(found: DataFrame, by: list[str], rc: tuple[str, str], tolerance: float, trials: int = 64, order: tuple[str, ...] = ()) -> DataFrame:
    """``by, scale, degrees, dr, dc, inliers``: the similarity of each group's matches (``rc`` onto ``r_`` ``rc``) that most of them agree with.

    Every match votes on every hypothesis of its group; the one with most inliers (ties: the first trial) names the inliers, and
    its refit is a sum over them, so no group meets in one task. Matches with a null coordinate take no part; groups of fewer
    than three matches, and such without two apart, have nulls and no inliers.
    """
    r, c, rr, rc_ = (F.col(x) for x in _coordinates(rc))
    rows = found.dropna(subset=list(_coordinates(rc))).select(*dict.fromkeys((*by, *_coordinates(rc), *order)))
    guesses = cut(hypotheses(rows, by, rc, trials, order).select(*by, *(F.col(x).alias(f"_{x}") for x in ("trial", "p", "q", "tr", "tc"))))
    # few groups have all of their matches in a few tasks, if matches are dealt by group
    handed = F.broadcast if guesses.count() <= HANDED else lambda x: x
    p, q, tr, tc = (F.col(f"_{x}") for x in ("p", "q", "tr", "tc"))
    away, aside = p * r - q * c + tr - rr, q * r + p * c + tc - rc_
    fits = away * away + aside * aside <= tolerance * tolerance
    votes = _join_groups(rows, handed(guesses), by).filter(fits).groupBy(*by, "_trial").agg(F.count(F.lit(1)).alias("_n"))
    first = cut(votes.groupBy(*by).agg(F.max_by("_trial", F.struct("_n", -F.col("_trial"))).alias("_trial")))
    best = _join_groups(guesses, first, [*by, "_trial"])
    inner = _join_groups(rows, handed(best), by).filter(fits)
    den = F.var_pop(r) + F.var_pop(c)
    p, q = (F.covar_pop(r, rr) + F.covar_pop(c, rc_)) / F.nullif(den, F.lit(0.0)), (F.covar_pop(r, rc_) - F.covar_pop(c, rr)) / F.nullif(den, F.lit(0.0))
    sums = inner.groupBy(*by).agg(p.alias("_p"), q.alias("_q"), *(F.avg(x).alias(f"_m{i}") for i, x in enumerate((r, c, rr, rc_))), F.count(F.lit(1)).alias("_n"))
    enough = found.groupBy(*by).agg(F.count(F.when(r.isNotNull() & c.isNotNull() & rr.isNotNull() & rc_.isNotNull(), 1)).alias("_all"))
    ok = (F.col("_all") >= 3) & (F.col("_n") >= 2)
    p, q, m = F.col("_p"), F.col("_q"), [F.col(f"_m{i}") for i in range(4)]
    return _join_groups(enough, sums, by, "left").select(
        *by,
        F.when(ok, F.sqrt(p * p + q * q)).alias("scale"),
        F.when(ok, F.degrees(F.atan2(q, p))).alias("degrees"),
        F.when(ok, m[2] - p * m[0] + q * m[1]).alias("dr"),
        F.when(ok, m[3] - q * m[0] - p * m[1]).alias("dc"),
        F.when(ok, F.col("_n")).otherwise(0).cast("long").alias("inliers"),
    )


def _join_groups(left: DataFrame, right: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """Join on ``by`` where nulls are equal."""
    named = right.withColumnsRenamed({k: f"_by_{k}" for k in by})
    on = [F.col(k).eqNullSafe(F.col(f"_by_{k}")) for k in by]
    return left.join(named, on, how).drop(*(f"_by_{k}" for k in by))


def triangles(points: DataFrame, radius: float, rc: tuple[str, str], key: str, by: list[str]) -> DataFrame:
    """``by``, the ids p < q < s of three points within ``radius`` of each other, and ``sides``, ascending."""
    slim = points.select(*by, key, *rc)
    pairs = radius_join(slim, slim, radius, rc, rc, by).filter(F.col(key) < F.col(f"r_{key}")).select(*by, F.col(key).alias("p"), F.col(f"r_{key}").alias("q"), F.sqrt("d2").alias("d"))
    ps = pairs.select(*by, "p", F.col("q").alias("s"), F.col("d").alias("d_ps"))
    qs = pairs.select(*by, F.col("p").alias("q"), F.col("q").alias("s"), F.col("d").alias("d_qs"))
    return pairs.join(ps, [*by, "p"]).filter("q < s").join(qs, [*by, "q", "s"]).select(*by, "p", "q", "s", F.sort_array(F.array("d", "d_ps", "d_qs")).alias("sides"))


def triangle_matches(a: DataFrame, b: DataFrame, by: list[str], tolerance: float = 1.0) -> DataFrame:
    """For each triangle of ``a`` the one of ``b`` whose sides differ least in sum, below ``tolerance``; ``error`` is that sum."""
    right = b.select(*by, *(F.col(x).alias(f"r_{x}") for x in ("p", "q", "s", "sides"))).withColumn("_s", F.explode(F.array(*[F.floor(F.col("r_sides")[0] / tolerance) + i for i in (-1, 0, 1)])))
    joined = a.withColumn("_s", F.floor(F.col("sides")[0] / tolerance)).join(right, [*by, "_s"])
    error = F.aggregate(F.zip_with("sides", "r_sides", lambda x, y: F.abs(x - y)), F.lit(0.0), lambda x, y: x + y)
    best = Window.partitionBy(*by, "p", "q", "s").orderBy("error", "r_p", "r_q", "r_s")
    return joined.withColumn("error", error).filter(F.col("error") < tolerance).withColumn("_k", F.row_number().over(best)).filter("_k = 1").drop("_k", "_s")


def registration_groups(files: DataFrame, channel: str, path: str = "path") -> DataFrame:
    """fov_num, the files of the registration channel and the other files of each tile, by their names."""
    fov = F.regexp_extract(path, r"_fov_(\d+)", 1)
    own = F.regexp_extract(path, r"channel_([^_]+)_fov_", 1) == channel
    named = files.filter(fov != "").groupBy(fov.cast("int").alias("fov_num"))
    return named.agg(F.sort_array(F.collect_list(F.when(own, F.col(path)))).alias("reference"), F.sort_array(F.collect_list(F.when(~own, F.col(path)))).alias("others"))
