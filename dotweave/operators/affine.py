"""Scale, angle and offset that bring one set of points onto another, found by votes.

A guess maps a source point x to ``scale * R(degrees) (x - seat) + pin``: the pin is a place of the target, the seat
the place of the source that comes to lie there. Both sets are counted in cells of side ``bins``, the source once for
each guess, and cells meet in a grid join; a pair of cells votes, with the product of its counts, for the offset that
still parts them. What is shuffled is counts of cells, never pairs of points, and a place that holds very many
points is one row.

The search goes from coarse to fine. First only a window around the pin takes part, so small that half a step of scale
or angle moves its edge by half a cell and that it holds about a thousand points; each further level widens the
window around the best guesses and halves the steps that are too wide for it, until the window holds the target. These levels count
votes in each part of the window apart, and a part tells what the neighbours of a guess would have got there, as a step of
scale or angle moves all of a part alike. So the grid of guesses never meets all points: they are placed once for each of the
few guesses that are left, mostly one. Where the votes of the parts lie then gives scale, angle and offset
to less than a cell, and the nearest neighbours under the winner give them in closed form, from sums.

The driver holds the guesses (``scales x degrees`` at most) and a few rows of each level; points stay in their tables.
Null or non-finite coordinates take no part; ties go to the earlier guess; sets that nothing can be said of give None.
"""

from __future__ import annotations

from math import atan2, ceil, cos, degrees as to_degrees, hypot, radians, sin

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spatial

RC = ("r", "c")
#: Guesses that each level hands on.
BEAM = 2
#: Parts of a side of the window that vote apart.
PARTS = 8
#: Cells that a part sees an offset of, in each direction: two of the offset and two of scale and angle.
SEEN = 4
#: Target points in the first window, about.
ENOUGH = 1_000
#: Bins of a side of the histogram that tells how evenly a chunk is filled.
EVEN = 30


def _points(df: DataFrame, rc: tuple[str, str]) -> DataFrame:
    r, c = (F.col(x).cast("double") for x in rc)
    most = F.lit(1.7e308)
    return df.select(r.alias("r"), c.alias("c")).filter((F.abs("r") < most) & (F.abs("c") < most))


def _box(points: DataFrame) -> dict | None:
    row = points.agg(
        *(f(x).alias(f"{f.__name__}_{x}") for x in RC for f in (F.min, F.max, F.avg)), F.count("*").alias("n")
    ).first()
    return row.asDict() if row["n"] else None


def _middle(box: dict) -> tuple[float, float]:
    return tuple((box[f"min_{x}"] + box[f"max_{x}"]) / 2 for x in RC)


def _turned_middles(points: DataFrame, angles: list[float]) -> dict[float, tuple[float, float]]:
    """For each angle, the middle of the box of the turned points, turned back. A turned set has the turned middle only if its box is turned too."""
    turns = ", ".join(f"struct({a!r}D AS a, {cos(radians(a))!r}D AS x, {sin(radians(a))!r}D AS y)" for a in angles)
    t = points.select("r", "c", F.explode(F.expr(f"array({turns})")).alias("t"))
    t = t.select("t.a", (F.col("t.x") * F.col("r") - F.col("t.y") * F.col("c")).alias("r"), (F.col("t.y") * F.col("r") + F.col("t.x") * F.col("c")).alias("c"))
    rows = t.groupBy("a").agg(*(f(x).alias(f"{f.__name__}_{x}") for x in RC for f in (F.min, F.max))).collect()
    return {row["a"]: _turned(_middle(row.asDict()), 1.0, -row["a"]) for row in rows}


def _turned(v: tuple[float, float], scale: float, angle: float) -> tuple[float, float]:
    a, b = scale * cos(radians(angle)), scale * sin(radians(angle))
    return a * v[0] - b * v[1], b * v[0] + a * v[1]


def _seat(seat: tuple[float, float], scale: float, angle: float, offset: tuple[float, float]) -> tuple[float, float]:
    """The seat of a guess that is moved by ``offset``."""
    d = _turned(offset, 1 / scale, -angle)
    return seat[0] - d[0], seat[1] - d[1]


class Grid:
    """Overlapping windows over the box of a table: sides of ``size`` of the extent, less a step; ``density`` steps to ``size``."""

    def __init__(self, box: dict, size: float, density: int):
        if density < 2:
            raise ValueError("windows need a density of two at least")
        self.wide = density - 1
        extents = [box[f"max_{x}"] - box[f"min_{x}"] for x in RC]
        self.steps = [e * size / density or 1.0 for e in extents]
        self.starts = [box[f"min_{x}"] - self.wide * s for x, s in zip(RC, self.steps)]
        places = [ceil(e / s + 2 * density - 1) for e, s in zip(extents, self.steps)]
        self.counts = [p - self.wide for p in places]
        self.least = box["n"] / (places[0] * places[1])

    def side(self) -> float:
        return max(self.steps) * self.wide

    def windows(self, points: DataFrame) -> DataFrame:
        """Each point once for every window that it lies inside: i, j, r, c and ``u``, ``v``, its place in the window from 0 to 1."""
        out = points
        for x, k, place, s, start, n in zip(RC, "ij", "uv", self.steps, self.starts, self.counts):
            at = (F.col(x) - start) / s
            first, last = F.greatest(F.floor(at - self.wide) + 1, F.lit(0)), F.least(F.ceil(at) - 1, F.lit(n - 1))
            out = out.withColumn(k, F.explode(F.when(first <= last, F.sequence(first, last)))).withColumn(place, (at - F.col(k)) / self.wide)
        return out

    def centre(self, k: str, axis: int):
        return F.col(k) * self.steps[axis] + (self.starts[axis] + self.wide * self.steps[axis] / 2)


def chunks(points: DataFrame, size: float = 0.2, density: int = 4, least: float | None = None, rc: tuple[str, str] = RC) -> DataFrame:
    """The windows with more than ``least`` points (by default the mean number): i, j, r, c (centre), n, evenness.

    Evenness is n over the deviation of a histogram of 30 x 30 bins, so the best chunk is full and evenly filled.
    """
    points = _points(points, rc)
    box = _box(points)
    if not box:
        return points.sparkSession.createDataFrame([], "i long, j long, r double, c double, n long, evenness double")
    return _chunks(points, Grid(box, size, density), least)


def _chunks(points: DataFrame, grid: Grid, least: float | None) -> DataFrame:
    cell = lambda x: F.least(F.floor(F.col(x) * EVEN), F.lit(EVEN - 1))
    filled = grid.windows(points).groupBy("i", "j", cell("u").alias("u"), cell("v").alias("v")).agg(F.count("*").alias("n"))
    whole = filled.groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("squares"))
    kept = whole.filter(F.col("n") > (grid.least if least is None else least))
    mean = F.col("n") / EVEN**2
    return kept.select(
        "i", "j", grid.centre("i", 0).alias("r"), grid.centre("j", 1).alias("c"), "n",
        (F.col("n") / F.sqrt(F.col("squares") / EVEN**2 - mean * mean)).alias("evenness"),
    )


def guessed(source: DataFrame, guesses: list[tuple], reach: float) -> DataFrame:
    """``guess`` (place in the list of (scale, degrees, seat)), r and c from the pin, of each source point within ``reach`` of it by that guess."""
    turns = ", ".join(f"struct({s * cos(radians(a))!r}D, {s * sin(radians(a))!r}D, {seat[0]!r}D, {seat[1]!r}D)" for s, a, seat in guesses)
    # points that no guess can bring near the pin are not repeated
    far = reach * 2**0.5 / min(abs(s) for s, _, _ in guesses)
    for axis, x in enumerate(RC):
        seats = [g[2][axis] for g in guesses]
        source = source.filter(F.col(x).between(min(seats) - far, max(seats) + far))
    x, y = F.col("r") - F.col("g.col3"), F.col("c") - F.col("g.col4")
    moved = source.select("r", "c", F.posexplode(F.expr(f"array({turns})")).alias("guess", "g"))
    moved = moved.select("guess", (F.col("g.col1") * x - F.col("g.col2") * y).alias("r"), (F.col("g.col2") * x + F.col("g.col1") * y).alias("c"))
    return moved.filter((F.abs("r") <= reach) & (F.abs("c") <= reach))


def _met(target: DataFrame, moved: DataFrame, k: int, bins: float) -> DataFrame:
    """Pairs of cells up to ``k`` cells apart: guess, the moved cell i, j, the offset di, dj to the target's, and n, the product of their counts."""
    cell = lambda x: F.floor(F.col(x) / bins)
    one = target.groupBy(cell("r").alias("ti"), cell("c").alias("tj")).agg(F.count("*").alias("tn"))
    two = moved.groupBy("guess", cell("r").alias("i"), cell("c").alias("j")).agg(F.count("*").alias("m"))
    # blocks of cells: a cell of the target goes to all that it can meet a moved one in
    side = max(k, 8)
    near = lambda x: F.explode(F.sequence(F.floor((F.col(x) - k) / side), F.floor((F.col(x) + k) / side)))
    one = one.select("*", near("ti").alias("bi")).select("*", near("tj").alias("bj"))
    two = two.withColumns({"bi": F.floor(F.col("i") / side), "bj": F.floor(F.col("j") / side)})
    # few bytes make many pairs: the blocks keep to as many tasks as there are, whatever their size
    parts = int(target.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = one.repartition(parts, "bi", "bj").join(two.repartition(parts, "bi", "bj"), ["bi", "bj"]).withColumns({"di": F.col("ti") - F.col("i"), "dj": F.col("tj") - F.col("j")})
    return met.filter((F.abs("di") <= k) & (F.abs("dj") <= k)).select("guess", "i", "j", "di", "dj", (F.col("tn") * F.col("m")).alias("n"))


def votes(target: DataFrame, moved: DataFrame, radius: float, bins: float) -> DataFrame:
    """For each ``guess``: dr, dc (the offset with most votes), its votes ``n``, and ``z``, how far these stand out from the mean.

    Both sides have r and c from the pin. An offset has up to ``radius`` in each direction.
    """
    k = max(1, ceil(radius / bins))
    table = _met(target, moved, k, bins).groupBy("guess", "di", "dj").agg(F.sum("n").alias("n"))
    most = table.groupBy("guess").agg(F.max(F.struct("n", (-F.abs("di") - F.abs("dj")).alias("near"), "di", "dj")).alias("top"), (F.sum("n") / (2 * k + 1) ** 2).alias("mean"))
    z = (F.col("top.n") - F.col("mean")) / F.sqrt(F.col("mean") + 1)
    return most.select("guess", (F.col("top.di") * float(bins)).alias("dr"), (F.col("top.dj") * float(bins)).alias("dc"), F.col("top.n").alias("n"), z.alias("z"))


def _parted(target: DataFrame, moved: DataFrame, window: float, bins: float) -> dict[int, np.ndarray]:
    """For each guess, a row for each part of the window and offset of up to ``SEEN`` cells: part, di, dj, votes, and the mean r, c of the cells that gave them.

    At most ``PARTS**2 * (2 * SEEN + 1)**2`` rows a guess, however many points there are.
    """
    part = lambda x: F.least(F.greatest(F.floor((F.col(x) + 0.5) * (bins * PARTS / window) + PARTS / 2), F.lit(0)), F.lit(PARTS - 1))
    n = F.col("n").cast("double")
    table = _met(target, moved, SEEN, bins).groupBy("guess", (part("i") * PARTS + part("j")).alias("part"), "di", "dj")
    rows = table.agg(F.sum(n).alias("n"), *((F.sum(n * F.col(x)) / F.sum(n) * bins + bins / 2).alias(x) for x in "ij")).collect()
    found = {}
    for row in sorted(tuple(x) for x in rows):
        found.setdefault(row[0], []).append(row[1:])
    return {g: np.array(x, dtype=float) for g, x in found.items()}


def _around(rows: np.ndarray, ways: list[tuple[float, float]], bins: float) -> list[tuple]:
    """z, offset of what the points of a guess would have voted, had it been changed by each of ``ways``: its scale by a factor of 1 + u, its angle by w (radians)."""
    part, di, dj, n, r, c = rows.T
    _, part = np.unique(part.astype(int), return_inverse=True)
    k, wide = SEEN // 2, 2 * SEEN + 1
    total = np.bincount(part, n)
    r, c = (np.bincount(part, n * x) / total for x in (r, c))
    # a part moves as a whole, and offsets that were not seen have the votes of chance: neighbours differ by their points alone
    seen = np.zeros((len(total), wide, wide))
    seen[part, di.astype(int) + SEEN, dj.astype(int) + SEEN] = n
    seen = np.pad(seen, ((0, 0), (SEEN, SEEN), (SEEN, SEEN)))
    outside = np.ones(seen.shape[1:], dtype=bool)
    outside[SEEN:-SEEN, SEEN:-SEEN] = False
    seen += (total / wide**2)[:, None, None] * outside
    places = np.arange(-k, k + 1)
    found = []
    for u, w in ways:
        i, j = (np.clip(np.rint(x / bins).astype(int)[:, None] + places, -2 * SEEN, 2 * SEEN) + 2 * SEEN for x in (u * r - w * c, w * r + u * c))
        table = seen[np.arange(len(total))[:, None, None], i[:, :, None], j[:, None, :]].sum(axis=0).ravel()
        # of equal votes the nearest offset, then the greatest
        top = max(range(len(table)), key=lambda x: (table[x], -abs(x // (2 * k + 1) - k) - abs(x % (2 * k + 1) - k), x))
        mean = table.mean()
        found.append(((table[top] - mean) / (mean + 1) ** 0.5, ((top // (2 * k + 1) - k) * bins, (top % (2 * k + 1) - k) * bins)))
    return found


def _settled(rows: np.ndarray, u: float, w: float, offset: tuple, free: tuple[bool, bool], bins: float) -> tuple:
    """u, w, offset by least squares over the votes that lie within a cell and a half of where these have them, less those of chance; only what is ``free`` of u and w changes."""
    part, di, dj, n, r, c = rows.T
    part = part.astype(int)
    d = np.stack([di, dj]) * bins
    now = np.array([u, w, *offset], dtype=float)
    cells = (2 * SEEN + 1) ** 2
    # what a unit of u, w and offset moves r and c by
    by_r, by_c = (np.stack(x) for x in ((r, -c, np.ones_like(r), np.zeros_like(r)), (c, r, np.zeros_like(r), np.ones_like(r))))
    use = [x for x, on in zip(range(4), (*free, True, True)) if on]
    for _ in range(4):
        left = d - np.stack([now @ by_r, now @ by_c])
        near = (np.abs(left) <= 1.5 * bins).all(axis=0)
        total = lambda x: np.bincount(part, x, PARTS**2)
        chance = total(n * ~near) / np.maximum(cells - total(near), 1)
        weight = np.sqrt(np.maximum(n - chance[part], 0) * near)
        if np.count_nonzero(weight) < len(use):
            break
        form = np.concatenate([by_r[use] * weight, by_c[use] * weight], axis=1).T
        # columns of one size, so that what the votes say nothing of stays as it is
        size = np.linalg.norm(form, axis=0)
        size[size == 0] = 1.0
        now[use] += np.linalg.lstsq(form / size, (left * weight).ravel(), rcond=1e-6)[0] / size
    return float(now[0]), float(now[1]), (float(now[2]), float(now[3]))


def _better(guess: tuple, rows: np.ndarray, steps: tuple[float, float], window: float, bins: float) -> list[tuple]:
    """z and guess (scale, degrees, seat) of the best neighbours of ``guess`` by up to two ``steps`` of scale and angle, each settled."""
    scale, angle, seat = guess
    around = range(-2, 3)
    ways = [(i * steps[0] / scale, radians(j * steps[1])) for i in (around if steps[0] else (0,)) for j in (around if steps[1] else (0,)) if scale + i * steps[0] > 0]
    tried = sorted(zip(_around(rows, ways, bins), ways), key=lambda x: -x[0][0])[: 4 * BEAM]
    found = []
    for (z, offset), (u, w) in tried:
        to = _settled(rows, u, w, offset, (bool(steps[0]), bool(steps[1])), bins)
        # votes that lead elsewhere are of chance
        if max(abs(to[0] - u) * window / 2, abs(to[1] - w) * window / 2, *(abs(x - y) for x, y in zip(to[2], offset))) <= 2 * bins:
            u, w, offset = to
        s, a = scale * hypot(1 + u, w), angle + to_degrees(atan2(w, 1 + u))
        found.append((z, (s, a, _seat(seat, s, a, offset))))
    return found


def _alike(a: tuple, b: tuple, window: float, bins: float) -> bool:
    """Whether two guesses place the window the same way to half a cell."""
    seat = hypot(*(x - y for x, y in zip(a[2], b[2]))) * a[0]
    return max(abs(a[0] / b[0] - 1) * window / 2, abs(radians(a[1] - b[1])) * window / 2, seat) <= bins / 2


def _from(points: DataFrame, pin: tuple[float, float], reach: float | None = None) -> DataFrame:
    moved = points.select(*((F.col(x) - p).alias(x) for x, p in zip(RC, pin)))
    return moved if reach is None else moved.filter((F.abs("r") <= reach) & (F.abs("c") <= reach))


def _scan(target: DataFrame, source: DataFrame, grid: Grid, pin: tuple, scale: float, angle: float, bins: float, size: float, density: int, box: dict) -> tuple | None:
    """The seat by the source chunk that fits the target chunk around the pin best, under one scale and angle."""
    own = Grid(box, size, density)
    seats = _chunks(source, own, None).select("i", "j", F.col("r").alias("sr"), F.col("c").alias("sc"))
    a, b = scale * cos(radians(angle)), scale * sin(radians(angle))
    x, y = F.col("r") - F.col("sr"), F.col("c") - F.col("sc")
    moved = own.windows(source).join(seats, ["i", "j"]).select(F.struct("i", "j", "sr", "sc").alias("guess"), (a * x - b * y).alias("r"), (b * x + a * y).alias("c"))
    best = votes(_from(target, pin, grid.side() / 2), moved, max(own.steps) * scale, bins).orderBy(F.desc("z"), "guess").first()
    return best and _seat((best["guess"]["sr"], best["guess"]["sc"]), scale, angle, (best["dr"], best["dc"]))


def fit_affine(
    target: DataFrame, source: DataFrame, scales: list[float], degrees: list[float], radius: float = 300, bins: float = 10,
    centring: str | tuple[float, float] = "middle", size: float = 0.2, density: int = 4, rc: tuple[str, str] = RC,
) -> dict | None:
    """scale, degrees, centre and offset for ``alignment.apply_affine``, the number ``matched`` within a sixteenth of ``bins``, and ``z`` of the votes.

    ``scales`` and ``degrees`` are even ranges. ``centring`` brings the sets together before offsets of up to
    ``radius`` are voted for: by the ``middle`` of their boxes (the source turned by each guess), by their ``mean``, by a ``scan`` of chunks of
    the source over the best chunk of the target (under the middle scale and angle), or by a given move of the source.
    """
    scales, degrees = [float(s) for s in scales], [float(a) for a in degrees]
    if min(scales) <= 0:
        raise ValueError("scales must be above zero")
    target, source = _points(target, rc), _points(source, rc)
    box, other = _box(target), _box(source)
    if not box or not other:
        return None
    grid = Grid(box, 2 * size, density)
    best = _chunks(target, grid, None).orderBy(F.desc("evenness"), "i", "j").first()
    pin = (best["r"], best["c"]) if best else _middle(box)
    scale, angle = scales[len(scales) // 2], degrees[len(degrees) // 2]
    if centring == "scan":
        found = _scan(target, source, grid, pin, scale, angle, bins, size, density, other)
        if found is None:
            return None
        seated = lambda s, a: found
    elif isinstance(centring, str):
        middle = {"middle": _middle, "mean": lambda b: (b["avg_r"], b["avg_c"])}[centring]
        left = [p - m for p, m in zip(pin, middle(box))]
        own = _turned_middles(source, degrees) if centring == "middle" else dict.fromkeys(degrees, middle(other))
        seated = lambda s, a: _seat(own[a], s, a, tuple(-x for x in left))
    else:
        seated = lambda s, a: (pin[0] - float(centring[0]), pin[1] - float(centring[1]))

    step = lambda x: (max(x) - min(x)) / (len(x) - 1) if len(x) > 1 else 0.0
    by, turn = step(scales), step(degrees)
    holds = 2 * max(abs(box[f"{m}_{x}"] - p) for x, p in zip(RC, pin) for m in ("min", "max")) or 1.0
    finest = max(by / min(scales), radians(turn))
    window = min(2 * bins / finest, holds) if finest else holds
    if best:
        window = min(window, grid.side() * (ENOUGH / best["n"]) ** 0.5)
    guesses = [(s, a, seated(s, a)) for s in scales for a in degrees]
    moved = guessed(source, guesses, window / 2 + radius)
    top = votes(_from(target, pin, window / 2), moved, radius, bins).orderBy(F.desc("z"), "guess").limit(4 * BEAM).collect()
    if not top:
        return None
    # the same scale and angle from two guesses is one
    found = {}
    for t in top:
        s, a, seat = guesses[t["guess"]]
        found.setdefault((s, a), _seat(seat, s, a, (t["dr"], t["dc"])))
    kept, z, wider = [(s, a, seat) for (s, a), seat in found.items()][:BEAM], top[0]["z"], 2
    while window < holds:
        window = min(wider * window, holds)
        while finest * window > 2 * bins:
            by, turn, finest = by / 2, turn / 2, finest / 2
        tables = _parted(_from(target, pin, window / 2), guessed(source, kept, window / 2 + SEEN * bins), window, bins)
        tried = sorted((x for g, rows in tables.items() for x in _better(kept[g], rows, (by, turn), window, bins)), key=lambda x: -x[0])
        if not tried:
            return None
        kept, z = [], tried[0][0]
        for _, guess in tried:
            if len(kept) < BEAM and not any(_alike(guess, other, window, bins) for other in kept):
                kept.append(guess)
        # settled guesses are good for more than twice their window
        wider = 4
    (scale, angle, seat), n = kept[0], 0
    for near in (bins, bins / 4, bins / 16):
        made = _refit(target, source, scale, angle, seat, pin, near)
        if made:
            scale, angle, seat, n = made
    offset = tuple(p - scale * s for p, s in zip(pin, seat))
    return {"scale": scale, "degrees": angle, "centre": seat, "offset": offset, "matched": n, "z": z}


def _refit(target: DataFrame, source: DataFrame, scale: float, angle: float, seat: tuple, pin: tuple, near: float) -> tuple | None:
    """Least squares over each source point and its nearest target within ``near``: scale, degrees, seat, number of pairs."""
    a, b = scale * cos(radians(angle)), scale * sin(radians(angle))
    # places, so that many points at one don't meet in pairs
    x = _from(source, seat).select(F.col("r").alias("x"), F.col("c").alias("y")).distinct().select("x", "y", (a * F.col("x") - b * F.col("y")).alias("r"), (b * F.col("x") + a * F.col("y")).alias("c"))
    to = _from(target, pin).select(F.col("r").alias("u"), F.col("c").alias("v")).distinct()
    # cells of twice ``near``: a target place is in four of them
    side = 2.0 * near
    span = lambda k: F.explode(F.sequence(F.floor((F.col(k) - near) / side), F.floor((F.col(k) + near) / side)))
    to = to.select("*", span("u").alias("i")).select("*", span("v").alias("j"))
    x = x.withColumns({"i": F.floor(F.col("r") / side), "j": F.floor(F.col("c") / side)})
    d2 = spatial.squared(F.col("r"), F.col("c"), F.col("u"), F.col("v"))
    pairs = x.join(to, ["i", "j"]).withColumn("d2", d2).filter(F.col("d2") <= near * near)
    # a source place is in one cell, so its pairs are together already
    pairs = pairs.groupBy("i", "j", "x", "y").agg(F.min(F.struct("d2", "u", "v")).alias("to")).select("x", "y", "to.u", "to.v")
    x, y, u, v = (F.col(k) for k in "xyuv")
    s = pairs.agg(
        F.count("*").alias("n"), *(F.avg(k).alias(k) for k in "xyuv"),
        F.avg(x * x + y * y).alias("xx"), F.avg(x * u + y * v).alias("dot"), F.avg(x * v - y * u).alias("cross"),
    ).first()
    spread = s["n"] and s["xx"] - s["x"] ** 2 - s["y"] ** 2
    if s["n"] < 2 or spread <= 0:
        return None
    a, b = (s["dot"] - s["x"] * s["u"] - s["y"] * s["v"]) / spread, (s["cross"] - s["x"] * s["v"] + s["y"] * s["u"]) / spread
    scale, angle = hypot(a, b), to_degrees(atan2(b, a))
    if not scale:
        return None
    d = (s["u"] - (a * s["x"] - b * s["y"]), s["v"] - (b * s["x"] + a * s["y"]))
    return scale, angle, _seat(seat, scale, angle, d), s["n"]


def clusteredness(points: DataFrame, near: float, rc: tuple[str, str] = RC, by: list[str] | None = None) -> DataFrame:
    """n, pairs (ordered, of points within ``near``) and clusteredness of each group: Ripley's K over the area of a circle, times n.

    The area of a group is that of its box; a group of one point, or without an area, has none.
    """
    by = by or []
    slim = points.select(*by, *(F.col(x).cast("double").alias(x) for x in rc)).dropna(subset=list(rc))
    side = lambda x: F.max(x) - F.min(x)
    groups = slim.groupBy(*by).agg(F.count("*").alias("n"), (side(rc[0]) * side(rc[1])).alias("area"))
    # places are counted first, so that repeated points meet as one row
    places = slim.groupBy(*by, *rc).agg(F.count("*").alias("m"))
    met = spatial.radius_join(places, places, near, rc, rc, by).groupBy(*by).agg(F.sum(F.col("m") * F.col("r_m")).alias("met"))
    both = groups.join(met, by) if by else groups.join(F.broadcast(met))
    pairs = F.col("met") - F.col("n")
    k = F.col("area") * pairs / (F.col("n") * (F.col("n") - 1)) / F.lit(3.141592653589793 * near * near) * F.col("n")
    return both.select(*by, "n", pairs.alias("pairs"), F.when((F.col("n") > 1) & (F.col("area") > 0), k).alias("clusteredness"))
