"""N-gram Jaccard self-join by chosen paths.

Sets of word shingles (see shingles) are embedded as ``POSITIONS`` min-hash tokens
(position, value), whose expected agreement is the Jaccard similarity. One run is
a recursion: at a node, every position is chosen with probability ``RATE`` /
(threshold * POSITIONS) by a hash of run, node and position, and the sets that
share the token of a chosen position go into one child. Nodes of at most ``LIMIT``
sets are brute-forced, and so are nodes that no longer shrink (more than half of
their parent) or are ``DEPTH`` deep. The recursion runs as Spark levels while nodes
have more than ``NODE_BLOCK`` sets, and goes on inside one task below that, where
no row of an inner level needs a shuffle. Nodes of more sets that no longer shrink
are brute-forced in pairs of blocks, so no task gets an unbounded group. With f(0) = 1 and
f(d) = 1 - (1 - RATE f(d - 1) / POSITIONS) ** POSITIONS a run finds a pair at the
threshold with probability f(d) or more; as many runs are made as bring the
target recall at any depth.

Brute force compares min-hash signatures and links sets that agree in ``AGREE``
positions, far below the threshold, and whose sizes allow the similarity. Linked
sets form candidate groups, and inside a group every pair is then compared exactly
on its whole shingle sets: a link is an exact Jaccard similarity of the threshold
or more. Sets that are equal count as one throughout, with their number of copies.

Every document gets its class (the smallest doc_id of its connected component of
links) and its number of links (other documents of that similarity, copies
included).

Defined cases: null, empty or blank text has no shingles and no links, each such
row is its own class; repeated rows are copies of each other; a null doc_id is an
id like any other, below all; texts of fewer than five words are one shingle, so
they link only if equal up to case and white space; further columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bloom
from .common import cut, free, mix64, small, table, utf8_parts
from .components import components
from .shingles import shingle_sets

THRESHOLD, TARGET = 0.8, 0.999
POSITIONS, RATE = 64, 2.0
#: Positions of two signatures that must agree: 4.9 standard deviations below the mean at the threshold.
AGREE = 35
LIMIT, DEPTH = 64, 4
#: Sets of a node that one task takes (4 MB of signatures), and of one block of a large candidate group.
NODE_BLOCK, GROUP_BLOCK = 16_384, 256
_A = mix64(np.arange(1, POSITIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.uint32) | np.uint32(1)


def found_at(depth: int) -> float:
    """Probability that one run brings a pair at the threshold together at ``depth``."""
    f = 1.0
    for _ in range(depth):
        f = 1 - (1 - RATE * f / POSITIONS) ** POSITIONS
    return f


def runs(target: float = TARGET) -> int:
    return math.ceil(math.log(1 - target) / math.log(1 - found_at(DEPTH)))


def signatures(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(texts with shingles, POSITIONS) of uint32."""
    some = counts[counts > 0]
    starts = np.cumsum(some) - some
    h = (values >> np.uint64(16)).astype(np.uint32)
    out = np.empty((POSITIONS, len(some)), np.uint32)
    for j in range(POSITIONS if len(some) else 0):
        out[j] = np.minimum.reduceat(h * _A[j], starts)
    return np.ascontiguousarray(out.T)


def _binary(rows: np.ndarray) -> pa.Array:
    """A matrix as a binary column, one row each."""
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _matrix(column: pa.Array, kind=np.uint32) -> np.ndarray:
    data, offs = utf8_parts(column)
    return data.view(kind).reshape(len(offs) - 1, -1) if len(offs) > 1 else np.zeros((0, POSITIONS), kind)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        values, counts = shingle_sets(*utf8_parts(batch.column("text")))
        has = counts > 0
        some = counts[has]
        prints = np.zeros((2, len(counts)), np.uint64)
        if len(some):
            starts = np.cumsum(some) - some
            for k, salt in enumerate((0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179)):
                prints[k, has] = np.add.reduceat(mix64(values ^ np.uint64(salt)), starts)
        sig = np.zeros((len(counts), POSITIONS), np.uint32)
        sig[has] = signatures(values, counts)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("th"), pa.array(counts, pa.int64()), *(pa.array(p.view(np.int64)) for p in prints), _binary(sig)],
            ["doc_id", "th", "n", "f1", "f2", "sig"],
        )


def _children(node: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and node ids of the chosen children of each (node, signature)."""
    j = np.arange(POSITIONS, dtype=np.uint64)
    draw = mix64(node[:, None] ^ mix64(j + np.uint64(0x243F6A8885A308D3))[None])
    row, at = np.nonzero(draw < np.uint64(int(min(1.0, RATE / (THRESHOLD * POSITIONS)) * (2**64 - 1))))
    return row, mix64(draw[row, at] + mix64(sig[row, at].astype(np.uint64) + (at.astype(np.uint64) << np.uint64(32))))


def _split(n_runs: int):
    """Rows (rid, sig) with a node or, at the root, for every run -> rows (node, rid, parent's size)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig, rid = _matrix(batch.column("sig")), np.asarray(batch.column("rid"))
            root = "node" not in batch.schema.names
            for r in range(n_runs if root else 1):
                node = np.full(len(rid), mix64(np.array([r + 1], np.uint64))[0]) if root else np.asarray(batch.column("node")).view(np.uint64)
                row, child = _children(node, sig)
                size = np.full(len(row), np.iinfo(np.int64).max) if root else np.asarray(batch.column("size"))[row]
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(rid[row]), pa.array(size)], ["node", "rid", "parent"])

    return run


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each run of equal keys of a sorted partition, whole."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = np.column_stack([np.asarray(batch.column(k)) for k in keys])
        edges = np.concatenate([[0], np.flatnonzero((cols[1:] != cols[:-1]).any(axis=1)) + 1, [len(cols)]])
        for a, b in zip(edges[:-1], edges[1:]):
            key = tuple(cols[a])
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def link_signatures(sig: np.ndarray, n: np.ndarray, agree: int = AGREE, threshold: float = THRESHOLD) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that agree: each set is compared with all that no set has reached before."""
    left, edges = np.arange(len(n)), []
    while len(left) > 1:
        root, left = left[0], left[1:]
        queue = [root]
        while queue and len(left):
            x = queue.pop()
            fits = np.minimum(n[left], n[x]) >= threshold * np.maximum(n[left], n[x])
            fits &= (sig[left] == sig[x]).sum(axis=1) >= agree
            reached = left[fits]
            edges += [(root, y) for y in reached]
            queue += reached.tolist()
            left = left[~fits]
    return edges


def descend(node: int, sig: np.ndarray, n: np.ndarray, depth: int, left: np.ndarray, parent: int, out: list[tuple[int, int]]) -> None:
    """The recursion from a node of ``left`` (row numbers of ``sig``) at ``depth`` down to its brute-forced leaves."""
    size = len(left)
    if size <= LIMIT or depth >= DEPTH or 2 * size > parent:
        out += [(left[a], left[b]) for a, b in link_signatures(sig[left], n[left])]
        return
    row, child = _children(np.full(size, node, np.uint64), sig[left])
    order = np.argsort(child, kind="stable")
    row, child = row[order], child[order]
    edges = np.flatnonzero(np.concatenate([[True], child[1:] != child[:-1], [True]]))
    for a, b in zip(edges[:-1], edges[1:]):
        if b - a > 1:
            descend(child[a], sig, n, depth + 1, left[row[a:b]], size, out)


def _brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted nodes (node, bi, bj, rid, n, sig, depth, parent) -> a spanning forest of the links found in each."""
    u: list[int] = []
    v: list[int] = []
    out = lambda: pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])
    for rows in _grouped(batches, ["node", "bi", "bj"]):
        if rows.num_rows < 2:
            continue
        rid = np.asarray(rows["rid"])
        found: list[tuple[int, int]] = []
        node = np.asarray(rows["node"]).view(np.uint64)[0]
        whole = rows["bi"][0].as_py() == rows["bj"][0].as_py() == 0
        depth = rows["depth"][0].as_py() if whole else DEPTH
        descend(node, _matrix(rows["sig"]), np.asarray(rows["n"]), depth, np.arange(len(rid)), rows["parent"][0].as_py(), found)
        u += [int(rid[a]) for a, _ in found]
        v += [int(rid[b]) for _, b in found]
        if len(u) > 50_000:
            yield out()
            u, v = [], []
    yield out()


def intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of each set of ``left`` with each of ``right`` (row numbers); not those of a set with itself."""
    if len(left) * len(right) <= 16:
        return np.array([[len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for b in right] for a in left], np.int64).reshape(len(left), len(right))
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    token = np.cumsum(np.concatenate([[False], flat[1:] != flat[:-1]]))
    shared = np.bincount(token)[token] > 1  # a token of one set adds nothing
    token, owner = token[shared], owner[shared]
    if not len(token):
        return np.zeros((len(left), len(right)), np.int64)
    token = np.cumsum(np.concatenate([[False], token[1:] != token[:-1]]))
    total = np.zeros((len(left), len(right)))
    place = [np.full(len(sets), -1) for _ in range(2)]
    place[0][left], place[1][right] = np.arange(len(left)), np.arange(len(right))
    width = 4_096
    for base in range(0, int(token[-1]) + 1, width):
        a, b = np.searchsorted(token, [base, base + width])
        halves = []
        for side, size in zip(place, (len(left), len(right))):
            row = side[owner[a:b]]
            m = np.zeros((size, width), np.float32)
            m[row[row >= 0], token[a:b][row >= 0] - base] = 1
            halves.append(m)
        total += halves[0] @ halves[1].T
    return np.rint(total).astype(np.int64)


def _to_sets(among):
    """Rows (doc_id, th, text) whose ``th`` is ``among`` the candidates' -> doc_id, th, shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            near = np.flatnonzero(among(np.asarray(whole.column("th"))))
            for batch in small([whole.take(pa.array(near))]):
                values, counts = shingle_sets(*utf8_parts(batch.column("text")))
                offsets = np.concatenate([[0], np.cumsum(counts * 8)]).astype(np.int32)
                column = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(values)])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), column], ["doc_id", "th", "shingles"])

    return run


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _grouped(batches, ["component", "bi", "bj"]):
        rid, at = np.unique(np.asarray(rows["rid"]), return_index=True)
        rows = rows.take(at)
        data, offs = utf8_parts(rows["shingles"])
        sets = [data[a:b].view(np.uint64) for a, b in zip(offs[:-1], offs[1:])]
        n = np.array([len(s) for s in sets])
        block, copies = np.asarray(rows["block"]), np.asarray(rows["copies"])
        bi, bj = rows["bi"][0].as_py(), rows["bj"][0].as_py()
        left, right = np.flatnonzero(block == bi), np.flatnonzero(block == bj)
        common = intersections(sets, left, right)
        near = common >= THRESHOLD * (n[left][:, None] + n[right][None] - common) - 1e-9
        if bi == bj:
            np.fill_diagonal(near, False)
        links = np.zeros(len(rid), np.int64)
        links[left] += near @ copies[right]
        if bi != bj:
            links[right] += near.T @ copies[left]
        # a spanning forest of the links of this block pair
        u, v = [], []
        top = np.arange(len(rid))
        for i, a in enumerate(left):
            for b in right[near[i]]:
                x, y = a, b
                while top[x] != x:
                    top[x] = x = top[top[x]]
                while top[y] != y:
                    top[y] = y = top[top[y]]
                if x != y:
                    top[max(x, y)] = min(x, y)
        for k in range(len(rid)):
            x = k
            while top[x] != x:
                x = top[x]
            u.append(int(rid[k]))
            v.append(int(rid[x]))
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(links)], ["u", "v", "links"])


def _block_pairs(df: DataFrame, size: str, per_block: int) -> DataFrame:
    """Each row once for every pair of blocks that its block is part of: ``block, bi, bj``."""
    blocks = F.ceil(F.col(size) / per_block).cast("int")
    dealt = df.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return dealt.withColumn("other", other).withColumns({"bi": F.least("block", "other"), "bj": F.greatest("block", "other")}).drop("other", "blocks")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, th, n, rid, first, class_id, n_links`` of each row of ``docs`` (doc_id, text).

    ``th`` is the hash of the text, ``n`` its number of shingles, ``rid`` a number of the row, ``first`` the rid
    of the row that stands for its class.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("doc_id", F.xxhash64("text").alias("th"), F.lower("text").alias("text"))
    signed = rows.mapInArrow(_sign, "doc_id long, th long, n long, f1 long, f2 long, sig binary")
    signed = cut(signed.withColumn("rid", F.monotonically_increasing_id()))
    keys = ["n", "f1", "f2"]
    ids = signed.select("doc_id", "th", "rid", *keys)
    classes = ids.filter("n > 0").groupBy(*keys).agg(F.min(F.struct("doc_id", "rid")).alias("least"), F.count("*").alias("copies"))
    classes = cut(classes.select(*keys, F.col("least.rid").alias("rep"), "copies"))
    sets = signed.select("rid", "n", "sig").join(classes.select(F.col("rep").alias("rid"), "copies"), "rid")
    sets = cut(sets)

    # the recursion: level by level, all runs at once
    members, leaves = sets.select("rid", "sig").mapInArrow(_split(runs()), "node long, rid long, parent long"), []
    for depth in range(1, DEPTH + 1):
        sizes = members.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1")
        live = cut(members.join(sizes, "node"))
        done = F.lit(depth == DEPTH) | (F.col("size") <= NODE_BLOCK) | (F.col("size") > F.col("parent") / 2)
        leaves.append(live.filter(done).select("node", "rid", "size", F.lit(depth).alias("depth"), "parent"))
        large = live.filter(~done).select("node", "rid", "size")
        if large.isEmpty():
            break
        members = large.join(sets.select("rid", "sig"), "rid").mapInArrow(_split(1), "node long, rid long, parent long")
    leaf = leaves[0]
    for more in leaves[1:]:
        leaf = leaf.union(more)
    pairs = _block_pairs(leaf, "size", NODE_BLOCK).join(sets.select("rid", "n", "sig"), "rid").select("node", "bi", "bj", "rid", "n", "sig", "depth", "parent")
    edges = pairs.repartition("node", "bi", "bj").sortWithinPartitions("node", "bi", "bj").mapInArrow(_brute, "u long, v long")
    candidates = cut(components(edges))

    # exact similarities inside the candidate groups
    sizes = candidates.groupBy("component").agg(F.count("*").alias("size"))
    picked = candidates.join(sizes, "component").withColumnRenamed("id", "rid").join(sets.select("rid", "copies"), "rid").join(ids.select("doc_id", "th", "rid"), "rid")
    picked = cut(picked.withColumnsRenamed({"doc_id": "d", "th": "t"}))
    # texts are read again, and the shingles of candidates alone are shuffled
    made = rows.mapInArrow(_to_sets(bloom.build(picked, "t")), "doc_id long, th long, shingles binary")
    made = made.join(picked, (F.col("th") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("d"))).select("rid", "component", "size", "copies", "shingles")
    dealt = _block_pairs(made, "size", GROUP_BLOCK).select("component", "bi", "bj", "block", "rid", "copies", "shingles")
    exact = dealt.repartition("component", "bi", "bj").sortWithinPartitions("component", "bi", "bj").mapInArrow(_verify, "u long, v long, links long")
    exact = cut(exact)
    links = exact.groupBy(F.col("u").alias("rep")).agg(F.sum("links").alias("links"))
    grouped = components(exact.select("u", "v")).withColumnsRenamed({"id": "rep", "component": "group"})

    # the smallest doc_id of each group, and back to the rows
    reps = classes.join(links, "rep", "left").join(grouped, "rep", "left").withColumns({"group": F.coalesce("group", "rep"), "links": F.coalesce("links", F.lit(0))})
    reps = reps.join(ids.select(F.col("rid").alias("rep"), "doc_id"), "rep")
    least = reps.groupBy("group").agg(F.min(F.struct("doc_id", "rep")).alias("least")).select("group", F.col("least.doc_id").alias("class_id"), F.col("least.rep").alias("first"))
    reps = reps.join(least, "group").select(*keys, "copies", "links", "class_id", "first")
    out = ids.join(reps, keys, "left")
    alone = F.col("first").isNull()
    return out.select(
        "doc_id", "th", "n", "rid", F.coalesce("first", "rid").alias("first"), F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce(F.col("copies") - 1 + F.col("links"), F.lit(0)).cast("long").alias("n_links"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that resemble an earlier-numbered one: of each class the smallest doc_id stays, once.

    Rows that a filter of the rows to remove lets pass stay as they are, unshuffled; the rest, those rows and the few
    that look like them, are joined.
    """
    h, d, t, m = (free(docs, x) for x in ("_h", "_d", "_t", "_m"))
    key = [F.col("doc_id").alias(d), F.col("th").alias(t)]
    near = cut(near_duplicates(docs).select("doc_id", "th", (F.col("rid") == F.col("first")).alias("stays")))
    removed = cut(near.filter("not stays").select(*key).distinct())
    # of repeated rows of the one that stays: those are removed, and it stays
    twice = near.filter("stays").select(*key).join(removed.withColumnsRenamed({d: "d", t: "t"}), (F.col(t) == F.col("t")) & F.col(d).eqNullSafe(F.col("d")), "left_semi")
    hashed = docs.withColumn(h, F.xxhash64(F.coalesce("text", F.lit(""))))
    flagged = hashed.withColumn(m, bloom.may_be_among(bloom.build(removed, t), F.col(h)))
    same = (F.col(h) == F.col(t)) & F.col("doc_id").eqNullSafe(F.col(d))
    maybe = flagged.filter(F.col(m))
    kept = [flagged.filter(~F.col(m)), maybe.join(removed, same, "left_anti"), maybe.join(twice, same, "left_semi").dropDuplicates([h, "doc_id"])]
    return kept[0].unionByName(kept[1]).unionByName(kept[2]).drop(h, m)


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", F.col("n").alias("n_shingles"))


QUERIES = {"op1_jaccard_join": op1_jaccard_join}
SQL: dict[str, str] = {}
