"""Phrase collocations, counted in numpy arrays addressed by a minimal perfect hash.

Texts are lower-cased (A-Z), split into pieces at ``. , ; : ! ?`` and line ends, and pieces into words at spaces and tabs;
all counts are per language. Levels follow the Apriori rule: a phrase of k words is a candidate only where both phrases of
k - 1 words in it are, and its pre-count, summed over tasks, reaches ``least``. A phrase is known by one exact 64-bit key,
the slot of its first k - 1 words and the number of its last word, so nothing depends on a hash being free of collisions.

Over the candidates of every level lies a minimal perfect hash (cascaded bit arrays with ranks: a level keeps the keys
that are alone in their place, the others go to the next); the key stored at a slot is compared before the slot counts.
The counting pass adds up, in every task, one numpy array by ``bincount`` of the slots of all its texts; the arrays are
summed as a tree, blocks of slots at a time. The two parts of every cut are then read from the summed array by slot.

Words and candidates are broadcast, so their number is checked. Beyond ``MOST`` candidates of a level,
:func:`collocations_by_numbers` goes on with tables of packed word numbers: candidates stay in their tables, only the words and
a bit array of each level are broadcast. Beyond ``MOST`` words or ``WORD_BYTES`` of words, :func:`collocations_by_joins`
computes the same rows with grouped aggregates and joins alone.
What is shuffled is a key and a number for each distinct phrase of a task's run of texts, whatever its frequency.

Defined cases: null texts are empty, null languages are ``und``; repeated rows count again; phrases with equal score and
count are ranked by their UTF-8 bytes; texts are read whole; languages without candidates give no rows; an empty table
gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, mix64, table, utf8_parts

#: Words in a phrase, occurrences of a candidate, hundredths of a longer phrase's count, rows a language.
WORDS, LEAST, ABSORB, TOP = 4, 30, 80, 2_000
#: Bounds of what is broadcast: words and candidates of a level, and bytes of words.
MOST, WORD_BYTES = 1 << 21, 1 << 26
#: Bytes of texts that are split at once, keys that are held before they are counted, slots of an array's block, arrays a sum.
BYTES, KEYS, SLOTS, FAN = 1 << 22, 1 << 21, 1 << 14, 64
#: Bits of a word's number in a packed phrase (so MOST words at most), and of a block and of the largest whole of a level's bit array.
WIDE, BLOCK_BITS, FILTER_BITS = 21, 18, 29
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2


class PerfectHash:
    """Slots 0..n-1 of n distinct keys below 2^63, and -1 of any other key."""

    def __init__(self, keys: np.ndarray):
        keys = np.asarray(keys, np.int64).view(np.uint64)
        self.sizes, self.words, self.ranks, self.keys = [], [], [], np.zeros(len(keys), np.int64)
        placed, left = 0, keys
        while len(left):
            size = max(64, 2 * len(left))
            at = self._place(left, len(self.sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            words = np.packbits(alone, bitorder="little")
            words = np.pad(words, (0, -len(words) % 8)).view(np.uint64)
            counts = np.bitwise_count(words).astype(np.int64)
            self.sizes.append(size)
            self.words.append(words)
            self.ranks.append(placed + np.cumsum(counts) - counts)
            mine = alone[at]
            self.keys[self._rank(len(self.sizes) - 1, at[mine])] = left[mine].view(np.int64)
            placed += int(mine.sum())
            left = left[~mine]

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix64(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) % np.uint64(size)).astype(np.int64)

    def _rank(self, level: int, at: np.ndarray) -> np.ndarray:
        below = self.words[level][at >> 6] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return self.ranks[level][at >> 6] + np.bitwise_count(below).astype(np.int64)

    def __len__(self) -> int:
        return len(self.keys)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        wanted = np.asarray(keys, np.int64)
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = self._place(wanted[left].view(np.uint64), level, size)
            here = (self.words[level][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            slot = self._rank(level, at[here])
            some = left[here]
            # the stored key decides; a stranger may meet a bit at a later level, so it goes on like one that met none
            same = self.keys[slot] == wanted[some]
            out[some[same]] = slot[same]
            left = np.concatenate([left[~here], some[~same]])
        return out


def _parts(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Runs of rows with about BYTES of texts, or one longer text."""
    for batch in batches:
        _, ends = utf8_parts(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + BYTES, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def split_words(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of all texts, each word's text, and whether the next word follows in the same piece."""
    data, ends = utf8_parts(column)
    kind = _KIND[data]
    inside = kind == 0
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    # a text's first and last byte bound its words too
    edge = ends[:-1][np.diff(ends) > 0]
    first[edge] = inside[edge]
    edge = ends[1:][np.diff(ends) > 0] - 1
    last[edge] = inside[edge]
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    packed = _LOWER[data[inside]]
    offsets = np.concatenate([[0], np.cumsum(stop - start)]).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(packed)))
    text = np.searchsorted(ends, start, "right") - 1
    piece = np.searchsorted(np.flatnonzero(kind == 2), start)
    follows = np.zeros(len(start), bool)
    follows[:-1] = (text[:-1] == text[1:]) & (piece[:-1] == piece[1:])
    return words, text, follows


def _languages(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    coded = pc.fill_null(column.cast(pa.string()), "und").dictionary_encode()
    return np.asarray(coded.indices, np.int64), coded.dictionary.to_pylist()


class Index:
    """Numbers of the frequent words of every language, and the perfect hashes of the levels above."""

    def __init__(self, languages: list[str], words: pa.Array):
        """``words`` sorted by language, ``languages`` beside them."""
        self.words = words
        names, first = np.unique(np.asarray(languages, object).astype(str), return_index=True) if len(languages) else ([], [])
        ends = [*first[1:], len(words)] if len(first) else []
        self.span = {str(name): (int(a), int(b)) for name, a, b in zip(names, first, ends)}
        self.levels: list[PerfectHash] = []

    def numbers(self, column: pa.Array, lang: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all words of the texts: their number, -1 if infrequent, whether the next follows in the same piece, and their text."""
        words, text, follows = split_words(column)
        code, names = _languages(lang)
        coded = words.dictionary_encode()
        table_ = np.full((max(1, len(names)), max(1, len(coded.dictionary))), -1, np.int64)
        for row, name in enumerate(names):
            if name in self.span:
                a, b = self.span[name]
                at = pc.index_in(coded.dictionary, value_set=self.words.slice(a, b - a))
                table_[row, : len(at)] = np.asarray(pc.fill_null(at, -a - 1), np.int64) + a
        return table_[code[text], np.asarray(coded.indices, np.int64)], follows, text

    def keys(self, below: np.ndarray, number: np.ndarray, follows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and keys of phrases of ``k`` words whose two phrases of k - 1 words have slots in ``below``."""
        n = len(number)
        ok = (below[: n - 1] >= 0) & (below[1:] >= 0) & follows[: n - 1]
        at = np.flatnonzero(ok)
        at = at[at + k - 1 < n]
        return at, below[at] << 32 | number[at + k - 1]

    def slots(self, column: pa.Array, lang: pa.Array, upto: int) -> list[np.ndarray]:
        """For each level up to ``upto``: the slot at each word of the phrase that begins there, -1 if none."""
        number, follows, _ = self.numbers(column, lang)
        found, self.last = [number], (number, follows)
        for k in range(2, upto + 1):
            at, keys = self.keys(found[-1], number, follows, k)
            here = np.full(len(number), -1, np.int64)
            here[at] = self.levels[k - 2].slots(keys)
            found.append(here)
        return found

    def phrase(self, k: int, keys: np.ndarray) -> list[np.ndarray]:
        """Word numbers of phrases of ``k`` words."""
        if k == 1:
            return [keys]
        before = keys >> 32
        return [*self.phrase(k - 1, before if k == 2 else self.levels[k - 3].keys[before]), keys & 0xFFFFFFFF]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("text", F.col("lang").cast("string").alias("lang"))


def word_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``lang, word, n`` of the frequent words, and of all words of a language under a null word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            words, text, _ = split_words(batch.column("text"))
            code, names = _languages(batch.column("lang"))
            coded = words.dictionary_encode()
            size = len(coded.dictionary)
            pair, n = np.unique(code[text] * max(1, size) + np.asarray(coded.indices, np.int64), return_counts=True)
            lang = np.asarray(names, object)
            all_of = np.bincount(code[text], minlength=len(names))
            yield pa.RecordBatch.from_arrays(
                [pa.array([*lang[pair // max(1, size)], *lang], pa.string()), pa.concat_arrays([coded.dictionary.take(pa.array(pair % max(1, size))).cast(pa.string()), pa.nulls(len(names), pa.string())]), pa.array([*n, *all_of], pa.int64())],
                ["lang", "word", "n"],
            )

    counted = _texts(docs).mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("word").isNull() | (F.col("n") >= least))


def candidates(docs: DataFrame, index: Index, k: int, least: int = LEAST) -> DataFrame:
    """``key, n``: the phrases of ``k`` words that pass the Apriori rule and occur ``least`` times."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def counted(keys: list[np.ndarray]) -> pa.RecordBatch:
        key, n = np.unique(np.concatenate(keys), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], ["key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, held, size = shared.value, [np.zeros(0, np.int64)], 0
        for batch in _parts(batches):
            below = index.slots(batch.column("text"), batch.column("lang"), k - 1)[-1]
            held.append(index.keys(below, *index.last, k)[1])
            size += len(held[-1])
            if size > KEYS:
                yield counted(held)
                held, size = [held[0]], 0
        yield counted(held)

    return _texts(docs).mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def slot_counts(docs: DataFrame, index: Index) -> np.ndarray:
    """Occurrences of every slot of every level, one after the other: an array a task, summed as a tree."""
    spark = docs.sparkSession
    sizes = [len(index.words), *map(len, index.levels)]
    shared, base = spark.sparkContext.broadcast(index), np.concatenate([[0], np.cumsum(sizes)])
    schema = "part int, block int, counts binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        index, total = shared.value, np.zeros(base[-1], np.int64)
        for batch in _parts(batches):
            for level, slots in enumerate(index.slots(batch.column("text"), batch.column("lang"), len(sizes))):
                total[base[level] : base[level + 1]] += np.bincount(slots[slots >= 0], minlength=sizes[level])
        blocks = [b for b in range(-(-len(total) // SLOTS)) if total[b * SLOTS : (b + 1) * SLOTS].any()]
        raw = [_packed(total[b * SLOTS : (b + 1) * SLOTS]) for b in blocks]
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([part // FAN] * len(blocks), pa.int32()), pa.array(blocks, pa.int32()), pa.array(raw, pa.binary())], ["part", "block", "counts"])

    def add(arrays):
        counts = [_unpacked(raw) for raw in arrays.column("counts").to_pylist()]
        return pa.table({"part": arrays.column("part")[:1], "block": arrays.column("block")[:1], "counts": pa.array([_packed(sum(counts))], pa.binary())})

    made = _texts(docs).mapInArrow(run, schema).groupBy("part", "block").applyInArrow(add, schema).groupBy("block").applyInArrow(add, schema)
    total = np.zeros(base[-1], np.int64)
    for row in made.toLocalIterator():
        counts = _unpacked(row["counts"])
        total[row["block"] * SLOTS : row["block"] * SLOTS + len(counts)] = counts
    return total


def _packed(counts: np.ndarray) -> bytes:
    """Counts in the narrowest type that holds them, after a byte that tells its size."""
    kind = np.min_scalar_type(int(counts.max(initial=0)))
    return bytes([kind.itemsize]) + counts.astype(kind).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def _scores(a: np.ndarray, both: np.ndarray) -> np.ndarray:
    """floor(2000000 a / both), by long division so that no product passes 64 bits."""
    made, rest = np.divmod(2 * a, both)
    for _ in range(2):
        digits, rest = np.divmod(rest * 1000, both)
        made = made * 1000 + digits
    return made


def scored(index: Index, counts: np.ndarray, least: int = LEAST, absorb: int = ABSORB) -> list[dict[str, np.ndarray]]:
    """For each level from two words on: slot, a, l, r and score of the candidates that no longer one absorbs."""
    base = np.concatenate([[0], np.cumsum([len(index.words), *map(len, index.levels)])])
    count = [counts[base[k] : base[k + 1]] for k in range(len(base) - 1)]

    def slot_of(numbers: list[np.ndarray]) -> np.ndarray:
        slot = numbers[0]
        for level, n in zip(index.levels, numbers[1:]):
            slot = level.slots(slot << 32 | n)
        return slot

    made, absorbed = [], [np.zeros(len(c), bool) for c in count]
    for k in range(2, len(count) + 1):
        slot = np.flatnonzero(count[k - 1] >= least)
        numbers, a = index.phrase(k, index.levels[k - 2].keys[slot]), count[k - 1][slot]
        best = None
        for at in range(1, k):
            l, r = count[at - 1][slot_of(numbers[:at])], count[k - at - 1][slot_of(numbers[at:])]
            this = [_scores(a, l + r), l, r]
            best = this if best is None else [np.where(this[0] < best[0], x, y) for x, y in zip(this, best)]
        for size in range(2, k):
            for at in range(k - size + 1):
                inner = slot_of(numbers[at : at + size])
                absorbed[size - 1][inner[100 * a >= absorb * count[size - 1][inner]]] = True
        made.append({"slot": slot, "a": a, "l": best[1], "r": best[2], "score": best[0]})
    return [{c: x[~absorbed[k + 1][level["slot"]]] for c, x in level.items()} for k, level in enumerate(made)]


def _ranked(rows: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, least: int = LEAST, absorb: int = ABSORB, top: int = TOP, most: int = MOST, word_bytes: int = WORD_BYTES, held: int = MOST) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases; ``held`` candidates of a level at most are broadcast."""
    spark = docs.sparkSession
    words = cut(word_counts(docs, least))
    size = words.filter(F.col("word").isNotNull()).agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("word")), F.lit(0)).alias("bytes")).first()
    if size["n"] > min(most, (1 << WIDE) - 2) or size["bytes"] > word_bytes:
        return collocations_by_joins(docs, least, absorb, top)
    known = words.filter(F.col("word").isNotNull()).orderBy("lang", "word").toArrow()
    index = Index(known.column("lang").to_pylist(), known.column("word").combine_chunks().cast(pa.large_string()))
    for k in range(2, WORDS + 1):
        found = cut(candidates(docs, index, k, least))
        if k == 2:
            pairs = found
        if found.count() > held:
            return collocations_by_numbers(docs, words, known, pairs, least, absorb, top)
        index.levels.append(PerfectHash(np.sort(found.toArrow().column("key").to_numpy())))
    levels = scored(index, slot_counts(docs, index), least, absorb)
    shared = spark.sparkContext.broadcast((index, levels))
    ends = np.concatenate([[0], np.cumsum([len(level["slot"]) for level in levels])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, levels = shared.value
        names = np.asarray(list(index.span), object)
        first = np.asarray([a for a, _ in index.span.values()])
        for batch in batches:
            at = np.asarray(batch.column(0))
            for k, level in enumerate(levels):
                some = at[(at >= ends[k]) & (at < ends[k + 1])] - ends[k]
                numbers = index.phrase(k + 2, index.levels[k].keys[level["slot"][some]])
                phrase = pc.binary_join_element_wise(*(index.words.take(pa.array(n)) for n in numbers), pa.scalar(" ", pa.large_string())).cast(pa.string())
                lang = names[np.searchsorted(first, numbers[0], "right") - 1] if len(some) else []
                yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), phrase, *(pa.array(level[c][some]) for c in ("a", "l", "r", "score"))], ["lang", "phrase", "a", "l", "r", "score"])

    rows = spark.range(int(ends[-1])).mapInArrow(run, "lang string, phrase string, a long, l long, r long, score long")
    of = words.filter(F.col("word").isNull()).select("lang", "n")
    return _ranked(rows.join(of, "lang"), top)


def coded_texts(docs: DataFrame, index: Index) -> DataFrame:
    """``w``: of each text the numbers of its words as 32-bit integers, -1 for infrequent words and after each piece."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            number, follows, text = shared.value.numbers(batch.column("text"), batch.column("lang"))
            w = np.insert(number, np.flatnonzero(~follows) + 1, -1).astype(np.int32)
            sizes = np.bincount(text, minlength=batch.num_rows) + np.bincount(text[~follows], minlength=batch.num_rows)
            ends = (4 * np.concatenate([[0], np.cumsum(sizes)])).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(w)])], ["w"])

    return _texts(docs).mapInArrow(run, "w binary")


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    return (mix64(keys.view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def level_bits(found: DataFrame, count: int) -> tuple[np.ndarray, int]:
    """A bit array with the places of all packed phrases (``lo``), 16 bits a phrase as far as FILTER_BITS allow, and the binary logarithm of its size.

    Strangers that share a place pass it; as all that pass are counted, that costs rows and changes no result.
    """
    bits = min(FILTER_BITS, max(BLOCK_BITS, (16 * count).bit_length()))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _places(np.asarray(batch.column(0)), bits)
            yield pa.RecordBatch.from_arrays([pa.array((at >> BLOCK_BITS).astype(np.int32)), pa.array((at & ((1 << BLOCK_BITS) - 1)).astype(np.int32))], ["block", "at"])

    def packed(places: pa.Table) -> pa.Table:
        on = np.zeros(1 << BLOCK_BITS, bool)
        on[np.asarray(places.column("at"))] = True
        return pa.table({"block": places.column("block")[:1], "bits": pa.array([np.packbits(on, bitorder="little").tobytes()], pa.binary())})

    made = found.select("lo").mapInArrow(place, "block int, at int").groupBy("block").applyInArrow(packed, "block int, bits binary").toArrow()
    whole = np.zeros((1 << bits - BLOCK_BITS, 1 << BLOCK_BITS - 3), np.uint8)
    for block, raw in zip(made.column("block").to_pylist(), made.column("bits").to_pylist()):
        whole[block] = np.frombuffer(raw, np.uint8)
    return whole.reshape(-1), bits


def packed_counts(coded: DataFrame, below: tuple[np.ndarray, int], k: int, least: int) -> DataFrame:
    """``hi, lo, n``: the phrases of ``k`` words, 3 or 4, whose parts of k - 1 words are in ``below``, that occur ``least`` times.

    ``lo`` holds the last three numbers of a phrase, one more than the words', WIDE bits each; ``hi`` that of the word before them or 0.
    """
    shared = coded.sparkSession.sparkContext.broadcast(below)

    def counted(his: list[np.ndarray], los: list[np.ndarray]) -> pa.RecordBatch:
        hi, lo = np.concatenate(his), np.concatenate(los)
        order = np.lexsort((hi, lo)) if k > 3 else np.argsort(lo)
        hi, lo = hi[order], lo[order]
        first = np.flatnonzero(np.concatenate([np.ones(min(1, len(lo)), bool), (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]))
        return pa.RecordBatch.from_arrays([pa.array(hi[first]), pa.array(lo[first]), pa.array(np.diff(np.append(first, len(lo))))], ["hi", "lo", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, bits = shared.value
        his, los, size = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        for batch in _parts(batches, "w"):
            data, ends = utf8_parts(batch.column("w"))
            w = data[ends[0] : ends[-1]].view(np.int32).astype(np.int64) + 1
            if len(w) < k:
                continue
            # the phrases of k - 1 words that begin at each place
            part, whole = w[: len(w) - k + 2], w[: len(w) - k + 2] > 0
            for i in range(1, k - 1):
                more = w[i : len(w) - k + 2 + i]
                part, whole = part << WIDE | more, whole & (more > 0)
            at = np.flatnonzero(whole)
            place = _places(part[at], bits)
            whole[at] = raw[place >> 3] >> (place & 7).astype(np.uint8) & 1 == 1
            at = np.flatnonzero(whole[:-1] & whole[1:])
            his.append(w[at] if k > 3 else np.zeros(len(at), np.int64))
            los.append(part[at + 1] if k > 3 else part[at] << WIDE | w[at + 2])
            size += len(at)
            if size > KEYS:
                yield counted(his, los)
                his, los, size = his[:1], los[:1], 0
        yield counted(his, los)

    return coded.mapInArrow(run, "hi long, lo long, n long").groupBy("hi", "lo").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def collocations_by_numbers(docs: DataFrame, words: DataFrame, known: pa.Table, pairs: DataFrame, least: int = LEAST, absorb: int = ABSORB, top: int = TOP) -> DataFrame:
    """The same rows for any number of candidates, from the words (a row of ``known`` each, in order) and the counts of ``pairs``.

    Texts are numbered once. Counts of all levels are one table by packed phrase; the parts of cuts and the phrases inside longer ones are joined to it.
    """
    spark = docs.sparkSession
    index = Index(known.column("lang").to_pylist(), known.column("word").combine_chunks().cast(pa.large_string()))
    coded = cut(coded_texts(docs, index))
    mask, none = (1 << WIDE) - 1, F.lit(0).cast("long")
    two = pairs.select(none.alias("hi"), F.expr(f"shiftleft(shiftright(key, 32) + 1, {WIDE}) | ((key & {(1 << 32) - 1}) + 1)").alias("lo"), "n")
    three = cut(packed_counts(coded, level_bits(two, two.count()), 3, least))
    four = cut(packed_counts(coded, level_bits(three, three.count()), 4, least))
    single = spark.createDataFrame(pa.table({"lo": pa.array(np.arange(1, known.num_rows + 1)), "n": known.column("n")}), "lo long, n long")
    parts = single.unionByName(two.select("lo", "n")).unionByName(three.select("lo", "n"))

    def piece(k: int, start: int, size: int) -> Column:
        """``size`` of the ``k`` words from place ``start`` on, three at most, as a packed phrase."""
        after = WIDE * (k - start - size)
        if k == 4 and start == 0:
            return F.expr(f"shiftleft(hi, {WIDE * (size - 1)}) | shiftright(lo, {after})")
        return F.expr(f"shiftright(lo, {after}) & {(1 << WIDE * size) - 1}L")

    levels = [(2, two), (3, three), (4, four)]
    cuts = [df.select("hi", "lo", F.col("n").alias("a"), F.posexplode(F.array(*(F.struct(piece(k, 0, at).alias("left"), piece(k, at, k - at).alias("right")) for at in range(1, k)))).alias("cut", "p")) for k, df in levels]
    some = cuts[0].unionByName(cuts[1]).unionByName(cuts[2]).select("hi", "lo", "a", "cut", "p.left", "p.right")
    some = some.join(parts.select(F.col("lo").alias("left"), F.col("n").alias("l")), "left").join(parts.select(F.col("lo").alias("right"), F.col("n").alias("r")), "right")
    score = F.expr("CAST(CAST(2000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(19, 0)) DIV CAST(l + r AS DECIMAL(20, 0)) AS BIGINT)")
    best = some.withColumn("score", score).groupBy("hi", "lo").agg(F.min(F.struct("score", "cut", "a", "l", "r")).alias("b")).select("hi", "lo", "b.a", "b.l", "b.r", "b.score")
    inner = [df.select(F.col("n").alias("longer"), F.explode(F.array(*(piece(k, at, size) for size in range(2, k) for at in range(k - size + 1)))).alias("lo")) for k, df in levels[1:]]
    longest = inner[0].unionByName(inner[1]).groupBy("lo").agg(F.max("longer").alias("longer"))
    gone = longest.join(parts, "lo").filter(F.col("longer") * 100 >= F.col("n") * absorb).select(none.alias("hi"), "lo")
    shared = spark.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        names, first = np.asarray(list(index.span), object), np.asarray([a for a, _ in index.span.values()])
        for batch in batches:
            hi, lo = (np.asarray(batch.column(c)) for c in ("hi", "lo"))
            numbers = np.column_stack([hi, *(lo >> WIDE * i & mask for i in (2, 1, 0))]) - 1
            taken = [index.words.take(pa.array(n, mask=n < 0)) for n in numbers.T]
            phrase = pc.binary_join_element_wise(*taken, pa.scalar(" ", pa.large_string()), null_handling="skip").cast(pa.string())
            start = numbers[np.arange(len(numbers)), (numbers >= 0).argmax(axis=1)]
            lang = names[np.searchsorted(first, start, "right") - 1] if len(start) else []
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), phrase, *(batch.column(c) for c in ("a", "l", "r", "score"))], ["lang", "phrase", "a", "l", "r", "score"])

    rows = best.join(gone, ["hi", "lo"], "left_anti").mapInArrow(run, "lang string, phrase string, a long, l long, r long, score long")
    return _ranked(rows.join(words.filter(F.col("word").isNull()).select("lang", "n"), "lang"), top)


def collocations_by_joins(docs: DataFrame, least: int = LEAST, absorb: int = ABSORB, top: int = TOP) -> DataFrame:
    """The same rows by grouped counts and joins, for any number of words and candidates; nothing is broadcast or collected."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    pieces = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.explode(F.split(F.translate(F.coalesce("text", F.lit("")), upper, upper.lower()), "[.,;:!?\\x0A-\\x0D]")).alias("piece")
    ).select("lang", F.filter(F.split("piece", "[\\x20\\x09]+"), lambda w: w != "").alias("w"))

    def grams(k: int) -> DataFrame:
        starts = F.sequence(F.lit(1), F.size("w") - (k - 1))
        return pieces.filter(F.size("w") >= k).select("lang", F.explode(F.transform(starts, lambda i: F.array_join(F.slice("w", i, F.lit(k)), " "))).alias("phrase"))

    def part(words: Column, start, size) -> Column:
        return F.array_join(F.slice(words, start, size), " ")

    singles = grams(1).groupBy("lang", "phrase").agg(F.count("*").alias("f"))
    of = singles.groupBy("lang").agg(F.sum("f").alias("n"))
    counts = singles.withColumn("k", F.lit(1))
    for k in range(2, WORDS + 1):
        counts = counts.unionByName(grams(k).groupBy("lang", "phrase").agg(F.count("*").alias("f")).withColumn("k", F.lit(k)))
    counts = cut(counts.filter(F.col("f") >= least).withColumn("w", F.split("phrase", " ")))
    f = counts.select("lang", "phrase", "f")
    some = counts.filter("k >= 2").select("lang", "phrase", "k", "w", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    some = some.withColumns({"left": part(F.col("w"), F.lit(1), F.col("cut")), "right": part(F.col("w"), F.col("cut") + 1, F.col("k"))})
    some = some.join(f.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]).join(f.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    score = F.expr("CAST(CAST(2000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(19, 0)) DIV CAST(l + r AS DECIMAL(20, 0)) AS BIGINT)")
    best = some.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r")).alias("b")).select("lang", "phrase", "b.a", "b.l", "b.r", "b.score")
    inner = counts.filter("k >= 3").select("lang", "k", "w", F.col("f").alias("longer"), F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size"))
    inner = inner.select("lang", "w", "longer", "size", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("at")).select("lang", part(F.col("w"), F.col("at"), F.col("size")).alias("phrase"), "longer")
    gone = inner.join(f, ["lang", "phrase"]).filter(F.col("longer") * 100 >= F.col("f") * absorb).select("lang", "phrase")
    return _ranked(best.join(gone, ["lang", "phrase"], "left_anti").join(of, "lang"), top)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


QUERIES = {"op12_collocations": op12_collocations}

_GRAMS = " UNION ALL ".join(
    f"SELECT lang, {k} AS k, array_to_string(w[i : i + {k - 1}], ' ') AS phrase, count(*) AS f FROM (SELECT lang, w, unnest(range(1, len(w) - {k - 2})) AS i FROM pieces WHERE len(w) >= {k}) GROUP BY ALL" for k in range(1, WORDS + 1)
)

SQL = {
    "op12_collocations": f"""WITH pieces AS MATERIALIZED (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
grams AS MATERIALIZED ({_GRAMS}),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE k = 1 GROUP BY lang),
f AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM grams WHERE f >= {LEAST}),
cuts AS (SELECT lang, phrase, k, w, f AS a, unnest(range(1, k)) AS cut FROM f WHERE k >= 2),
marks AS (SELECT c.lang, c.phrase, cut, a, x.f AS l, y.f AS r, CAST(CAST(2000000 AS HUGEINT) * a // (x.f + y.f) AS BIGINT) AS score FROM cuts c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : cut], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1 : c.k], ' ')),
best AS (SELECT * FROM marks QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
sizes AS (SELECT lang, w, k, f, unnest(range(2, k)) AS size FROM f WHERE k >= 3),
inside AS (SELECT lang, array_to_string(w[i : i + size - 1], ' ') AS phrase, f FROM (SELECT *, unnest(range(1, k - size + 2)) AS i FROM sizes)),
gone AS (SELECT DISTINCT lang, phrase FROM inside i JOIN f USING (lang, phrase) WHERE 100 * i.f >= {ABSORB} * f.f)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM best JOIN total USING (lang) WHERE (lang, phrase) NOT IN (SELECT (lang, phrase) FROM gone)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= {TOP}"""
}
