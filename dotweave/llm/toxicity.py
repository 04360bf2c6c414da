"""Toxicity by compression distance.

Zstandard dictionaries are trained apart on ordinary and on toxic text, in ``PAIRS``
of two sizes: a small pair knows little but what is most typical, a larger one more.
A text is cut into windows that cover it whole: each word with the space before it,
long words in overlapping pieces, padded with spaces to ``WINDOW`` bytes so that
even a short word is above the size under which zstandard does not compress. The
difference of a window's length under the ordinary and under the toxic dictionary
is its evidence.

The toxic dictionary's training samples are passages of toxic texts: those whose byte
n-grams occur in far more toxic documents than ordinary ones explain (document
frequencies, near copies counted once). A dictionary of whole toxic texts spends its
room on what both classes share; the README has the figures.

Thresholds are calibrated on labelled documents by toxic dictionaries that they did
not train: each half of the sample trains dictionaries that measure the other half. A
document is described by how many of its windows save 1, 2, 3, ... bytes or more,
absolutely and by the square root of its windows, and by the summed log-likelihood
ratio of its windows; a logistic curve puts that into one score, placed so that the
share ``FALSE`` of the ordinary documents of the sample reaches ``CUT``. A new text is
measured by the dictionaries of both halves, and the mean of their log odds counts,
so that its evidence is spread as it was in calibration.

Fitting uses a bounded sample of labelled rows (``ORDINARY`` and ``TOXIC`` texts at
most, ``common.SAMPLE_BYTES`` of each class); scoring reads every whole text in one
pass without a shuffle. Windows of words met before are looked up (``KNOWN`` words at
most in a worker).

Defined cases: null, empty or blank text has no evidence and gets the share of toxic
labels; a class without labelled rows, as in an empty table, leaves every document at
the smoothed share of toxic labels; equal texts have equal scores, so repeated rows
and ties stay ties; very long texts are scored whole, window by window; further
columns pass through, a clashing ``score`` is replaced.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import labelled_sample, logit_fit, small, table


@dataclass(frozen=True)
class Pair:
    """Bytes of the two dictionaries, and lengths of the n-grams that mark toxic passages."""

    ordinary: int
    toxic: int
    grams: tuple[int, ...]


PAIRS = (Pair(2_048, 1_024, (5, 7, 9)), Pair(32_768, 2_048, (7,)))
#: Bytes of a padded window; of a piece of a long word, and the step between pieces.
WINDOW, PIECE, HOP = 48, 40, 30
LEVEL = 4
#: Bytes of a text that are cut into windows at once, about.
SLAB = 1 << 20
#: Labelled texts in the sample at most.
ORDINARY, TOXIC = 2_800, 1_600
#: Standard deviations above expectation at which a gram marks toxic text.
OVER = 7.0
#: Saved bytes are counted in bins from -LOW to HIGH; documents are described by how many windows reach STEPS.
LOW, HIGH = 12, 16
STEPS = (1, 2, 3, 4, 5, 7)
#: Words whose savings a worker remembers.
KNOWN = 300_000
#: Score from which a document counts as toxic, and the share of ordinary documents that may reach it.
CUT, FALSE = 0.7, 0.005
BINS = LOW + HIGH + 1
_M = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Model:
    ordinary: list[bytes]
    folds: list[list[bytes]]
    ratios: list[np.ndarray]
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    prior: float


def _grams(raw: bytes, width: int) -> np.ndarray:
    """A hash of each ``width`` consecutive bytes."""
    a = np.frombuffer(raw, np.uint8).astype(np.uint64)
    n = len(a) - width + 1
    h = np.zeros(max(n, 0), np.uint64)
    for i in range(width if n > 0 else 0):
        h = h * _M + a[i : i + n] + np.uint64(1)
    return h


def _fresh(texts: list[bytes]) -> list[bytes]:
    """``texts`` without those that share 4 of their 12 smallest passage hashes with earlier ones."""
    seen, out = set(), []
    for raw in texts:
        g = _grams(raw, 24 if len(raw) > 60 else 5)
        low = set(_distinct(g ^ (g >> np.uint64(29)))[:12].tolist())
        if len(low & seen) < 4:
            out.append(raw)
        seen |= low
    return out


def _distinct(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    return h[np.concatenate([[True], h[1:] != h[:-1]])] if len(h) else h


def _document_counts(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    h = np.concatenate([_distinct(_grams(t, width)) for t in texts])
    h.sort()
    edges = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1], [True]])) if len(h) else np.zeros(1, np.int64)
    return h[edges[:-1]], np.diff(edges)


def _marking(toxic: list[bytes], ordinary: list[bytes], width: int) -> np.ndarray:
    """The grams of toxic documents that ordinary documents do not explain, ascending.

    Of the ordinary documents, the larger class, only the grams that toxic ones have are counted, a document at a time.
    """
    gt, ct = _document_counts(toxic, width)
    if not len(gt):
        return gt
    known = np.zeros(len(gt), np.int64)
    for text in ordinary:
        g = _distinct(_grams(text, width))
        at = np.minimum(np.searchsorted(gt, g), len(gt) - 1)
        known[at[gt[at] == g]] += 1
    expected = (known + 2) * len(toxic) / len(ordinary)
    return gt[(ct - expected) / np.sqrt(expected) >= OVER]


def _passages(toxic: list[bytes], marking: dict[int, np.ndarray]) -> list[bytes]:
    """The passages of ``toxic`` covered by marking grams (by width)."""
    found = []
    for raw in toxic:
        cover = np.zeros(len(raw) + 1, np.int32)
        for width, marks in marking.items():
            if not len(marks):
                continue
            h = _grams(raw, width)
            hit = np.flatnonzero(marks[np.minimum(np.searchsorted(marks, h), len(marks) - 1)] == h)
            np.add.at(cover, hit, 1)
            np.add.at(cover, hit + width, -1)
        edges = np.flatnonzero(np.diff((np.cumsum(cover) > 0).astype(np.int8), prepend=0))
        found += [raw[a:b] for a, b in zip(edges[::2], edges[1::2])]
    return found


def _dictionary(size: int, samples: list[bytes], **how) -> bytes:
    """A trained dictionary, or where the samples are too few to train on, their end."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples, **how).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:] or b" " * 8


def _ordinary(texts: list[bytes]) -> list[bytes]:
    """The ordinary dictionary of each pair."""
    parts = [t[i : i + 256] for t in texts for i in range(0, len(t), 256)]
    return [_dictionary(p.ordinary, parts, k=32, d=8) for p in PAIRS]


def _toxic(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """The toxic dictionary of each pair."""
    marking = {w: _marking(toxic, ordinary, w) for w in sorted({w for p in PAIRS for w in p.grams})}
    return [_dictionary(p.toxic, _passages(toxic, {w: marking[w] for w in p.grams}), k=12, d=6) for p in PAIRS]


def _bytes(text: str) -> bytes:
    return b" " + text.lower().encode() + b" "


def windows(raw: bytes) -> Iterator[list[bytes]]:
    """The words of ``raw``, about SLAB bytes of them at once; long words in overlapping pieces that cover them whole."""
    start = 0
    while start < len(raw):
        end = raw.find(b" ", start + SLAB)
        end = len(raw) if end < 0 else end
        words = raw[start:end].split()
        if words and max(map(len, words)) > PIECE:
            words = [w[i : i + PIECE] for w in words for i in range(0, max(len(w) - PIECE + HOP, 1), HOP)]
        yield words
        start = end


class _Savings(dict):
    """word -> a row of ``rows``: for each fold and pair the bin of the bytes that its toxic dictionary saves."""

    def __init__(self, ordinary: list[bytes], folds: list[list[bytes]]):
        self.plain, self.folds = [*map(self.primed, ordinary)], [[*map(self.primed, f)] for f in folds]
        self.rows = np.empty((KNOWN + SLAB, len(folds) * len(PAIRS)), np.int16)

    @staticmethod
    def primed(content: bytes):
        import zstandard

        words = zstandard.ZstdCompressionDict(content)
        words.precompute_compress(level=LEVEL)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_content_size=False, write_dict_id=False)
        return lambda padded: np.fromiter(map(len, packer.multi_compress_to_buffer(padded, threads=1)), np.int64, len(padded))

    def learn(self, words: list[bytes]) -> None:
        fresh = list(set(words).difference(self))
        if len(self) + len(fresh) > KNOWN:
            self.clear()
            fresh = list(set(words))
        if fresh:
            padded = [(b" " + w).ljust(WINDOW) for w in fresh]
            plain = [p(padded) for p in self.plain]
            saved = np.column_stack([n - t(padded) for fold in self.folds for n, t in zip(plain, fold)])
            at = len(self)
            self.rows[at : at + len(fresh)] = np.clip(saved + LOW, 0, BINS - 1)
            self.update(zip(fresh, range(at, at + len(fresh))))


def _counter(ordinary: list[bytes], folds: list[list[bytes]]):
    """bytes of texts -> (texts, folds, pairs, BINS): how many windows save how many bytes."""
    savings = _Savings(ordinary, folds)
    place = np.arange(savings.rows.shape[1]) * BINS

    def count(texts: list[bytes]) -> np.ndarray:
        seen = np.zeros((len(texts), len(place) * BINS), np.int64)
        held: list[tuple[int, list[bytes]]] = []
        size = 0

        def flush() -> None:
            savings.learn([w for _, words in held for w in words])
            for i, words in held:
                at = np.fromiter(map(savings.__getitem__, words), np.int64, len(words))
                seen[i] += np.bincount((savings.rows[at] + place).ravel(), minlength=seen.shape[1])

        for i, raw in enumerate(texts):
            for words in windows(raw):
                held.append((i, words))
                size += len(words)
                if size > SLAB // 8:
                    flush()
                    held, size = [], 0
        flush()
        return seen.reshape(len(texts), len(folds), len(PAIRS), BINS)

    return count


def _describe(bins: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """The features of each row of ``bins`` (documents, BINS)."""
    total = np.maximum(bins.sum(axis=1), 1)
    root = np.sqrt(total)
    least = bins[:, ::-1].cumsum(axis=1)[:, ::-1]
    reach = [least[:, LOW + s] for s in STEPS]
    evidence = bins @ ratio
    return np.column_stack([*(np.log1p(r) for r in reach), *(r / root for r in reach), np.log1p(total), evidence, evidence / root])


def _ratio(plain: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """The log-likelihood ratio of each bin; a document weighs by the square root of its windows."""
    share = [(c / np.sqrt(np.maximum(c.sum(axis=1, keepdims=True), 1))).sum(axis=0) + 0.2 for c in (plain, toxic)]
    return np.log(share[1] / share[1].sum()) - np.log(share[0] / share[0].sum())


def _features(counts: np.ndarray, ratios: list[np.ndarray]) -> np.ndarray:
    """counts: (documents, pairs, BINS)."""
    return np.column_stack([_describe(counts[:, i], r) for i, r in enumerate(ratios)])


def fit(ordinary: list[str], toxic: list[str], sizes: dict[int, int]) -> Model:
    """``sizes``: labelled rows of class 0 and 1, for the prior of the probabilities."""
    prior = (sizes[1] + 0.5) / (sizes[0] + sizes[1] + 1)
    none = np.zeros(0)
    classes = [[_bytes(t) for t in x if t and not t.isspace()] for x in (ordinary, toxic)]
    if not all(classes):
        return Model([], [], [], none, none, none, prior)
    plain = _fresh(classes[0])
    ordinary, halves = _ordinary(plain), [[x[0::2], x[1::2] or x] for x in classes]
    folds, rows = [], [[], []]
    for fold in (0, 1):
        folds.append(_toxic(_fresh(halves[1][fold]), _fresh(halves[0][fold])))
        count = _counter(ordinary, folds[-1:])
        for c in (0, 1):
            rows[c].append(count(halves[c][1 - fold])[:, 0])
    counts = [np.concatenate(r) for r in rows]
    ratios = [_ratio(counts[0][:, i], counts[1][:, i]) for i in range(len(PAIRS))]
    x = np.concatenate([_features(c, ratios) for c in counts])
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    x = (x - mean) / spread
    weights = logit_fit(x, np.repeat([0.0, 1.0], [len(c) for c in counts]), l2=1.0)
    # the threshold: what the share FALSE of ordinary documents reaches, gets the score CUT
    weights[-1] = np.log(CUT / (1 - CUT)) - np.quantile(x[: len(counts[0])] @ weights[:-1], 1 - FALSE, method="higher")
    return Model(ordinary, folds, ratios, mean, spread, weights, prior)


def scorer(model: Model):
    """texts (None: empty) -> probabilities of being toxic."""
    count = _counter(model.ordinary, model.folds) if model.folds else None

    def score(texts: list[str | None]) -> np.ndarray:
        out = np.full(len(texts), model.prior)
        some = [i for i, t in enumerate(texts) if t and not t.isspace()]
        if count and some:
            seen = count([_bytes(texts[i]) for i in some])
            odds = [((_features(seen[:, f], model.ratios) - model.mean) / model.spread) @ model.weights[:-1] for f in range(len(model.folds))]
            out[some] = 1 / (1 + np.exp(-np.clip(np.mean(odds, axis=0) + model.weights[-1], -30, 30)))
        return out

    return score


#: The scorer of the last model that this worker process met, so that the tasks of a worker share what it has looked up.
_LAST: dict[bytes, object] = {}


def _kept_scorer(model: Model):
    key = hashlib.sha256(pickle.dumps(model)).digest()
    if key not in _LAST:
        _LAST.clear()
        _LAST[key] = scorer(model)
    return _LAST[key]


def with_score(df: DataFrame, model: Model, text: str = "text", out: str = "score", drop_text: bool = False) -> DataFrame:
    """``df`` with ``out``, the probability that the whole ``text`` is toxic."""
    keep = [c for c in df.columns if c.lower() != out.lower() and not (drop_text and c == text)]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _kept_scorer(model)
        for batch in small(batches, 500):
            values = pa.array(score(batch.column(text).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), values], [*keep, out])

    return df.mapInArrow(run, schema)


def fit_on(docs: DataFrame, labels: DataFrame, held_out: Column | None = None) -> Model:
    texts, sizes = labelled_sample(docs, labels, "toxic", F.lit(False) if held_out is None else held_out, {0: ORDINARY, 1: TOXIC})
    return fit(texts[0], texts[1], sizes)


def held_out() -> Column:
    """Rows that nothing is learned from; null ids are not among them."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_on(docs, labels, held_out())
    scored = with_score(docs.select("doc_id", "text"), model, drop_text=True)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


QUERIES = {"op2_toxicity": op2_toxicity}
SQL: dict[str, str] = {}
