"""A byte-level convolutional quality classifier in numpy.

Every byte becomes a learned vector of ``EMBED`` numbers and a recurrence flag: it
is 1 where the ``RUN`` bytes from here equal those some 2 to ``LAGS`` bytes before,
the one relation between bytes that no linear filter can express. ``FILTERS``
learned filters of ``WIDTH`` bytes and step ``STEP`` run over the document; chunks
of ``CHUNK`` bytes, which overlap by WIDTH - 1 so that together they cover the
whole document, are max-pooled to a vector each. The largest and the mean chunk
vector go through a hidden layer to one probability.

Fitting: a bounded sample of labelled rows (``SAMPLE`` texts a class at most, and
``CHUNKS`` random chunks of each and epoch) by Adam on the driver. Scoring reads
every whole text in one pass without a shuffle; documents are computed in blocks
of bounded bytes and padded apart, so a score depends on its text alone.

Defined cases: null or empty text is one chunk of padding and gets a score; a
class without labelled rows leaves every document at the smoothed share of good
labels; further columns pass through, a clashing ``score`` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import labelled_sample, prior_shift, table, utf8_parts

EMBED, WIDTH, STEP, FILTERS, HIDDEN, CHUNK = 7, 8, 2, 24, 16, 256
LAGS, RUN = 40, 8
#: Zero bytes between documents: more than the longest lag and a filter's width.
PAD = LAGS + WIDTH
#: Labelled texts of each class in the sample at most, and chunks of each text and epoch.
SAMPLE, CHUNKS = 1_500, 10
#: Epochs, or as many more as small samples need for so many steps.
EPOCHS, STEPS, BATCH, RATE = 10, 480, 64, 4e-3
#: Bytes computed at once.
BLOCK = 1 << 18
#: Score from which a document counts as good.
CUT = 0.3


@dataclass
class Model:
    embed: np.ndarray
    conv: np.ndarray
    conv_bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    shift: float
    prior: float

    def weights(self) -> list[np.ndarray]:
        return [self.embed, self.conv, self.conv_bias, self.hidden, self.hidden_bias, self.out, self.out_bias]


def recurrence(data: np.ndarray) -> np.ndarray:
    """1 where RUN bytes repeat those of 2 to LAGS bytes before."""
    n, flag = len(data), np.zeros(len(data), bool)
    for lag in range(2, min(LAGS, n - RUN) + 1):
        same = data[lag:] == data[:-lag]
        reach = 1
        while reach < RUN:
            same = same[: len(same) - reach] & same[reach:]
            reach *= 2
        flag[lag : lag + len(same)] |= same
    return (flag & (data != 0)).astype(np.float32)


def _channels(data: np.ndarray, flags: np.ndarray, embed: np.ndarray) -> np.ndarray:
    x = np.empty((*data.shape, EMBED + 1), np.float32)
    x[..., :EMBED] = embed[data]
    x[..., EMBED] = flags
    return x


def _windows(x: np.ndarray, count: int) -> np.ndarray:
    """(…, bytes, channels) -> (…, count, WIDTH * channels), one window each STEP bytes."""
    c = x.shape[-1]
    lead, (sb, sc) = x.strides[:-2], x.strides[-2:]
    view = np.lib.stride_tricks.as_strided(x, (*x.shape[:-2], count, WIDTH, c), (*lead, sb * STEP, sb, sc))
    return view.reshape(*x.shape[:-2], count, WIDTH * c)


def _head(model: Model, top: np.ndarray, mean: np.ndarray) -> tuple[np.ndarray, ...]:
    x = np.concatenate([top, mean], axis=1)
    h = np.maximum(x @ model.hidden + model.hidden_bias, 0)
    z = h @ model.out + model.out_bias
    return x, h, 1 / (1 + np.exp(-np.clip(z[:, 0], -30, 30)))


def layout(sizes: np.ndarray) -> tuple[np.ndarray, int]:
    """Where each document starts when they stand PAD zeros or more apart at even places; and the bytes of all."""
    room = np.maximum(sizes, 1) + PAD
    room += room % STEP
    starts = np.concatenate([[0], np.cumsum(room)])
    return starts[:-1] + PAD + PAD % STEP, int(starts[-1] + 2 * PAD)


def _spread(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    starts, total = layout(np.array([len(p) for p in parts]))
    flat = np.zeros(total, np.uint8)
    for s, p in zip(starts, parts):
        flat[s : s + len(p)] = p
    return flat, starts


def score_block(model: Model, parts: list[np.ndarray]) -> np.ndarray:
    """Log odds of a block of documents given as byte arrays; filters run over BLOCK bytes at once however long one is."""
    flat, starts = _spread(parts)
    flags = recurrence(flat)
    sizes = np.maximum([len(p) for p in parts], 1)
    chunks = -(-sizes // CHUNK)
    doc = np.repeat(np.arange(len(parts)), chunks)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    first = (starts[doc] + nth * CHUNK) // STEP
    last = (starts[doc] + np.minimum((nth + 1) * CHUNK, sizes[doc]) + STEP - 1) // STEP
    pooled = np.empty((len(doc), FILTERS), np.float32)
    at = 0
    while at < len(doc):
        to = max(at + 1, int(np.searchsorted(last, first[at] + BLOCK // STEP)))
        low, count = first[at], int(last[to - 1] - first[at])
        span = slice(low * STEP, (low + count) * STEP + WIDTH)
        act = _windows(_channels(flat[span], flags[span], model.embed), count + 1) @ model.conv
        act += model.conv_bias
        bounds = np.column_stack([first[at:to], last[at:to]]).ravel() - low
        pooled[at:to] = np.maximum(np.maximum.reduceat(act, bounds, axis=0)[::2], 0)
        at = to
    edges = np.cumsum(chunks) - chunks
    top = np.maximum.reduceat(pooled, edges, axis=0)
    mean = np.add.reduceat(pooled, edges, axis=0) / chunks[:, None].astype(np.float32)
    p = _head(model, top, mean)[2]
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return np.log(p / (1 - p)) + model.shift


def score_parts(model: Model, parts: list[np.ndarray]) -> np.ndarray:
    """Probability of each document, computed in blocks of about BLOCK bytes."""
    out, block, held = np.empty(len(parts)), [], 0
    where: list[int] = []

    def flush() -> None:
        nonlocal block, held, where
        if block:
            out[where] = score_block(model, block)
        block, held, where = [], 0, []

    for i, part in enumerate(parts):
        block.append(part)
        where.append(i)
        held += len(part) + PAD
        if held >= BLOCK:
            flush()
    flush()
    return 1 / (1 + np.exp(-out))


def _start(rng: np.random.Generator, prior: float) -> Model:
    f = lambda *s, scale: (rng.standard_normal(s) * scale).astype(np.float32)
    return Model(
        f(256, EMBED, scale=0.5), f(WIDTH * (EMBED + 1), FILTERS, scale=0.18), np.zeros(FILTERS, np.float32), f(2 * FILTERS, HIDDEN, scale=0.2),
        np.zeros(HIDDEN, np.float32), f(HIDDEN, 1, scale=0.3), np.zeros(1, np.float32), 0.0, prior,
    )


def _gradients(model: Model, data: np.ndarray, flags: np.ndarray, doc: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Of the mean log loss; data: (chunks, CHUNK + WIDTH - 1 or more) bytes; doc: the document of each chunk, ascending."""
    n, count = len(y), CHUNK // STEP
    x = _channels(data, flags, model.embed)
    win = _windows(x, count)
    act = win @ model.conv + model.conv_bias
    at = act.argmax(axis=1)
    rows, cols = np.arange(len(data))[:, None], np.arange(FILTERS)[None]
    raw = act[rows, at, cols]
    pooled = np.maximum(raw, 0)
    edges = np.flatnonzero(np.diff(doc, prepend=-1))
    size = np.diff(np.append(edges, len(doc))).astype(np.float32)[:, None]
    top = np.maximum.reduceat(pooled, edges, axis=0)
    xh, h, p = _head(model, top, np.add.reduceat(pooled, edges, axis=0) / size)
    dz = ((p - y) / n)[:, None].astype(np.float32)
    dh = (dz @ model.out.T) * (h > 0)
    dx = dh @ model.hidden.T
    is_top = pooled == top[doc]
    shared = np.add.reduceat(is_top.astype(np.float32), edges, axis=0)
    dpool = (dx[:, :FILTERS] / shared)[doc] * is_top + (dx[:, FILTERS:] / size)[doc]
    dpool *= raw > 0
    dconv = np.zeros_like(model.conv)
    dwin = np.zeros((len(data), FILTERS, WIDTH * (EMBED + 1)), np.float32)
    for k in range(FILTERS):
        dconv[:, k] = win[np.arange(len(data)), at[:, k]].T @ dpool[:, k]
        dwin[:, k] = dpool[:, k, None] * model.conv[:, k]
    spot = at[:, :, None] * STEP + np.arange(WIDTH)
    bytes_at = data[np.arange(len(data))[:, None, None], spot]
    grad = dwin.reshape(len(data), FILTERS, WIDTH, EMBED + 1)[..., :EMBED].reshape(-1, EMBED)
    dembed = np.column_stack([np.bincount(bytes_at.ravel(), grad[:, j], 256) for j in range(EMBED)]).astype(np.float32)
    return [dembed, dconv, dpool.sum(axis=0), xh.T @ dh, dh.sum(axis=0), h.T @ dz, dz.sum(axis=0)]


def fit(bad: list[str], good: list[str], sizes: dict[int, int], seed: int = 7) -> Model:
    """``sizes``: labelled rows of class 0 and 1, for the prior of the probabilities."""
    prior = (sizes[1] + 0.5) / (sizes[0] + sizes[1] + 1)
    rng = np.random.default_rng(seed)
    model = _start(rng, prior)
    if not bad or not good:
        model.out[:] = 0
        model.shift = float(np.log(prior / (1 - prior)))
        return model
    parts = [np.frombuffer(t.encode(), np.uint8) for t in [*bad, *good]]
    y = np.repeat(np.array([0, 1], np.float32), [len(bad), len(good)])
    flat, starts = _spread(parts)
    flags = recurrence(flat)
    flat, flags = (np.concatenate([v, np.zeros(CHUNK + WIDTH, v.dtype)]) for v in (flat, flags))
    chunks = np.array([max(1, -(-len(p) // CHUNK)) for p in parts])
    span = np.arange(CHUNK + WIDTH - STEP)
    moments = [[np.zeros_like(w) for w in model.weights()] for _ in range(2)]
    step = 0
    # equal numbers of both classes a batch, the smaller class repeated
    per_epoch = -(-max(len(bad), len(good)) // (BATCH // 2))
    epochs = max(EPOCHS, -(-STEPS // per_epoch))
    for epoch in range(epochs):
        orders = [np.resize(rng.permutation(np.flatnonzero(y == c)), per_epoch * (BATCH // 2)).reshape(per_epoch, -1) for c in (0, 1)]
        rate = RATE * (1 - epoch / epochs) + 1e-4
        for some in np.concatenate(orders, axis=1):
            took = [np.sort(rng.choice(chunks[i], min(chunks[i], CHUNKS), replace=False)) for i in some]
            doc = np.repeat(np.arange(len(some)), [len(t) for t in took])
            begin = starts[some][doc] + np.concatenate(took) * CHUNK
            # windows past a document's end see the padding, as in scoring they are not pooled
            ends = (starts[some] + np.array([max(1, len(parts[i])) for i in some]))[doc]
            at = begin[:, None] + span
            data = np.where(at < (ends + WIDTH)[:, None], flat[at], 0)
            grads = _gradients(model, data, np.where(at < ends[:, None], flags[at], 0), doc, y[some])
            step += 1
            for w, g, m, v in zip(model.weights(), grads, *moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model.shift = prior_shift({0: 1, 1: 1}, sizes)
    return model


def with_score(df: DataFrame, model: Model, text: str = "text", out: str = "score", drop_text: bool = False) -> DataFrame:
    """``df`` with ``out``, the probability that the whole ``text`` is good."""
    keep = [c for c in df.columns if c.lower() != out.lower() and not (drop_text and c == text)]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = utf8_parts(batch.column(text))
            scores = score_parts(model, [data[a:b] for a, b in zip(offs[:-1], offs[1:])])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(scores, pa.float64())], [*keep, out])

    return df.mapInArrow(run, schema)


def fit_on(docs: DataFrame, labels: DataFrame, held_out: Column | None = None) -> Model:
    texts, sizes = labelled_sample(docs, labels, "quality", F.lit(False) if held_out is None else held_out, {0: SAMPLE, 1: SAMPLE})
    return fit(texts[0], texts[1], sizes)


def held_out() -> Column:
    """Rows that nothing is learned from; null ids are not among them."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op3_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_on(docs, labels, held_out())
    scored = with_score(docs.select("doc_id", "text"), model, drop_text=True)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


QUERIES = {"op3_quality_cnn": op3_quality_cnn}
SQL: dict[str, str] = {}
