"""Classifiers, tokens, sketches, media, chats."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dotweave.llm import chat_format, media_gif, quality_cnn, scaled_sketch, tokenize_bpe, toxicity
from dotweave.llm.common import logit_fit

SF = "/root/testdata/sf0.001"


def made_text(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


# byte-level BPE


def reference_encoder():
    return tokenize_bpe.encoder(*tokenize_bpe.public_ranks())


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=300))
def test_segments_do_not_change_ids(text):
    enc = reference_encoder()
    parts = tokenize_bpe.segments(text, 7)
    assert "".join(parts) == text
    assert sum((enc.encode_ordinary(p) for p in parts), []) == enc.encode_ordinary(text)


def test_long_texts_are_cut_at_safe_places():
    rng = random.Random(3)
    text = "".join(rng.choice(["word", "don't", "42", "  ", "\n\n", " ", "é", "..."]) + " " for _ in range(20_000))
    enc = reference_encoder()
    assert len(tokenize_bpe.segments(text)) > 3
    assert tokenize_bpe.encode(enc, text) == enc.encode_ordinary(text)


def test_tokens_of_awkward_rows(docs, none, spark):
    ranks = tokenize_bpe.public_ranks()
    enc = reference_encoder()
    rows = {r["doc_id"]: r for r in tokenize_bpe.with_text_bytes(tokenize_bpe.with_tokens(docs, *ranks), *ranks).collect()}
    source = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for k, text in source.items():
        assert rows[k]["ids"] == enc.encode_ordinary(text) and bytes(rows[k]["decoded"]) == text.encode()
    assert tokenize_bpe.token_digests(docs, *ranks).count() == docs.count()
    assert tokenize_bpe.token_digests(none, *ranks).count() == 0


def test_op5_matches_the_library(spark):
    enc = reference_encoder()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in tokenize_bpe.op5_byte_bpe(spark, SF).collect():
        ids = enc.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


# toxicity


def toxic_corpus(seed=0):
    rng = random.Random(seed)
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))
    bad = ["blarghface", "snotwaffle", "grumbleturd"]
    text = lambda p: " ".join(rng.choice(bad) if rng.random() < p else word() for _ in range(rng.randint(80, 300)))
    return [text(0) for _ in range(240)], [text(0.04) for _ in range(160)]


def test_toxicity_tells_planted_words():
    plain, toxic = toxic_corpus()
    model = toxicity.fit(plain[:160], toxic[:100], {0: 160, 1: 100})
    score = toxicity.scorer(model)
    assert (score(toxic[100:]) >= toxicity.CUT).mean() > 0.9 and (score(plain[160:]) >= toxicity.CUT).mean() < 0.05
    assert score([None, "", " \n"]) == pytest.approx(100.5 / 261)
    long = toxic[100] + " " + " ".join(plain) * 3
    assert score([long, toxic[101]])[1] == score([toxic[101]])[0] and 0 <= score([long])[0] <= 1


def test_marking_grams_take_no_memory_for_ordinary_texts():
    import tracemalloc

    rng = np.random.default_rng(5)
    words = [bytes(rng.integers(97, 123, 6, np.uint8)) for _ in range(3_000)]
    text = lambda n: b" ".join(words[i] for i in rng.integers(0, len(words), n))
    toxic = [text(20) + b" vile slur here " + text(20) for _ in range(60)]
    ordinary = [text(700) for _ in range(600)]
    tracemalloc.start()
    got = toxicity._marking(toxic, ordinary, 7)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 << 20 < sum(map(len, ordinary)) * 8 / 4
    counts = [[set(toxicity._grams(t, 7).tolist()) for t in x] for x in (toxic, ordinary)]
    some, many = ({g: sum(g in c for c in x) for g in set().union(*counts[0])} for x in counts)
    expect = {g: (many[g] + 2) * len(toxic) / len(ordinary) for g in some}
    assert got.tolist() == sorted(g for g in some if (some[g] - expect[g]) / expect[g] ** 0.5 >= toxicity.OVER) and len(got) > 5
    assert not len(toxicity._marking([b"ab"], ordinary, 7))


def test_windows_cover_whole_texts(monkeypatch):
    monkeypatch.setattr(toxicity, "SLAB", 500)
    rng = random.Random(3)
    for n in (0, 1, 39, 40, 41, 70, 71, 1000, 5000):
        words = [bytes(rng.randrange(97, 123) for _ in range(rng.choice([1, 5, 39, 40, 41, 69, 70, 71, 200]))) for _ in range(n // 30)] + [b"x" * n]
        raw = b"  ".join(words)
        at, whole = 0, [w for part in toxicity.windows(raw) for w in part]
        for word in filter(None, words):
            seen = np.zeros(len(word), bool)
            start = 0
            while not seen.all():
                piece = whole[at]
                assert len(piece) <= toxicity.PIECE and word[start : start + len(piece)] == piece
                seen[start : start + len(piece)] = True
                start, at = start + toxicity.HOP, at + 1
        assert at == len(whole)


def test_toxicity_against_plain_python():
    """The score by the letter of the docstring: no lookup of known words, no numpy."""
    import math

    import zstandard

    plain, toxic = toxic_corpus()
    model = toxicity.fit(plain[:160], toxic[:100], {0: 160, 1: 100})
    score = toxicity.scorer(model)
    length = lambda d, w: len(zstandard.ZstdCompressor(level=toxicity.LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False).compress(w))
    assert all(d[:4] == bytes.fromhex("37a430ec") for d in [*model.ordinary, *sum(model.folds, [])])
    for text in [*plain[160:163], *toxic[100:104], "q" * 90 + " w"]:
        words = [w[i : i + 40] for w in text.lower().encode().split() for i in range(0, max(len(w) - 10, 1), 30)]
        odds = []
        for fold in model.folds:
            x = []
            for ordinary, marked, ratio in zip(model.ordinary, fold, model.ratios):
                saved = [max(-12, min(16, length(ordinary, p) - length(marked, p))) for p in ((b" " + w).ljust(48) for w in words)]
                reach = [sum(s >= k for s in saved) for k in (1, 2, 3, 4, 5, 7)]
                root, evidence = math.sqrt(len(saved)), sum(ratio[s + 12] for s in saved)
                x += [*(math.log1p(r) for r in reach), *(r / root for r in reach), math.log1p(len(saved)), evidence, evidence / root]
            odds.append(sum(w * (v - m) / s for w, v, m, s in zip(model.weights, x, model.mean, model.spread)) + model.weights[-1])
        assert score([text])[0] == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, sum(odds) / 2)))), abs=1e-9)


def area_under_curve(score, label):
    rank = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1.0
    _, same = np.unique(score, return_inverse=True)
    rank = (np.bincount(same, rank) / np.bincount(same))[same]
    n = label.sum()
    return (rank[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


def test_op2_finds_toxic_documents_of_every_language(spark):
    tables = "/root/testdata/sf0.1"
    known = spark.read.parquet(f"{tables}/labels.parquet").filter("toxic is not null").join(spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "lang"), "doc_id")
    got = toxicity.op2_toxicity(spark, tables).filter("held_out").join(known, "doc_id").select("lang", "toxic", "score", "predicted").toPandas()
    bad = got.toxic == 1
    found = {lang: (part.predicted[part.toxic == 1].mean(), area_under_curve(part.score.to_numpy(), part.toxic.to_numpy())) for lang, part in got.groupby("lang")}
    print(found, got.predicted[bad].mean(), got.predicted[~bad].mean())
    # a share of the toxic labels is of texts without any toxic word
    assert got.predicted[bad].mean() > 0.68 and got.predicted[~bad].mean() < 0.01
    assert all(area > 0.75 for _, area in found.values()) and got.predicted[bad & (got.lang != "en")].mean() > 0.5


def test_samples_are_bounded_in_bytes(spark, monkeypatch):
    from pyspark.sql import functions as F

    from dotweave.llm import common

    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 100).alias("text"))
    labels = spark.range(40).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    monkeypatch.setattr(common, "SAMPLE_BYTES", 450)
    texts, sizes = common.labelled_sample(docs, labels, "toxic", F.lit(False), {0: 10, 1: 3})
    assert (len(texts[0]), len(texts[1])) == (5, 3) and sizes == {0: 20, 1: 20}


def test_toxicity_without_a_class():
    model = toxicity.fit(["x"], [], {0: 9, 1: 0})
    assert toxicity.scorer(model)(["anything"])[0] == pytest.approx(0.5 / 10)


def test_op2_learns_nothing_from_held_out_rows(spark, docs, labels, folder, none):
    path = folder(documents=docs, labels=labels)
    rows = toxicity.op2_toxicity(spark, path).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
    flipped = labels.selectExpr("doc_id", "quality", "case when crc32(cast(cast(doc_id as string) as binary)) % 3 = 1 then 1 - toxic else toxic end as toxic")
    again = toxicity.op2_toxicity(spark, folder(documents=docs, labels=flipped)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert toxicity.op2_toxicity(spark, folder(documents=none, labels=labels.limit(0))).count() == 0


# quality


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(0)
    model = quality_cnn._start(rng, 0.5)
    data = rng.integers(30, 60, (5, quality_cnn.CHUNK + quality_cnn.WIDTH)).astype(np.uint8)
    flags, doc, y = rng.integers(0, 2, data.shape).astype(np.float32), np.array([0, 0, 1, 2, 2]), np.array([0, 1, 1], np.float32)

    for w in model.weights():
        w[...] = w.astype(np.float32)
    grads = quality_cnn._gradients(model, data, flags, doc, y)

    def loss():
        x = quality_cnn._windows(quality_cnn._channels(data, flags, model.embed), quality_cnn.CHUNK // quality_cnn.STEP)
        pooled = np.maximum((x @ model.conv + model.conv_bias).max(axis=1), 0)
        top = np.stack([pooled[doc == i].max(axis=0) for i in range(3)])
        mean = np.stack([pooled[doc == i].mean(axis=0) for i in range(3)])
        p = quality_cnn._head(model, top, mean)[2].astype(np.float64)
        return -np.mean(np.where(y == 1, np.log(p), np.log(1 - p)))

    for w, g in zip(model.weights(), grads):
        flat, slope = w.reshape(-1), g.reshape(-1)
        for i in np.argsort(-np.abs(slope))[:2]:
            old, eps = flat[i], 1e-2
            flat[i] = old + eps
            up = loss()
            flat[i] = old - eps
            down = loss()
            flat[i] = old
            assert (up - down) / (2 * eps) == pytest.approx(slope[i], rel=0.15, abs=2e-3)


def test_scores_depend_on_the_text_alone():
    rng = np.random.default_rng(1)
    model = quality_cnn._start(rng, 0.5)
    parts = [rng.integers(32, 120, n).astype(np.uint8) for n in (0, 1, 7, 8, 9, 255, 256, 257, 700_001, 3)]
    together = quality_cnn.score_parts(model, parts)
    alone = [quality_cnn.score_parts(model, [p])[0] for p in parts]
    assert np.allclose(together, alone, atol=1e-5)


def test_recurrence_marks_repeats():
    raw = np.frombuffer(b"abcdefgh zyxwvuts repeated repeated repeated 0123456789", np.uint8)
    flags = quality_cnn.recurrence(raw)
    assert flags[:26].sum() == 0 and flags[26:36].all() and flags[-9:].sum() == 0


def test_quality_network_learns_junk():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    good = [made_text(rng, words, rng.randint(20, 200)) for _ in range(150)]
    bad = [w.upper().replace(" ", "!! ") if i % 2 else " ".join(x for x in w.split()[:30] for _ in range(9)) for i, w in enumerate(good)]
    model = quality_cnn.fit(bad[:110], good[:110], {0: 110, 1: 110})
    as_parts = lambda texts: [np.frombuffer(t.encode(), np.uint8) for t in texts]
    assert (quality_cnn.score_parts(model, as_parts(good[110:])) >= 0.5).mean() > 0.9
    assert (quality_cnn.score_parts(model, as_parts(bad[110:])) < 0.5).mean() > 0.9


def test_op3_of_awkward_rows(spark, docs, labels, folder, none):
    rows = quality_cnn.op3_quality_cnn(spark, folder(documents=docs, labels=labels)).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    assert quality_cnn.op3_quality_cnn(spark, folder(documents=none, labels=labels.limit(0))).count() == 0


def forward(model, text: str) -> float:
    """Score of one text, a window at a time, as the layers are defined."""
    raw, pad = text.encode() or b"\0", quality_cnn.PAD
    run, data = quality_cnn.RUN, bytes(pad) + raw + bytes(pad)
    flags = np.zeros(len(data))
    for i in range(pad, pad + len(raw)):
        flags[i] = data[i] != 0 and any(data[i : i + run] == data[i - lag : i - lag + run] for lag in range(2, quality_cnn.LAGS + 1))
    pooled = []
    for low in range(0, len(raw), quality_cnn.CHUNK):
        best = np.zeros(quality_cnn.FILTERS)
        for w in range(low, min(low + quality_cnn.CHUNK, len(raw)), quality_cnn.STEP):
            seen = range(pad + w, pad + w + quality_cnn.WIDTH)
            x = np.concatenate([[*model.embed[data[i]], flags[i]] for i in seen]).astype(float)
            best = np.maximum(best, x @ model.conv + model.conv_bias)
        pooled.append(best)
    x = np.concatenate([np.max(pooled, axis=0), np.mean(pooled, axis=0)])
    z = float((np.maximum(x @ model.hidden + model.hidden_bias, 0) @ model.out + model.out_bias)[0])
    odds = min(max(z, -np.log(1e9 - 1)), np.log(1e9 - 1)) + model.shift
    return 1 / (1 + np.exp(-odds))


def test_op3_against_a_plain_forward_pass(spark, folder):
    whole = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    short = whole.filter("length(text) < 4000")
    made = [(10**9 + i, t, None, None, None) for i, t in enumerate(["", "x", "ab" * 200, "NUL \0\0 inside", "é" * 300, "a line again\n" * 60])]
    docs = short.unionByName(spark.createDataFrame(made, whole.schema))
    where = folder(documents=docs, labels=labels)
    model = quality_cnn.fit_on(spark.read.parquet(f"{where}/documents.parquet"), labels, quality_cnn.held_out())
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = quality_cnn.op3_quality_cnn(spark, where).collect()
    assert len(got) == docs.count() > 100
    for r in got:
        assert r["score"] == pytest.approx(forward(model, texts[r["doc_id"]]), abs=2e-4)


def test_logistic_regression():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 2))
    y = (rng.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] + 0.5)))).astype(float)
    assert np.allclose(logit_fit(x, y), [2, -1, 0.5], atol=0.25)


# sketches


def test_sketches_merge_and_estimate():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(5000)]
    a, b = (made_text(rng, words, 4000).encode() for _ in range(2))
    both = scaled_sketch.merge(scaled_sketch.sketch(a), scaled_sketch.sketch(b))
    shingles = lambda t: {t[i : i + 16] for i in range(len(t) - 15)}
    part = a[: len(a) // 5]
    assert scaled_sketch.containment(scaled_sketch.sketch(part), both) > 0.97
    x, y = shingles(a), shingles(a[: len(a) // 2] + b[: len(b) // 2])
    true = len(x & y) / len(x | y)
    assert abs(scaled_sketch.likeness(scaled_sketch.sketch(a), scaled_sketch.sketch(a[: len(a) // 2] + b[: len(b) // 2])) - true) < 0.05
    kept = scaled_sketch.sketch(a)
    assert (scaled_sketch.from_text(scaled_sketch.to_text(kept)) == kept).all()


def test_empty_sketches():
    e, x = scaled_sketch.sketch(b""), scaled_sketch.sketch(b"x")
    assert len(e) == 0 and len(x) == 1
    assert scaled_sketch.likeness(e, e) == 1 and scaled_sketch.likeness(e, x) == 0


@pytest.mark.parametrize("rows", [4000, 2])
def test_next_likeness_against_brute_force(spark, rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    order = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), reverse=True)
    got = {r["doc_id"]: r for r in scaled_sketch.next_likeness(docs, rows).collect()}
    assert len(got) == len(order)
    for (k, text), (_, after) in zip(order, order[1:] + order[:1]):
        new = scaled_sketch.edited(text, after)
        n = len(text) // 3
        assert new == text[: len(text) - n] + after[:n]
        own, changed, other = (scaled_sketch.sketch(t.encode()) for t in (text, new, after))
        assert got[k]["n_chars"] == len(text) and got[k]["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert got[k]["fingerprint"] == scaled_sketch.to_text(own) and got[k]["edited_fingerprint"] == scaled_sketch.to_text(changed)
        assert got[k]["near_edited"] == scaled_sketch.likeness(own, changed) and got[k]["near_next"] == scaled_sketch.likeness(own, other)


def test_many_rows_of_one_id_are_parted(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, made_text(rng, words, 30)) for i in range(300)] + [(None, None), (None, ""), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    place = scaled_sketch.buckets(docs.selectExpr(f"coalesce(doc_id, {scaled_sketch._LOWEST}) AS k"), 10)
    assert set(place.hot) == {7, scaled_sketch._LOWEST} and min(place.hot.values()) >= 10
    lowest = lambda k: scaled_sketch._LOWEST if k is None else k
    order = sorted(((-lowest(k), scaled_sketch._tie(scaled_sketch._packed(t)), k, t or "") for k, t in rows), key=lambda x: x[:2])
    at = place(np.array([lowest(x[2]) for x in order]), np.array([x[1] for x in order]))
    assert (np.diff(at) >= 0).all() and np.unique(at, return_counts=True)[1].max() <= 40
    want = []
    for (_, _, k, text), (*_, after) in zip(order, order[1:] + order[:1]):
        new = scaled_sketch.edited(text, after)
        own, other = (scaled_sketch.sketch(t.encode()) for t in (text, after))
        want.append((k, len(text), hashlib.sha256(new.encode()).hexdigest(), scaled_sketch.likeness(own, other)))
    for size in (10, 4000):
        got = [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_next"]) for r in scaled_sketch.next_likeness(docs, size).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_sketches_of_awkward_rows(docs, none, spark):
    rows = scaled_sketch.next_likeness(docs, 2).collect()
    assert len(rows) == docs.count() and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert scaled_sketch.next_likeness(none).count() == 0
    one = scaled_sketch.next_likeness(docs.filter("doc_id = 9")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1
    assert scaled_sketch.with_sketch(docs).count() == docs.count()


# GIF


@settings(max_examples=80, deadline=None)
@given(st.binary(max_size=600))
def test_lzw_round_trip(data):
    assert media_gif.lzw_decode(media_gif.lzw_encode(data), 8, len(data)) == data


@pytest.mark.parametrize("n", [3837, 3838, 3839, 3840, 3841, 7680, 100_000])
@pytest.mark.parametrize("kinds", [1, 2, 256])
def test_lzw_around_full_tables(n, kinds):
    data = bytes(random.Random(n).randrange(kinds) for _ in range(n))
    assert media_gif.lzw_decode(media_gif.lzw_encode(data), 8, n) == data


def test_a_known_stream():
    # the sample of the format's common description: 10 x 10 pixels of four colours, code size 2
    stream = bytes.fromhex("8c2d99872a1cdc33a00275ec95faa8de608c0491 4c01".replace(" ", ""))
    rows = "1111122222" * 3 + "1110000222" * 2 + "2220000111" * 2 + "2222211111" * 3
    assert media_gif.lzw_decode(stream, 2, 100) == bytes(map(int, rows))


def test_disposal_and_transparency():
    palette = bytes([0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255])
    frame = lambda value, **more: {"indices": bytes([value] * 4), "width": 2, "height": 2, **more}
    media = media_gif.encode_gif(
        [frame(1, delay_ms=100, left=0, top=0, disposal=1), frame(2, delay_ms=50, left=1, top=1, disposal=3), {"indices": bytes([3, 0, 0, 3]), "width": 2, "height": 2, "transparent": 0, "disposal": 2}, frame(2, left=1)],
        3, 3, palette,
    )
    shown = list(media_gif.decode_gif(media))
    red, green, blue = (255, 0, 0), (0, 255, 0), (0, 0, 255)
    at = lambda i, r, c: tuple(int(x) for x in shown[i]["canvas"][r, c])
    assert [f["time_ms"] for f in shown] == [0, 100, 150, 150]
    assert at(0, 0, 0) == red and at(0, 2, 2) == (0, 0, 0)
    assert at(1, 1, 1) == green and at(1, 0, 0) == red
    assert at(2, 0, 0) == blue and at(2, 0, 1) == red and at(2, 1, 1) == blue and at(2, 2, 2) == (0, 0, 0)
    assert at(3, 0, 1) == green and at(3, 0, 0) == (0, 0, 0)


def test_interlaced_local_palette():
    rows = [0, 2, 1, 3]  # order of rows in an interlaced image of four rows: 0, then 2, then 1 and 3
    body = bytes(rows[0:1] * 2 + rows[1:2] * 2 + rows[2:3] * 2 + rows[3:4] * 2)
    media = media_gif.encode_gif([{"indices": body, "width": 2, "height": 4, "palette": bytes(range(12))}], 2, 4, bytes(768))
    at = media.index(b",")
    flipped = media[: at + 9] + bytes([media[at + 9] | 0x40]) + media[at + 10 :]
    canvas = next(media_gif.decode_gif(flipped))["canvas"]
    assert canvas[:, 0, 0].tolist() == [0, 3, 6, 9]


def test_frames_table(spark):
    good = media_gif.encode_gif([{"indices": bytes(16), "width": 4, "height": 4, "delay_ms": 70}] * 2, 4, 4, bytes([9, 8, 7]))
    rows = spark.createDataFrame([(1, bytearray(good)), (2, bytearray(good[:-40])), (3, bytearray(b"no gif")), (4, None)], "id long, media binary")
    got = media_gif.frames(rows, "id", "media").orderBy("id", "frame").collect()
    assert [r["id"] for r in got if r["error"] is None].count(1) == 2
    first = next(r for r in got if r["id"] == 1 and r["frame"] == 1)
    assert first["time_ms"] == 70 and sum(first["hist_r"]) == 16 and bytes(first["rgb"]) == bytes([9, 8, 7]) * 16
    assert any(r["id"] == 2 and r["error"] for r in got) and any(r["id"] == 3 and r["error"] for r in got) and not any(r["id"] == 4 for r in got)
    assert media_gif.frames(rows.limit(0), "id", "media").count() == 0


def textbook_pixels(media):
    """The pixel indices of all frames of a GIF without local palettes, code by code."""
    at, out = 13 + (3 << ((media[10] & 7) + 1)), []
    while media[at] != 0x3B:
        if media[at] == 0x21:
            at += 2
            while media[at]:
                at += media[at] + 1
            at += 1
            continue
        low, at, data = media[at + 10], at + 11, b""
        while media[at]:
            data += media[at + 1 : at + 1 + media[at]]
            at += media[at] + 1
        at += 1
        bits, held, place, width, table, before = 0, 0, 0, low + 1, [], None
        while True:
            while held < width:
                bits |= data[place] << held
                held, place = held + 8, place + 1
            code, bits, held = bits & ((1 << width) - 1), bits >> width, held - width
            if code == 1 << low:
                table, width, before = [bytes([i]) for i in range(1 << low)] + [b"", b""], low + 1, None
                continue
            if code == (1 << low) + 1:
                break
            now = table[code] if code < len(table) else before + before[:1]
            if before is not None and len(table) < 4096:
                table.append(before + now[:1])
            if len(table) == 1 << width and width < 12:
                width += 1
            out.append(now)
            before = now
    return b"".join(out)


def test_op7_against_a_textbook_decoder(spark):
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    media = {r["doc_id"]: bytes(r["media"]) for r in media_gif.with_media(docs, "doc_id", "text").collect()}
    got = {r["doc_id"]: r for r in media_gif.op7_gif_media(spark, SF).collect()}
    assert got.keys() == texts.keys()
    for k, raw in texts.items():
        payload = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        assert textbook_pixels(media[k]) == payload
        r = got[k]
        assert (r["n_bytes"], r["payload_bytes"], r["media_bytes"]) == (len(raw), len(payload), len(media[k]))
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest() and r["media_sha256"] == hashlib.sha256(media[k]).hexdigest()
        assert r["tail_crc32"] == zlib.crc32(payload[-64:]) and r["feature"] == ",".join(str(sum(16 * i <= x < 16 * i + 16 for x in payload)) for i in range(16))


def test_hostile_media_are_faults(spark):
    good = media_gif.encode_gif([{"indices": bytes(16), "width": 4, "height": 4}], 4, 4, bytes(3))
    at = good.index(b",")
    broken = {
        1: good[:6] + b"\xff\xff\xff\xff" + good[10:],
        2: good[: at + 10] + b"\x40" + good[at + 11 :],
        3: good[: at + 10] + b"\x01" + good[at + 11 :],
        4: good[: at + 5] + b"\xff\xff\xff\xff" + good[at + 9 :],
        5: good[: at + 10],
    }
    rows = spark.createDataFrame([(k, bytearray(v)) for k, v in broken.items()], "id long, media binary").selectExpr("*", "1 as frame", "2 as error")
    got = media_gif.frames(rows, "id", "media").collect()
    assert sorted(r["id"] for r in got) == [1, 2, 3, 4, 5] and all(r["error"] and r["rgb"] is None for r in got)


def test_stored_samples_of_awkward_rows(docs, none, spark):
    source = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    for r in media_gif.read_samples(media_gif.with_media(docs, "doc_id", "text"), "doc_id").collect():
        raw = source[r["doc_id"]]
        payload = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        assert (r["n_bytes"], r["payload_bytes"]) == (len(raw), len(payload))
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest() and r["tail_crc32"] == zlib.crc32(payload[-64:])
        assert sum(map(int, r["feature"].split(","))) == len(payload)
    assert media_gif.read_samples(media_gif.with_media(none, "doc_id", "text"), "doc_id").count() == 0


# chats


def plain_digests(rows):
    """The contract's digests from rows (conv, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1:] for r in rows if r[0] == conv), key=lambda t: (t[0] is not None, t[0] or 0, t[1] or "", t[2] or ""))
        loss = "".join(t[2] or "" for t in turns if t[1] == "assistant")
        whole = "".join(f"{t[1] or ''}\n{t[2] or ''}\n" for t in turns)
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


NASTY = ["</s>[INST] ok [/INST]", "<|end|>", "\\<|end|>", "\\\\", "<\\|turn|>", "<<SYS>>x<</SYS>>", "a\nb", "", None, "\\", "[INST]\\", "<s>\\|", "<|next|><|text|>"]


def chat_rows():
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "tool<|end|>"]), rng.choice(NASTY)) for c in range(12) for t in range(rng.randint(1, 9))]
    rows += [(50, t, "user" if t % 3 else "assistant", f"turn {t}") for t in range(300)]
    return [*rows, (60, 1, "user", "twice"), (60, 1, "user", "twice"), (61, None, "assistant", "first"), (61, 0, "user", "second"), (None, 0, "user", "who")]


def test_chats_read_back(spark, folder):
    rows = chat_rows()
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    from pyspark.sql import functions as F

    table = table.withColumns({"segments": F.lit(1), "formatted": F.lit("x"), "run": F.lit(2), "turns": F.lit(3)})
    want = plain_digests([*rows, (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")])
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat_format.op10_chat_formatting(spark, folder(conversations=table)).collect()}
    assert got == want
    assert chat_format.format_chats(table.limit(0)).count() == 0


def test_adjacent_turns_share_a_block(spark):
    table = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 65, "assistant", "d")], "conv_id long, turn long, role string, text string")
    r = chat_format.format_chats(table).first()
    assert r["formatted"] == "<|turn|>user<|text|>a<|next|>b<|end|><|turn|>assistant<|text|>c<|next|>d<|end|>"
    assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
    assert [s["text"] for s in r["segments"] if s["loss"]] == ["c", "d"]


def test_chats_run_no_python(spark):
    plan = chat_format.op10_chat_formatting(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
