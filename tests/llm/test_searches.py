"""Long runs in tokens, secrets, collocations, hard negatives."""

import hashlib
import random
import re
import secrets as random_source
import string
import uuid
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from dotweave.llm import collocations, hard_negatives, secret_scan, tokenize_bpe

SF = "/root/testdata/sf0.001"


def enc():
    return tokenize_bpe.encoder(*tokenize_bpe.public_ranks())


# long runs


def merged_plainly(ranks, raw):
    """Byte-pair merging as defined: the pair of lowest rank, the leftmost of equal ones, until none is left."""
    parts = [bytes([b]) for b in raw]
    while True:
        some = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not some:
            return [ranks[p] for p in parts]
        i = min(some)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab \n-=e1é", min_size=1, max_size=120), st.integers(1, 12))
def test_merge_pairs_is_the_plain_merge(part, times):
    ranks, single, _ = tokenize_bpe._PARTS[id(enc())]
    raw = (part * times).encode()[:600]
    assert tokenize_bpe.merge_pairs(ranks, single, raw) == merged_plainly(ranks, raw)


@pytest.mark.parametrize("part", [" ", "\n", "\t", "a", "-", "é", "ab", "aab", "\t\n", "the"])
def test_rounds_of_equal_pairs_give_what_the_heap_gives(part):
    ranks, single, _ = tokenize_bpe._PARTS[id(enc())]
    raw = (part * 20_001).encode()
    assert tokenize_bpe.merge_pairs(ranks, single, raw) == tokenize_bpe._merge_by_heap(ranks, [bytes([b]) for b in raw])


@pytest.mark.parametrize("run", [" ", "\n", "\t", "e", "-", "7"])
@pytest.mark.parametrize("frame", ["{}", "{} x", "it's{}", "a b{}c d", "'{}s"])
def test_long_runs_give_the_ids_of_the_library(run, frame):
    text = frame.format(run * 30_000)
    want = enc().encode_ordinary(text)
    assert tokenize_bpe.encode(enc(), text) == want == tokenize_bpe.encode_array(enc(), text).tolist()


def test_runs_that_overflow_the_library_pass_op5_and_the_token_stage(spark, folder):
    texts = {0: " " * 1_000_000, 1: "start " + " " * 1_000_000 + " end", 2: "\n" * 100_000 + "end", 3: "x" + "\t" * 1_000_000, 4: " " * 10_000_000 + "y", 5: "plain"}
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    path = folder(documents=docs)
    for r in tokenize_bpe.op5_byte_bpe(spark, path).collect():
        text = texts[r["doc_id"]]
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest() and 0 < r["n_tokens"] <= len(text)
    made = corpus_pipeline.tokens(spark, spark.read.parquet(f"{path}/documents.parquet"), path).select("doc_id", F.size("ids").alias("n")).collect()
    assert {r["doc_id"] for r in made} == set(texts)
    # a run of one character alone: every merge is known
    ranks, single, _ = tokenize_bpe._PARTS[id(enc())]
    assert tokenize_bpe.encode(enc(), " " * 100_000) == tokenize_bpe._merge_by_heap(ranks, [b" "] * 100_000)


# secrets


def base_plainly(text):
    """Base spans by the patterns as stated, length tests after the scan."""
    key = re.compile(r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    found = [("assign", m.start(), m.end()) for m in key.finditer(text) if len(m.group(1)) >= 8]
    found += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["password", "PassWd", "secret", "token", "api_key", "APIKEY", "=", ": ", '"', "'", "AKIA", "ABCDEF0123456789", "deadbeef" * 4, "abc", " ", "\n", "é", "ſecret", "toKen", "x/y+z=", "😀"]), max_size=14))
def test_base_spans_are_those_of_the_patterns(parts):
    text = "".join(parts)
    assert [(secret_scan.KINDS[k], a, b) for a, k, b in secret_scan.base_spans(text)] == base_plainly(text)


def test_random_strings_are_found_and_prose_names_digests_and_identifiers_are_not():
    rng = random.Random(5)
    drawn = ["".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n)) for n in (20, 24, 32, 48) for _ in range(60)]
    assert all(secret_scan.is_random(enc(), x) for x in drawn)
    assert all(secret_scan.is_random(enc(), random_source.token_urlsafe(33).strip("-_")) for _ in range(50))
    plain = [
        "internationalization_helper_function", "org.apache.spark.sql.catalyst.expressions", "Rindfleischetikettierungsueberwachung", "anticonstitutionnellement", "=" * 80, "-" * 70 + "abc", "2021-03-04/12.30.55-000000001", str(uuid.UUID(int=7 << 100)),
        hashlib.md5(b"x").hexdigest(), hashlib.sha256(b"x").hexdigest().upper(), "sha256-" + "47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU=", "10.1145/3588195.3592996-abcdefgh", "01ARZ3NDEKTSV4RRFFQ69G5FAV", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
    ]
    assert [x for x in plain if secret_scan.is_random(enc(), x)] == []
    text = f"see https://host.example.org/v1/{drawn[0]}/list and {drawn[1]}."
    assert [text[a:b] for a, _, b in secret_scan.random_spans(enc(), text, [])] == drawn[:2]
    assert secret_scan.random_spans(enc(), text, [(0, 0, len(text))]) == []
    assert not secret_scan.is_random(enc(), drawn[2], known={drawn[2]})


def test_secret_spans_of_awkward_rows(docs, none, spark):
    ranks = tokenize_bpe.public_ranks()
    clashing = docs.withColumn("secrets", F.lit("mine"))
    got = secret_scan.with_secrets(clashing, *ranks)
    assert got.columns[-1] == "secrets_" and got.count() == docs.count() and {r["secrets"] for r in got.collect()} == {"mine"}
    assert secret_scan.with_secrets(none, *ranks).count() == 0
    key = "".join(random.Random(9).choices(string.ascii_letters + string.digits, k=40))
    rows = [(1, "é" * 200_000 + f" token = 'abcdefgh12' {key} " + "😀" * 10), (1, "é" * 200_000 + f" token = 'abcdefgh12' {key} " + "😀" * 10), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = secret_scan.with_secrets(df, *ranks)
    for r in found.collect():
        if r["doc_id"] > 1:
            assert r["secrets"] == []
        else:
            assert [(s["kind"], r["text"][s["start"] : s["end"]]) for s in r["secrets"]] == [("assign", "token = 'abcdefgh12"), ("random", key)]
    hidden = {r["doc_id"]: r["text"] for r in secret_scan.with_redacted(found).collect()}
    assert hidden[1] == "é" * 200_000 + " " + "*" * 19 + "' " + "*" * 40 + " " + "😀" * 10 and hidden[2] is None and hidden[3] == ""


def test_redaction_of_overlapping_spans(spark):
    df = spark.createDataFrame([("0123456789", [("a", 1, 4), ("b", 2, 6), ("c", 3, 5), ("d", 8, 10)])], "text string, secrets array<struct<kind string, start int, end int>>")
    assert secret_scan.with_redacted(df).first()["text"] == "0*****67**"


def test_op11_is_the_scan_of_every_text(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = secret_scan.op11_secret_scan(spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        base = base_plainly(texts[r["doc_id"]])
        kinds = Counter(k for k, *_ in base)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        all_of = [x.split(":") for x in r["spans"].split(",") if x]
        assert [x for x in all_of if x[0] != "random"] == [[k, str(a), str(b)] for k, a, b in base]


# collocations


def phrases_plainly(rows, least, absorb, top):
    f, words = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            w = [x for x in re.split("[\x20\x09]+", piece) if x]
            words[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        some = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = {p[i : i + n] for p, a in some.items() for n in range(2, len(p)) for i in range(len(p) - n + 1) if 100 * a >= absorb * counts[p[i : i + n]]}
        rows_ = []
        for p, a in some.items():
            if p not in gone:
                score, _, l, r = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                rows_.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows_)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, words[lang], -s))
    return sorted(out)


def some_texts(seed, n):
    rng = random.Random(seed)
    stock = ["red", "green", "Blue", "in the", "of course I do", "x.y", "é", "naïve café", "one\ttwo", "end.", "stop!\n", "", "  ", "a" * 70]
    return [(rng.choice(["en", "de", None, "und", "l l"]), " ".join(rng.choice(stock) for _ in range(rng.randrange(40)))) for _ in range(n)] + [("en", None), (None, ""), ("de", "\v\f.."), ("fr", "only few words")]


@pytest.mark.parametrize("least, absorb, top, seed", [(3, 80, 40, 1), (10, 50, 5, 2), (1, 100, 2000, 3)])
def test_collocations_are_those_of_counting_all(spark, least, absorb, top, seed):
    rows = some_texts(seed, 150)
    df = spark.createDataFrame([(lang, text, 1, "x") for lang, text in rows], "lang string, text string, a int, phrase string").repartition(5)
    want = phrases_plainly(rows, least, absorb, top)
    assert sorted(map(tuple, collocations.collocations(df, least, absorb, top).collect())) == want and want
    assert sorted(map(tuple, collocations.collocations_by_joins(df, least, absorb, top).collect())) == want
    assert sorted(map(tuple, collocations.collocations(df, least, absorb, top, most=2).collect())) == want


def test_many_candidates_are_counted_by_numbers(docs, spark, monkeypatch):
    """More candidates than are broadcast, words that are: no texts are cut into strings of phrases."""
    monkeypatch.setattr(collocations, "collocations_by_joins", None)
    monkeypatch.setattr(collocations, "KEYS", 50)
    for seed, least, absorb, top in ((1, 2, 80, 50), (2, 3, 50, 2000), (3, 1, 100, 2000)):
        rows = some_texts(seed, 150)
        df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
        want = phrases_plainly(rows, least, absorb, top)
        assert sorted(map(tuple, collocations.collocations(df, least, absorb, top, held=2).collect())) == want and want
    want = phrases_plainly([(r["lang"], r["text"]) for r in docs.collect()], 2, 80, 500)
    assert sorted(map(tuple, collocations.collocations(docs, 2, 80, 500, held=2).collect())) == want
    assert collocations.collocations(docs.limit(0), held=-1).collect() == []


def test_collocations_of_awkward_rows(docs, none, spark):
    assert collocations.collocations(none).collect() == []
    assert collocations.collocations(docs.limit(0)).collect() == []
    want = phrases_plainly([(r["lang"], r["text"]) for r in docs.collect()], 2, 80, 500)
    assert sorted(map(tuple, collocations.collocations(docs, 2, 80, 500).collect())) == want


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(0, 2**62), max_size=400), st.sets(st.integers(0, 2**62), max_size=200))
def test_perfect_hash_is_minimal_and_knows_strangers(keys, others):
    keys, others = np.array(sorted(keys), np.int64), np.array(sorted(others - keys), np.int64)
    made = collocations.PerfectHash(keys)
    assert sorted(made.slots(keys).tolist()) == list(range(len(keys))) and (made.slots(others) == -1).all()
    assert (made.keys[made.slots(keys)] == keys).all()


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 10**15), st.integers(0, 10**15), st.integers(0, 10**15))
def test_scores_are_exact_beyond_64_bits(a, more, most):
    both = 2 * a + more + most
    assert collocations._scores(np.array([a]), np.array([both]))[0] == 2_000_000 * a // both


# hard negatives


def negatives_plainly(rows, positives, negatives, anchor):
    good = [(i, lab, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, lab in rows if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    anchors = {}
    for i, lab, v in good:
        if anchor(i) and (i not in anchors or (lab, v) < anchors[i]):
            anchors[i] = (lab, v)
    out = []
    for i, (lab, v) in anchors.items():
        scored = sorted(((-sum(x * y for x, y in zip(v, w)), j, l) for j, l, w in good if j != i))
        for s, j, _ in [x for x in scored if x[2] == lab][:positives]:
            inside = [(t, k) for t, k, l in scored if l != lab and -30 * s <= -100 * t <= -90 * s][:negatives]
            out += [(i, j, rank, k, -s, -t) for rank, (t, k) in enumerate(inside, 1)]
    return sorted(out)


@pytest.mark.parametrize("cells, block, dims, spread", [(256, 2048, 8, 1.0), (4, 3, 8, 1.0), (16, 2, 3, 40.0), (256, 5, 1, 0.02)])
def test_hard_negatives_are_those_of_scoring_all(spark, cells, block, dims, spread):
    rng = np.random.default_rng(dims)
    centre = rng.normal(0, spread, dims)
    rows = [(i, [float(np.float32(x)) for x in centre + rng.normal(0, spread / 2, dims)], int(rng.integers(0, 4))) for i in range(400)]
    rows += [(1000 + i, rows[7][1], 2) for i in range(60)]  # one vector, many rows
    rows += [(rows[20]), (20, rows[3][1], 1), (None, rows[3][1], 1), (2000, None, 1), (2010, [None] * dims, 1), (2020, [float("nan")] * dims, 1), (2030, [float("inf")] * dims, 1), (2040, rows[0][1], None), (2050, [], 2), (2060, rows[5][1] + [0.5], 3)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, window string, rank int").repartition(6)
    usable = hard_negatives.usable(df)
    got = hard_negatives.hard_negatives(usable, F.col("vec_id") % 10 == 0, 5, 10, cells=cells, block=block)
    assert sorted(map(tuple, got.collect())) == negatives_plainly(rows, 5, 10, lambda i: i % 10 == 0)


def test_hard_negatives_without_rows_or_anchors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.hard_negatives(hard_negatives.usable(empty), F.col("vec_id") % 100 == 0).collect() == []
    one = spark.createDataFrame([(100, [1.0], 1), (7, [2.0], 2)], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.hard_negatives(hard_negatives.usable(one), F.col("vec_id") % 100 == 0).collect() == []
    huge = spark.createDataFrame([(100, [1e9], 1), (7, [2.0], 1)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(Exception, match="may not fit"):
        hard_negatives.hard_negatives(hard_negatives.usable(huge), F.col("vec_id") % 100 == 0).collect()


def test_bounds_hold_and_spare_most_exact_scores():
    rng = np.random.default_rng(1)
    x = rng.integers(-140, 140, (3000, 64))
    q = rng.integers(-140, 140, (10, 64))
    cells = hard_negatives.Cells(x.min(axis=0), x.max(axis=0))
    lower, upper = cells.bounds(q, cells.codes(x))
    exact = q @ x.T
    assert (lower <= exact).all() and (exact <= upper).all()
    best = np.partition(lower, 2995, axis=1)[:, 2995]
    assert (upper >= best[:, None]).mean() < 0.05
