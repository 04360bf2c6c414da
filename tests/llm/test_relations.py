"""Near duplicates, mixing, languages, archives, and the pipeline."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

import corpus_pipeline
from dotweave.llm import jaccard_join, language_evidence, pfair_mix, quality_cnn, shingles, tokenize_bpe, toxicity, warc
from dotweave.llm.components import components

SF = "/root/testdata/sf0.001"


# n-gram Jaccard join


def shingle_set(text):
    words = [w for w in re.split(r"[\t\n\x0b\x0c\r ]+", (text or "").lower()) if w]
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute_links(rows):
    """Links and class of each row number, by comparing all pairs that share a shingle."""
    sets = [shingle_set(t) for _, t in rows]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    common = Counter(p for h in holders.values() for p in itertools.combinations(h, 2))
    top, links = list(range(len(rows))), Counter()

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for (a, b), n in common.items():
        if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
            links[a] += 1
            links[b] += 1
            x, y = root(a), root(b)
            top[max(x, y)] = min(x, y)
    order = lambda k: (k is not None, k or 0)
    least = {}
    for i, (k, _) in enumerate(rows):
        r = root(i)
        least[r] = min(least.get(r, k), k, key=order)
    return [(k, least[root(i)], links[i]) for i, (k, _) in enumerate(rows)]


def near_copies(n=70):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(120)]
    passage = [rng.choice(words) for _ in range(60)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(1000)}"
        rows.append((i, " ".join(w)))
    for i in range(n, 2 * n):  # share a passage, but little else
        rows.append((i, " ".join([rng.choice(words) for _ in range(150)] + passage)))
    return [*rows, (2 * n, rows[3][1]), (2 * n + 1, rows[3][1].upper())]


def test_shingle_sets_against_plain_python():
    texts = ["", " ", "a", "a b c d", "a b c d e", "a b c d e f a b c d e f", "x\ty\nz", "tail ", " head", "é ü ñ ß ø é ü", "a" * 3000, "one two three four five six"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    values, counts = shingles.shingle_sets(data, offsets)
    assert counts.tolist() == [len(shingle_set(t)) for t in texts]
    assert len(values) == counts.sum()
    one, _ = shingles.shingle_sets(np.frombuffer(b"xx one two three four five six", np.uint8)[3:], np.array([0, 27]))
    assert np.array_equal(np.sort(one), np.sort(values[-2:]))


@pytest.mark.parametrize("limits", [{}, {"LIMIT": 4, "NODE_BLOCK": 16, "GROUP_BLOCK": 8}, {"LIMIT": 4, "NODE_BLOCK": 1000, "GROUP_BLOCK": 64}])
def test_join_finds_what_brute_force_finds(spark, monkeypatch, limits):
    for k, v in limits.items():
        monkeypatch.setattr(jaccard_join, k, v)
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard_join.near_duplicates(docs).collect())
    assert got == sorted(brute_links(rows))
    kept = sorted(r["doc_id"] for r in jaccard_join.keep_one(docs).collect())
    assert kept == sorted({c for _, c, _ in got})


def test_join_of_the_sample_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard_join.op1_jaccard_join(spark, SF).collect())
    assert got == sorted(brute_links(rows))


def test_join_recall_at_a_thousand_documents(spark):
    tables = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{tables}/documents.parquet").collect()]
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_join.op1_jaccard_join(spark, tables).collect()}
    want = {k: (c, n) for k, c, n in brute_links(rows)}
    assert sum(n for _, n in got.values()) >= 0.999 * sum(n for _, n in want.values()) > 0
    assert all(got[k][1] <= n for k, (_, n) in want.items()) and sum(got[k] != want[k] for k in want) <= len(want) // 200


def test_a_chain_of_boilerplate_is_no_class(spark, monkeypatch):
    """Documents that share most, but too little, with their neighbours: one candidate group, no links; near copies inside are found."""
    monkeypatch.setattr(jaccard_join, "GROUP_BLOCK", 16)
    monkeypatch.setattr(jaccard_join, "LIMIT", 8)
    words = [f"w{i}" for i in range(3000)]
    rows = [(i, " ".join(words[i * 12 : i * 12 + 80])) for i in range(200)]
    rows += [(1000 + i, " ".join([*words[i * 12 : i * 12 + 79], "other"])) for i in range(0, 200, 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard_join.near_duplicates(docs).collect())
    assert got == sorted(brute_links(rows)) and sum(n for *_, n in got) == 40
    assert sorted(r["doc_id"] for r in jaccard_join.keep_one(docs).collect()) == list(range(200))


def test_bloom_filter_keeps_every_key(spark):
    from dotweave.llm import bloom

    keys = spark.range(0, 90_000, 3).selectExpr("id * 7919 - 5 as k").union(spark.createDataFrame([(None,)], "k long"))
    test = bloom.build(keys, "k")
    all_ = np.arange(90_000, dtype=np.int64) * 7919 - 5
    hit = test(all_)
    assert hit[::3].all() and hit.mean() < 0.36
    assert not bloom.build(keys.limit(0), "k")(all_).any()
    table = spark.range(90_000).selectExpr("id", "id * 7919 - 5 as k")
    from pyspark.sql import functions as F

    assert table.filter(bloom.may_be_among(test, F.col("k"))).count() == int(hit.sum())


def test_repeated_rows_stay_once(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, "a"), (1, text, "a"), (2, text, "b"), (2, text, "b"), (3, text + " x", "c"), (4, "", "d"), (4, "", "d"), (5, None, "e"), (None, text, "f"), (None, text, "f")]
    kept = jaccard_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(4, "", "d"), (4, "", "d"), (5, None, "e"), (None, text, "f")], key=str)


def test_join_of_awkward_rows(spark, docs, none):
    got = sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard_join.near_duplicates(docs).collect()), key=str)
    assert got == sorted(brute_links([(r["doc_id"], r["text"]) for r in docs.collect()]), key=str)
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, None, 5, 6, 8, 9], key=str)
    assert jaccard_join.near_duplicates(none).count() == 0 and jaccard_join.keep_one(none).count() == 0


def test_recursion_inside_a_task(monkeypatch):
    monkeypatch.setattr(jaccard_join, "LIMIT", 4)
    texts = [t.lower() for _, t in near_copies()]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    values, counts = shingles.shingle_sets(data, np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])]))
    sig, top = jaccard_join.signatures(values, counts), list(range(len(texts)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for run in range(jaccard_join.runs() * 3):
        found = []
        jaccard_join.descend(np.uint64(run + 1), sig, counts, 0, np.arange(len(texts)), 10**9, found)
        for a, b in found:
            top[max(root(a), root(b))] = min(root(a), root(b))
    links = brute_links(list(enumerate(texts)))
    assert all(root(k) == root(c) for k, c, _ in links)


def test_recall_of_runs():
    assert 0.7 < jaccard_join.found_at(jaccard_join.DEPTH) < jaccard_join.found_at(1) < 1
    assert 1 - (1 - jaccard_join.found_at(jaccard_join.DEPTH)) ** jaccard_join.runs() >= jaccard_join.TARGET


def test_intersections_against_python():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 9000, n).astype(np.uint64)) for n in rng.integers(1, 5000, 30)]
    left, right = np.arange(0, 20), np.arange(5, 30)
    got = jaccard_join.intersections(sets, left, right)
    assert all(got[i, j] == len(set(sets[a].tolist()) & set(sets[b].tolist())) for i, a in enumerate(left) for j, b in enumerate(right) if a != b)


@pytest.mark.parametrize("hub", [2_000, 10])
def test_components(spark, monkeypatch, hub):
    from dotweave.llm import components as module

    monkeypatch.setattr(module, "HUB", hub)
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    top = {}

    def root(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            top[max(x, y)] = min(x, y)
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: root(k) for k in top}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# Pfair mixing


def test_cycles_stay_within_a_block():
    for weights in ({"a": 5, "b": 3, "c": 2}, {"a": 1, "b": 999}, {str(i): i for i in range(1, 30)}):
        q = pfair_mix.quantise(weights)
        assert sum(q.values()) == pfair_mix.RESOLUTION and min(q.values()) >= 1
        slots, done = pfair_mix.cycle(q), Counter()
        for t, s in enumerate(slots, 1):
            done[s] += 1
            assert all(abs(done[x] - t * q[x] / pfair_mix.RESOLUTION) < 1 for x in q)
        assert done == q
    with pytest.raises(ValueError):
        pfair_mix.quantise({"a": 0, "b": 1})


def simulated(blocks, q):
    """Slot by slot: earliest deadline first among released blocks, starting afresh when a source has ended."""
    left, order = dict(blocks), []
    while any(left.values()):
        active = {s: q[s] for s in left if left[s]}
        total, done, t = sum(active.values()), Counter(), 0
        while all(left[s] for s in active):
            ready = [s for s in active if done[s] * total // active[s] <= t]
            s = min(ready, key=lambda s: (-(-(done[s] + 1) * total // active[s]), s is None, str(s)))
            order.append(s)
            done[s] += 1
            left[s] -= 1
            t += 1
    return order


def test_positions_follow_the_simulation(spark, monkeypatch):
    monkeypatch.setattr(pfair_mix, "BUCKET", 7)
    sizes = {"a": 151, "b": 60, "c": 33, None: 9}
    rows = [(i, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    got = pfair_mix.positions(docs, {"a": 0.5, "b": 0.3, "c": 0.15, None: 0.05}, block=4, resolution=100).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(len(rows))) and sorted(r["doc_id"] for r in got) == list(range(len(rows)))
    order = [s for s, _ in itertools.groupby(got, key=lambda r: (r["slot"], r["source"]))]
    q = pfair_mix.quantise({"a": 0.5, "b": 0.3, "c": 0.15, None: 0.05}, 100)
    assert [s for _, s in order] == simulated({s: -(-n // 4) for s, n in sizes.items()}, q)


def off_target(where, weights):
    """The largest deviation, in blocks, from the given weights until a source has ended; it peaks before and after a block."""
    total, end, worst = sum(map(Fraction, weights.values())), min(at[-1] for at in where.values()) + 1, 0
    for s, at in where.items():
        w = Fraction(weights[s]) / total
        at = [int(t) for t in at if t < end]
        worst = max(worst, abs(end * w - len(at)), *(max(abs(t * w - k), abs((t + 1) * w - k - 1)) for k, t in enumerate(at)))
    return worst


def test_exact_weights_stay_within_a_block():
    half = {"big": 5000} | {f"s{i}": 7 for i in range(900)}
    third = {"big": 25_000} | {f"s{i}": 2500 for i in range(19)}
    for blocks, weights in (
        ({"a": 5400, "b": 1000}, {"a": Fraction(9, 10), "b": Fraction(1, 10)}),
        (half, {s: Fraction(1, 2) if s == "big" else Fraction(1, 1800) for s in half}),
        (third, {s: n**0.7 for s, n in third.items()}),
    ):
        where = pfair_mix.schedule(blocks, pfair_mix.exact(weights))
        assert {s: len(at) for s, at in where.items()} == blocks
        assert sorted(t for at in where.values() for t in at.tolist()) == list(range(sum(blocks.values())))
        assert off_target(where, weights) < 1


def test_positions_hold_targets_and_many_sources(spark):
    weights, where = {"a": Fraction(9, 10), "b": Fraction(1, 10)}, defaultdict(list)
    docs = spark.range(3600).selectExpr("id as doc_id", "if(id < 3200, 'a', 'b') as source")
    for r in pfair_mix.positions(docs, weights, block=1).orderBy("position").collect():
        where[r["source"]].append(r["slot"])
    assert off_target(where, weights) < 1
    docs = spark.range(3300).selectExpr("id as doc_id", "concat('s', id % 1100) as source")
    got = pfair_mix.positions(docs, block=2).collect()
    assert sorted(r["position"] for r in got) == list(range(3300)) and len({r["slot"] for r in got}) == 2200


def test_mix_of_awkward_rows(spark, docs, none):
    mixed = pfair_mix.mixed(docs)
    assert mixed.columns == docs.columns and sorted(map(str, mixed.collect())) == sorted(map(str, docs.collect()))
    placed = pfair_mix.positions(docs).collect()
    assert sorted(r["position"] for r in placed) == list(range(docs.count()))
    assert pfair_mix.mixed(none).count() == 0 and pfair_mix.positions(none).count() == 0


def test_op4_places_whole_documents(spark):
    docs = {r["doc_id"]: tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = pfair_mix.op4_pfair_mix(spark, SF).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(len(docs))) and {r["doc_id"]: tuple(r)[:5] for r in got} == docs
    sizes = Counter(r["source"] for r in got)
    blocks = {s: -(-n // pfair_mix.BLOCK) for s, n in sizes.items()}
    where = pfair_mix.schedule(blocks, pfair_mix.exact({s: n**pfair_mix.TEMPER for s, n in sizes.items()}))
    assert all(where[r["source"]][r["block"]] == r["slot"] for r in got)


def test_null_ids_are_dealt_apart(spark, monkeypatch):
    monkeypatch.setattr(pfair_mix, "BUCKET", 10)
    docs = spark.range(1000).selectExpr("cast(null as long) as doc_id", "'s' as source", "id as n_chars", "map('a', id) as extra")
    rows = pfair_mix.placed(docs)
    assert sorted(r["position"] for r in rows.collect()) == list(range(1000))


def test_files_keep_the_mix(spark, tmp_path):
    docs = spark.range(2000).selectExpr("id as doc_id", "concat('s', floor(sqrt(id)) % 5) as source", "repeat('x', id % 900) as text")
    want = [r["doc_id"] for r in pfair_mix.positions(docs, block=3).orderBy("position").collect()]
    pfair_mix.mixed(docs, block=3).write.parquet(str(tmp_path / "mix"))
    written = spark.read.parquet(str(tmp_path / "mix"))
    assert written.select("_metadata.file_name").distinct().count() > 2
    got = pfair_mix.file_positions(written).collect()
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["position"])] == want
    assert pfair_mix.file_positions(docs).filter("position is not null").count() == 0


def test_the_pipeline_keeps_the_mix(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["position"] for r in got) == list(range(len(got)))
    source = spark.read.parquet(f"{SF}/documents.parquet")
    kept = source.join(spark.createDataFrame([(r["doc_id"],) for r in got], "doc_id long"), "doc_id", "left_semi")
    want = [r["doc_id"] for r in pfair_mix.positions(kept).orderBy("position").collect()]
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["position"])] == want


# languages


def language_tables(spark):
    rng = random.Random(0)
    words = {"en": ["the", "and", "thing", "other"], "de": ["der", "und", "schön", "keit"]}
    text = lambda k, n: " ".join(rng.choice(words[k]) for _ in range(n))
    docs = [(i, text(k, 60), k) for i, k in enumerate(["en", "de"] * 30)]
    pages = [(i, f"http://a.example.org/{k}/{i}", f'<html lang="{k}"><script>var x="der der";</script><p>{text(k, 30)}</p>') for i, k in enumerate(["en", "de"] * 25)]
    # a German host without markup, one page of it without text
    pages += [(100 + i, f"http://www.blog.example.de/x{i}", f"<p>{text('de', 40)}</p>") for i in range(20)]
    pages += [(200, "http://www.blog.example.de/x", "<p></p>"), (201, None, None), (202, "nonsense", ""), (200, "http://www.blog.example.de/x", "<p></p>")]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(pages, "page_id long, url string, html string")


def test_languages_fuse_evidence(spark, folder):
    docs, pages = language_tables(spark)
    got = language_evidence.op6_language_evidence(spark, folder(documents=docs, pages=pages)).collect()
    by = {r["page_id"]: r for r in got}
    assert len(got) == pages.count() and all(by[i]["lang"] == ["en", "de"][i % 2] for i in range(50))
    assert all(by[100 + i]["lang"] == "de" for i in range(20))
    assert by[200]["lang"] == "de"  # the host's other pages speak for it
    assert all(0.4 < r["probability"] <= 1 for r in got)


def test_language_sums_to_one_and_empty(spark, folder):
    docs, pages = language_tables(spark)
    ev = language_evidence.text_evidence(pages.selectExpr("page_id", "html as text", "'x' as declared", "'h' as host", "'d' as domain", "'s' as suffix", "'' as named"), "text", np.zeros((language_evidence.SLOTS, 2), np.float32))
    for r in language_evidence.fuse(ev, ["de", "en"]).collect():
        assert sum(r["probabilities"]) == pytest.approx(1) and r["lang"] == "de"
    assert language_evidence.op6_language_evidence(spark, folder(documents=docs.limit(0), pages=pages)).count() == 0
    assert language_evidence.op6_language_evidence(spark, folder(documents=docs, pages=pages.limit(0))).count() == 0


def plain_fusion(rows, languages):
    """The fusion of one row at a time, by the letter of the module's text: rows of (id, evidence, declared, host, domain, suffix, named)."""
    import math

    n = len(languages)

    def soft(x):
        up = [math.exp(v - max(x)) for v in x]
        return [v / sum(up) for v in up]

    p = [soft(r[1]) for r in rows]
    add = lambda some: [sum(x) for x in zip(*some)] if some else [0.0] * n
    out = []
    for i, (key, evidence, declared, host, domain, suffix, named) in enumerate(rows):
        # the page's own vote is taken out of every count; what is left is never below zero
        others = lambda at, value: [max(x - y, 0) for x, y in zip(add([q for q, r in zip(p, rows) if value is None or r[at] == value]), p[i])]  # noqa: B023, E731
        total = others(0, None)
        prior = [1 / n] * n
        for counts in (total, others(5, suffix), others(4, domain), others(3, host)):
            prior = [(x + language_evidence.STRENGTH * y) / (sum(counts) + language_evidence.STRENGTH) for x, y in zip(counts, prior)]
        logs = [e + math.log(q) for e, q in zip(evidence, prior)]
        for at, value in ((2, declared), (6, named)):
            kinds = max(len({r[at] for r in rows}), 2)
            if value != "":
                logs = [z + math.log((x + language_evidence.BLEND) / (t + language_evidence.BLEND * kinds)) for z, x, t in zip(logs, others(at, value), total)]
        out.append((key, soft(logs)))
    return out


def test_fusion_against_plain_python(spark):
    rng = random.Random(9)
    languages = ["de", "en", "fr"]
    rows = [(i, [rng.uniform(-9, 0) for _ in languages], rng.choice(["", "de", "en", "xx"]), f"h{i % 7}", f"d{i % 3}", rng.choice(["de", "com"]), rng.choice(["", "fr", "de"])) for i in range(60)]
    table = spark.createDataFrame(rows, "page_id long, evidence array<double>, declared string, host string, domain string, suffix string, named string")
    got = {r["page_id"]: r for r in language_evidence.fuse(table, languages).collect()}
    for key, want in plain_fusion(rows, languages):
        assert got[key]["probabilities"] == pytest.approx(want, abs=1e-9)
        assert got[key]["lang"] == languages[int(np.argmax(want))] and got[key]["probability"] == pytest.approx(max(want))


def test_any_number_of_languages_by_plain_counts(spark, monkeypatch):
    docs = [(i, " ".join([f"l{i % 230}x{j}" for j in range(5)]), f"t{i % 230:03}") for i in range(460)] + [(None, "no id", "t000"), (9999, None, "t001"), (1, "no language", None)]
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(4)
    samples, languages = language_evidence.language_samples(table)
    assert languages == sorted({d[2] for d in docs if d[2]}) and samples.count() == 462
    made = language_evidence.fit_text(samples, languages)
    for k in (0, 1, 117):
        counts = np.full(language_evidence.SLOTS, 0.1)
        for _, text, lang in docs:
            if lang == languages[k]:
                counts += np.bincount(language_evidence.gram_slots(np.frombuffer((text or "").encode(), np.uint8)), minlength=language_evidence.SLOTS)
        assert np.allclose(made[:, k], np.log(counts / counts.sum()), atol=1e-5)
    few, _ = language_evidence.language_samples(table, 1)
    assert few.count() == 230


def test_visible_text_of_open_tags(spark):
    from pyspark.sql import functions as F

    rows = [("a<script>x</script>b<style>y",), ("a<!-- c --> b <!-- d",), ("1 < 2 and <b>bold</b> 3 > 2",), ("x<p class='",), ("<script " * 60_000,)]
    got = [r[0].strip() for r in spark.createDataFrame(rows, "h string").select(language_evidence.visible(F.col("h"))).collect()]
    assert got == ["a b", "a b", "1 < 2 and bold 3 > 2", "x", ""]


def test_addresses(spark):
    from pyspark.sql import functions as F

    rows = [("https://user@www.a.example.de:80/fr-ca/x",), ("http://example.com",), (None,), ("http://x.co.uk/en",)]
    got = [tuple(r) for r in spark.createDataFrame(rows, "u string").select(*(c.alias(k) for k, c in language_evidence.address(F.col("u")).items())).collect()]
    assert got == [("www.a.example.de", "example.de", "de", "fr"), ("example.com", "example.com", "com", ""), ("", "", "", ""), ("x.co.uk", "co.uk", "uk", "en")]


# archives


def page_rows():
    big = "<p>" + "same content é\r\n\r\nWARC/1.1\r\n" * 9
    return [(5, "http://a/5", big), (3, "http://a/ 3\r\nx", big), (9, None, big), (3, "http://a/3", big), (1, "u", "small"), (2, "u", "small"), (4, "u", None), (6, "u", ""), (None, "u", big), (7, "u", big + "!")]


def test_archives_resolve_revisits(spark, folder):
    import hashlib

    from pyspark.sql import functions as F

    rows = page_rows()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"digest": F.lit(1), "bytes": F.lit(2), "original": F.lit("x"), "value": F.lit(0)}).repartition(3)
    got = sorted((tuple(r) for r in warc.op9_warc_revisits(spark, folder(pages=pages)).collect()), key=str)
    want = []
    for k, _, html in rows:
        raw = (html or "").encode()
        same = [i for i, _, h in rows if (h or "").encode() == raw and i is not None]
        again = len(raw) >= 100 and k is not None and k != min(same)
        want.append((k, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", min(same) if again else None))
    assert got == sorted(want, key=str)
    assert warc.op9_warc_revisits(spark, folder(pages=pages.limit(0))).count() == 0


def test_archives_keep_payloads(spark, tmp_path):
    pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string")
    first, second = str(tmp_path / "one"), str(tmp_path / "two")
    warc.write_archives(pages, first, least=10**9, file_records=2)
    read = warc.read_archives(spark, first, payloads=True)
    assert read.filter("record_type = 'revisit'").count() == 0
    assert Counter(bytes(r["payload"]) for r in read.collect()) == Counter((r[2] or "").encode() for r in page_rows())
    warc.deduplicate_archives(spark, first, second)
    kinds = {(r["page_id"], r["record_type"]) for r in warc.read_archives(spark, second).collect()}
    assert (3, "response") in kinds and (5, "revisit") in kinds and (9, "revisit") in kinds


def test_archives_of_other_writers(spark, tmp_path):
    import gzip

    def record(kind, name, block, **more):
        fields = {"WARC-Type": kind, "WARC-Record-ID": name, "WARC-Date": "2020-01-01T00:00:00Z", **more, "Content-Length": len(block)}
        return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode() + b"\r\n" + block + b"\r\n\r\n"

    body = bytes(range(256)) * 3 + b"\r\n\r\nWARC/1.0\r\n"
    http = {"Content-Type": "application/http; msgtype=response"}
    records = [
        record("warcinfo", "<urn:uuid:1-2>", b"software: x\r\n\r\nmore", **{"Content-Type": "application/warc-fields"}),
        record("response", "<urn:page:7>", b"HTTP/1.1 200 OK\r\n\r\n" + body, **http),
        record("response", "<urn:uuid:3>", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n" + body, **http),
        record("response", "<urn:page:9>", b"HTTP/1.1 200 OK\r\n\r\n" + body, **http),
        record("revisit", "<urn:uuid:5>", b"", **{"WARC-Refers-To": "<urn:uuid:3>"}),
        record("resource", "<urn:uuid:6>", b"\xff" * 3_000_000, **{"Content-Type": "image/gif"}),
    ]
    digest = hashlib.sha256(body).hexdigest()
    for members in (b"".join(map(gzip.compress, records)), gzip.compress(b"".join(records))):
        got = list(warc.parse_archive(members))
        assert [r["record_type"] for r in got] == ["warcinfo", "response", "response", "response", "revisit", "resource"]
        assert [r["page_id"] for r in got] == [None, 7, None, 9, None, None] and got[2]["record_id"] == "<urn:uuid:3>"
        assert got[0]["payload"] == b"software: x\r\n\r\nmore" and got[1]["payload_digest"] == got[2]["payload_digest"] == digest
        assert got[4]["refers_to"] is None and got[4]["payload_digest"] is None and got[5]["payload_bytes"] == 3_000_000
        for cut in (40, len(members) // 2):
            with pytest.raises(ValueError):
                list(warc.parse_archive(members[:cut]))
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, records[:2] + records[3:4])))
    warc.deduplicate_archives(spark, str(source), target)
    rows = {r["page_id"]: r for r in warc.read_archives(spark, target, payloads=True).collect()}
    assert bytes(rows[7]["payload"]) == body and rows[9]["record_type"] == "revisit" and rows[9]["refers_to"] == 7


def test_very_long_pages_and_clashing_columns(spark, folder):
    long = "é<p>" * 400_000
    pages = spark.createDataFrame([(1, "u", long), (2, "u", long), (3, None, None)], "page_id long, url string, html string").selectExpr("*", "1 as digest", "2 as bytes", "3 as original", "4 as value")
    got = {r["page_id"]: r for r in warc.op9_warc_revisits(spark, folder(pages=pages)).collect()}
    assert got[1]["payload_bytes"] == len(long.encode()) and got[2]["refers_to"] == 1 and got[3]["payload_bytes"] == 0
    docs, _ = language_tables(spark)
    clash = pages.selectExpr("*", "'q' as p", "'r' as host", "'s' as evidence", "'t' as lang")
    assert language_evidence.op6_language_evidence(spark, folder(documents=docs.selectExpr("*", "1 as k", "2 as d", "3 as l"), pages=clash)).count() == 3


# the pipeline


def test_pipeline_stages_do_what_they_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        rows = out.collect()
        kept[name] = rows
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "quality classifier":
            model = quality_cnn.fit_on(docs, labels, quality_cnn.held_out())
            want = {r["doc_id"] for r in quality_cnn.with_score(docs, model).filter("score >= 0.3").collect()}
        elif name == "toxicity":
            model = toxicity.fit_on(docs, labels, toxicity.held_out())
            want = {r["doc_id"] for r in toxicity.with_score(docs, model).filter("score < 0.7").collect()}
        elif name == "n-gram jaccard join":
            want = {c for _, c, _ in brute_links([(r["doc_id"], r["text"]) for r in docs.collect()])}
        else:
            want = {r["doc_id"] for r in docs.collect()}
        assert {r["doc_id"] for r in rows} == want
        docs = spark.createDataFrame(rows, out.schema) if rows else out
    enc = tokenize_bpe.encoder(*tokenize_bpe.public_ranks())
    texts = {r["doc_id"]: r["text"] for r in kept["mixing sources"]}
    assert all(r["ids"] == enc.encode_ordinary(texts[r["doc_id"]]) and r["n_tokens"] == len(r["ids"]) for r in kept["byte-level bpe"])


def test_pipeline_of_awkward_rows(spark, docs, none, labels, folder):
    for table in (docs, none):
        path = folder(documents=table, labels=labels)
        now = spark.read.parquet(f"{path}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, now, path)
            assert name == "byte-level bpe" or out.columns == docs.columns[: len(out.columns)]
            assert out.count() <= now.count()
        assert corpus_pipeline.run(spark, path).count() <= table.count()


def foreign(kind, name, block, **fields):
    """A record of another writer."""
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", "WARC-Date: 2019-05-06T07:08:09Z", *(f"{k.replace('_', '-')}: {v}" for k, v in fields.items()), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@pytest.mark.parametrize("packed", [True, False])
def test_archives_of_other_writers_lose_no_record(spark, tmp_path, packed):
    import gzip

    page, other = b"\xff\xfe page " * 30, b"short"
    http = b"HTTP/1.1 404 Not Found\r\nX-Own: yes\r\n\r\n"
    kind = {"Content-Type": "application/http; msgtype=response"}
    info = foreign("warcinfo", "<urn:uuid:0>", b"software: another\r\n", **{"Content-Type": "application/warc-fields"})
    resource = foreign("resource", "<urn:uuid:r>", page, **{"Content-Type": "text/plain", "WARC-Target-URI": "file:x"})
    lost = foreign("revisit", "<urn:uuid:6>", http, **kind, **{"WARC-Payload-Digest": "sha1:ELSEWHERE"})
    records = [
        info, foreign("response", "<urn:uuid:2>", http + page, **kind, **{"WARC-Payload-Digest": "sha1:AAAA", "WARC-Target-URI": "http://b/"}), foreign("response", "<urn:uuid:1>", http + page, **kind, **{"WARC-Target-URI": "http://a/"}),
        resource, foreign("revisit", "<urn:uuid:4>", http, **kind, **{"WARC-Refers-To": "<urn:uuid:2>", "WARC-Profile": "x"}), foreign("revisit", "<urn:uuid:5>", http, **kind, **{"WARC-Payload-Digest": "sha1:AAAA"}), lost,
        foreign("response", "<urn:uuid:7>", http + other, **kind), foreign("revisit", "<urn:uuid:8>", http, **kind, **{"WARC-Refers-To": "<urn:uuid:7>"}), foreign("request", "<urn:uuid:9>", b"GET / HTTP/1.1\r\n\r\n", **{"Content-Type": "application/http; msgtype=request"}),
    ]
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for k in (0, 1):
        (source / f"{k}.warc").write_bytes(b"".join(gzip.compress(r) if packed else r for r in records[k::2]))
    assert warc.resolve(warc.read_archives(spark, str(source))).count() == len(records)
    warc.deduplicate_archives(spark, str(source), target)
    got = {r["record_id"]: r for r in warc.read_archives(spark, target, payloads=True).collect()}
    assert sorted(got) == [f"<urn:uuid:{k}>" for k in "012456789r"]
    # equal payloads are stored once, under the smallest id; short ones are not worth a revisit
    assert {k[10]: r["record_type"] for k, r in got.items()} == {"0": "warcinfo", "1": "response", "2": "revisit", "4": "revisit", "5": "revisit", "6": "revisit", "7": "response", "8": "response", "9": "request", "r": "resource"}
    assert bytes(got["<urn:uuid:1>"]["payload"]) == page and {got[f"<urn:uuid:{k}>"]["refers_id"] for k in "245"} == {"<urn:uuid:1>"}
    assert bytes(got["<urn:uuid:8>"]["payload"]) == other == bytes(got["<urn:uuid:7>"]["payload"])
    for k in "1245678":
        assert bytes(got[f"<urn:uuid:{k}>"]["http"]) == http[:-4] and got[f"<urn:uuid:{k}>"]["date"] == "2019-05-06T07:08:09Z"
    assert got["<urn:uuid:2>"]["url"] == "http://b/"
    # what takes no part is there byte for byte
    text = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "out").glob("*.gz"))
    assert all(r in text for r in (info, resource, lost)) and text.count(page) == 2
    # a second time changes nothing
    warc.deduplicate_archives(spark, target, str(tmp_path / "again"))
    again = {r["record_id"]: r for r in warc.read_archives(spark, str(tmp_path / "again"), payloads=True).collect()}
    assert {k: (r["record_type"], r["refers_id"], bytes(r["payload"])) for k, r in again.items()} == {k: (r["record_type"], r["refers_id"], bytes(r["payload"])) for k, r in got.items()}


def test_files_of_large_records_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "LARGE", 1_000)
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    pages = spark.createDataFrame([(i, None, f"{i:04d}" * (2_500 if i % 5 == 0 else 30)) for i in range(40)], "page_id long, url string, html string").coalesce(1)
    path = str(tmp_path / "w")
    warc.write_archives(pages, path)
    import gzip

    held = [len(gzip.decompress(p.read_bytes())) for p in (tmp_path / "w").glob("*.gz")]
    assert sum(n > 20_000 + 4_000 for n in held) <= 1 and len(held) >= 5
    assert {r["page_id"]: r["payload_bytes"] for r in warc.read_archives(spark, path).collect()} == {i: 10_000 if i % 5 == 0 else 120 for i in range(40)}
