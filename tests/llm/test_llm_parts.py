"""Parts of the corpus operators: exact bounds, gradients, blocks, round trips, planted cases."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fallowlens.llm import decontaminate, language_id, language_model, mixing, near_dedup, quality, repeats, toxicity, warc
from fallowlens.llm.graph import components


def test_binomial_tail_is_exact():
    for n, k, p in ((10, 0, 0.1), (50, 3, 0.02), (200, 7, 0.05)):
        want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert math.isclose(quality.at_most(k, n, p), want, rel_tol=1e-9)


def test_cutoffs_need_evidence_and_stop_at_the_first_failure():
    clean = [1000] + [0] * 63
    assert quality.choose_cutoff(clean, 1000, 0.01, 0.01) == 1
    assert quality.choose_cutoff([20] + [0] * 63, 20, 0.01, 0.01) is None
    assert quality.choose_cutoff([1000, 500, *[0] * 62], 1000, 0.01, 0.01) == 2
    assert quality.choose_cutoff([1000, 0, 500, *[0] * 61], 1000, 0.01, 0.01) == 3


def test_rejections_of_good_documents_stay_bounded(spark):
    rng = random.Random(1)
    noisy = lambda bad: " ".join(f"w{rng.randrange(10**6)}" + ("###" if bad else "") for _ in range(40))
    data = [(i, noisy(i % 5 == 0), "en" if i % 3 else "rare", int(i % 5 != 0)) for i in range(3000)]
    data += [(10**6 + i, noisy(True), "tiny", 0) for i in range(20)]
    docs = spark.createDataFrame([d[:3] for d in data], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(d[0], d[3]) for d in data], "doc_id long, quality int")
    out = {r.doc_id: r.kept for r in quality.quality_rules(docs, labels, params=quality.Params(risk=0.05)).collect()}
    assert all(out[i] for i, _, _, good in data if good) and not any(out[i] for i, _, s, good in data if not good and s == "en")
    assert all(out[10**6 + i] for i in range(20))


def test_toxicity_gradients():
    p = toxicity.Params(window=5, word_buckets=50, gram_buckets=60, dim=3, hidden=3, attention=2)
    net = toxicity.Network(p)
    net.weights = {k: (v * 3).astype(np.float64) for k, v in net.weights.items()}
    f = toxicity.Features(["one", "two", "three", "four"], p)
    ids, lengths = np.array([[0, 1, 2, 3, 1], [2, 0, 0, 0, 0]]), np.array([5, 2])
    y, weight = np.array([1.0, 0.0]), np.array([2.0, 1.0])

    def loss():
        x = net.forward(net.gates(f), ids, lengths).astype(np.float64)
        return float((weight * (np.logaddexp(0, x) - y * x)).sum() / weight.sum())

    g = net.gradients(f, ids, lengths, y, weight)
    rng = np.random.default_rng(0)
    for name, value in net.weights.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in value.shape)
            if name in ("word", "gram"):
                at = (int(getattr(f, name)[0]), at[1])
            old = value[at]
            value[at] = old + 1e-3
            high = loss()
            value[at] = old - 1e-3
            low = loss()
            value[at] = old
            assert abs((high - low) / 2e-3 - g[name][at]) < 2e-3, name


def test_windows_cover_every_word():
    p = toxicity.Params()
    for n in (1, 15, 32, 33, 48, 49, 1000):
        starts = toxicity.window_starts(n, p)
        assert {k for s in starts for k in range(s, min(n, s + p.window))} == set(range(n))


def test_signature_estimates_similarity():
    p = near_dedup.Params()
    maker = near_dedup.Signatures(p)
    rng = np.random.default_rng(0)
    for share in (0.2, 0.5, 0.8):
        a = rng.integers(0, 2**63, 2000, np.uint64)
        b = a.copy()
        b[: int(2000 * (1 - share) / (1 + share))] = rng.integers(0, 2**63, int(2000 * (1 - share) / (1 + share)), np.uint64)
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        m = near_dedup.matches(maker.packed(maker.minima(a)), maker.packed(maker.minima(b)), p)
        assert abs(near_dedup.similarity(m, p) - true) < 0.15


def edited(words, n, rng):
    out = list(words)
    for k in rng.sample(range(len(out)), n):
        out[k] = f"e{rng.randrange(10**9)}"
    return " ".join(out)


def test_large_groups_in_blocks_lose_no_link(spark):
    from test_llm_oracles import components as brute
    from test_llm_oracles import shingles

    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    texts = [edited(base, rng.randrange(0, 5), rng) for _ in range(160)] + [" ".join(base)] * 40
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    params = near_dedup.Params(percent=85, bucket_block=16, group_block=20)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, params=params).collect()}
    assert got == brute({i: shingles(t) for i, t in enumerate(texts)}, 85)


def test_rows_that_share_an_id_have_the_links_of_all_their_texts(spark):
    rng = random.Random(8)
    a, b, c, d, e = ([f"w{rng.randrange(10**6)}" for _ in range(150)] for _ in range(5))
    docs = [(3, a), (9, a), (9, b), (12, b)]  # equal texts
    docs += [(21, edited(c, 2, rng).split()), (22, edited(d, 2, rng).split()), (25, c), (25, d), (25, e), (27, edited(e, 2, rng).split())]
    docs += [(30, edited(e, 2, rng).split()), (40, [f"v{k}" for k in range(60)]), (40, [f"u{k}" for k in range(60)])]
    taken = spark.createDataFrame([(i, " ".join(t)) for i, t in docs], "doc_id long, text string")
    got = near_dedup.near_duplicates(taken, params=near_dedup.Params(percent=80)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == sorted((i, 3 if i < 20 else 21 if i < 40 else 40) for i, _ in docs)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(500, 400)]
    got = {r.id: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {k: 100 for k in range(100, 130)} | {500: 400, 400: 400}


def test_least_connected():
    a = np.eye(5, dtype=bool)
    a[4, 1] = a[1, 4] = a[3, 4] = a[4, 3] = True
    assert near_dedup.least_connected(a).tolist() == [0, 1, 2, 1, 1]


def test_repeated_passage_inside_a_line_is_cut_once(spark):
    rng = random.Random(2)
    sentence = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(12)).capitalize() + "."
    passage = " ".join(sentence() for _ in range(6))
    docs = [(3, f"{sentence()} {passage} {sentence()}", 0), (7, f"{sentence()}\n{passage} {sentence()}", 0), (9, sentence(), 5)]
    out = {r.doc_id: r for r in repeats.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string, n_chars int")).collect()}
    assert out[3].text == docs[0][1] and out[9] == docs[2]
    assert passage not in out[7].text and out[7].n_chars == len(out[7].text) < 200


def test_paraphrases_are_found_and_unrelated_texts_left(spark):
    rng = random.Random(3)
    text = lambda n: [f"w{rng.randrange(30 if rng.random() < 0.45 else 3000)}" for _ in range(n)]
    items = [text(40) for _ in range(30)]
    docs = []
    for i, item in enumerate(items):
        changed = [w if rng.random() > 0.25 or k >= 32 else f"x{rng.randrange(10**6)}" for k, w in enumerate(item)]
        docs.append((i, " ".join(text(100) + changed + text(100))))
    docs += [(1000 + i, " ".join(text(250))) for i in range(200)]
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert {r.doc_id for r in got if r.doc_id >= 1000} == set()
    assert sum(r.doc_id == r.item_id for r in got) >= 27


def test_excerpts_across_piece_borders_are_found(spark):
    rng = random.Random(6)
    text = lambda n: [f"w{rng.randrange(10**5)}" for _ in range(n)]
    long, short, tiny = text(144), text(40), text(10)
    changed = [w if k % 8 else f"x{k}" for k, w in enumerate(long[30:90])]
    parts = [long[16:80], long[40:104], long[70:83], short[:28], short[3:17], changed, long[70:82], short[:12]]
    docs = [(i, " ".join(text(60) + part + text(60))) for i, part in enumerate(parts)]
    docs += [(8, " ".join(w for k in range(0, 144, 12) for w in [*long[k : k + 12], f"y{k}a", f"y{k}b"][:6]))]
    docs += [(9, " ".join(short[:7])), (10, " ".join(short[7:14]))]
    taken = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(short)), (3, " ".join(tiny))], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(taken, bench).collect()}
    assert set(got) == {(0, 1), (1, 1), (2, 1), (3, 2), (4, 2), (5, 1)}
    for i in (2, 3, 4):
        r = next(r for (d, _), r in got.items() if d == i)
        assert docs[i][1][r.span_start : r.span_end] == " ".join(parts[i])
    assert {r.doc_id for r in decontaminate.keep_clean(taken, bench).collect()} == {6, 7, 8, 9, 10}
    only_tiny = decontaminate.contaminated(taken, bench.where("item_id = 3"))
    assert only_tiny.isEmpty()


def test_common_subsequence():
    rng = random.Random(5)
    for _ in range(200):
        a, b = [rng.choice("abcd") for _ in range(rng.randrange(0, 12))], [rng.choice("abcde") for _ in range(15)]
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert decontaminate.common_subsequence(tuple(a), b) == t[-1][-1]


def test_bloom_filters_return_all_languages():
    rng = np.random.default_rng(1)
    members = [rng.integers(0, 2**63, 3000, np.uint64) for _ in range(70)]
    members[69] = members[3]
    filters = language_id.Filters.build([f"l{i:02}" for i in range(70)], members, language_id.Params())
    masks = filters.languages(members[3])
    assert (masks[:, 0] >> np.uint64(3) & np.uint64(1)).all() and (masks[:, 1] >> np.uint64(5) & np.uint64(1)).all()
    wrong = (masks[:, 0] >> np.uint64(7) & np.uint64(1)).mean()
    assert wrong < 0.01


def test_log_bilinear_model_is_normalised_and_learns():
    p = language_model.Params(classes=12, rest=3, dim=6, steps=800, batch=256, noise=16)
    rng = np.random.default_rng(0)
    codes = np.array([(a * 12 + b) * 12 + (b + 1) % 10 for a in range(10) for b in range(10)])
    frequency = np.bincount(codes % 12, minlength=12) + 1e-3
    frequency = frequency / frequency.sum()
    model = language_model.LogBilinear(p, frequency)
    model.train(codes, np.ones(len(codes)), frequency, p)
    table = model.log10_table(p).reshape(-1, 12)
    assert np.allclose((10.0**table).sum(1), 1, atol=1e-4) and table.reshape(-1)[codes].mean() > -0.5
    assert rng is not None


def test_poisson_copies_have_the_target_mean(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.lit("some text").alias("text"), F.when(F.col("id") < 5000, "big").otherwise("small").alias("source")
    )
    mixed = mixing.mix_sources(docs, weights={"big": 1.0, "small": 3.0})
    counts = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(counts["big"] - 1500) < 5 * 1500**0.5 and abs(counts["small"] - 4500) < 5 * 4500**0.5
    assert mixed.groupBy("doc_id").count().where("count > 40").isEmpty()
    assert sorted(mixed.collect()) == sorted(mixing.mix_sources(docs.repartition(3), weights={"big": 1.0, "small": 3.0}).collect())


def test_poisson_copies_at_large_rates(spark):
    n, rates = 300, {"a": 100, "b": 1000, "c": 5000}
    source = F.element_at(F.array(*map(F.lit, rates)), (F.col("id") % 3 + 1).cast("int"))
    docs = spark.range(3 * n).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"), source.alias("source"))
    counts = mixing.mix_sources(docs, weights=rates, total=sum(rates.values()) / 3).groupBy("source", "doc_id").count()
    found = counts.groupBy("source").agg(
        F.count("count").alias("n"), F.avg("count").alias("mean"), F.variance("count").alias("var")
    ).collect()
    assert len(found) == 3
    for r in found:
        rate = rates[r.source]
        assert r.n == n and abs(r["mean"] - rate) < 5 * (rate / n) ** 0.5 and abs(r["var"] / rate - 1) < 5 * (2 / n) ** 0.5
    wide = spark.createDataFrame([("a", 0.25), ("b", 80.0), ("c", 745.0), (None, 5000.0), ("e", 1e6), ("none", 0.0)], "source string, rate double")
    tables = {r.source: r for r in mixing.with_cumulative(wide).collect()}
    assert set(tables) == {"a", "b", "c", None, "e"}
    for r in tables.values():
        p = [math.exp(k * math.log(r.rate) - r.rate - math.lgamma(k + 1)) for k in range(r["first"], r["first"] + len(r.cdf))]
        assert np.allclose(np.cumsum(p), r.cdf, rtol=0, atol=1e-8) and r.cdf[-1] == 1.0


def test_archive_round_trip_and_damage(spark, tmp_path):
    import base64
    import hashlib

    pages = [(1, "http://a", "<p>ä</p>"), (2, "http://b", "<p>ä</p>"), (3, None, None), (4, "http://c", ""), (5, "http://d", "x" * 100_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    archive = warc.write(df, folder=str(tmp_path / "a"))
    assert spark.read.parquet(archive.payloads).count() == 3
    found = {r.header.decode().split("<urn:page:")[1].split(":")[0]: r for r in warc.read(spark, archive).collect()}
    for i, _, html in pages:
        payload = (html or "").encode()
        r = found[str(i)]
        assert r.payload == payload and r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        body = payload if b"WARC-Type: response" in r.header else b""
        assert r.record == r.header + body + b"\r\n\r\n" and f"Content-Length: {len(body)}\r\n".encode() in r.header
    types = {r.page_id: (r.record_type, r.refers_to) for r in warc.page_records(df, min_revisit_bytes=1).collect()}
    assert types == {1: ("revisit", 2), 2: ("response", None), 3: ("response", None), 4: ("response", None), 5: ("response", None)}
    bad = spark.read.parquet(archive.payloads).withColumn("payload", F.concat("payload", F.lit(b"!")))
    bad.write.parquet(str(tmp_path / "bad"))
    with pytest.raises(Exception, match="does not match"):
        warc.read(spark, warc.Archive(str(tmp_path / "bad"), archive.headers)).collect()
