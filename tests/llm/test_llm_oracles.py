"""The corpus queries against SQL, or against a brute-force version on the small tables."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from oracle import connect, differences

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
fold = lambda i, n: zlib.crc32(str(i).encode()) % n


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.fixture(scope="module")
def documents(con):
    return con.execute("select doc_id, text, lang from documents order by doc_id").fetchall()


def run(spark, name, sf=SF):
    return {r.doc_id: r for r in entry.queries()[name](spark, sf).collect()}


@pytest.mark.parametrize("name", ["op1_warc_archive", "op3_repeated_units", "op10_mix_sources"])
def test_equal_to_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, SF), entry.oracle_sql()[name], con) == []


def test_every_operator_is_registered():
    names = [re.match(r"op(\d+)_", n) for n in entry.queries()]
    assert {int(m[1]) for m in names if m} == set(range(1, 14)) and "pipeline" in entry.queries()


def test_token_counts_equal_the_library(spark, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = run(spark, "op4_token_counts")
    for i, text, _ in documents:
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len(text.encode()), n > 1024)


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def test_quality_counts(spark, documents):
    got = run(spark, "op6_quality_rules")
    for i, text, _ in documents:
        found = words(text)
        windows = Counter(tuple(found[k : k + 5]) for k in range(len(found) - 4))
        repeated = {k + j for k in range(len(found) - 4) if windows[tuple(found[k : k + 5])] > 1 for j in range(5)}
        lines, seen, double = text.split("\n"), set(), 0
        for line in lines:
            if words(line):
                double += line in seen
                seen.add(line)
        want = (len(found), sum(len(w.decode()) for w in found), sum(c in "#*$%&|<>" for c in text), double, len(repeated))
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and r.kept <= (not r.base_failed)


def test_language_is_right_on_held_out_texts(spark, documents):
    got = run(spark, "op7_language_id", "/root/testdata/sf0.01")
    import duckdb

    truth = duckdb.sql("select doc_id, lang from '/root/testdata/sf0.01/documents.parquet'").fetchall()
    held = [(got[i].lang_pred, lang) for i, lang in truth if fold(i, 4) == 2]
    assert all(got[i].held_out == (fold(i, 4) == 2) and 0 <= got[i].score <= 1 for i, _ in truth)
    assert sum(a == b for a, b in held) >= 0.97 * len(held)


def test_language_model(spark, documents):
    got = run(spark, "op8_language_model")
    counts, texts = Counter(), 0
    for i, text, _ in documents:
        if fold(i, 10):
            counts.update(words(text.encode().lower().decode()))
            texts += 1
    n, v = sum(counts.values()) + texts, len(counts) + 1
    base = model = tokens = 0
    for i, text, _ in documents:
        found = words(text.encode().lower().decode())
        logs = [math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in [*(counts[w] for w in found), texts]]
        r = got[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (fold(i, 10) == 0, len(found) + 1, n)
        assert r.n_known == sum(w in counts for w in found) + 1
        assert math.isclose(r.base_score, sum(logs), rel_tol=1e-9)
        if r.held_out:
            base, model, tokens = base + r.base_score, model + r.score, tokens + r.n_tokens
    assert model > base and model / tokens < 0


def components(sets, percent):
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {i: top(i) for i in ids}


def shingles(text):
    found = words(text.encode().lower().decode())
    return {tuple(found[k : k + 5]) for k in range(len(found) - 4)} if len(found) >= 5 else {tuple(found)} - {()}


def test_near_duplicates(spark, documents):
    got = run(spark, "op9_near_duplicates")
    sets = {i: shingles(text) for i, text, _ in documents}
    want = components(sets, 85)
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (len(sets[i]), c, c == i) for i, c in want.items()
    }


def test_toxicity_on_held_out_texts(spark):
    import duckdb

    got = run(spark, "op2_toxicity", "/root/testdata/sf0.01")
    truth = duckdb.sql("select doc_id, max(toxic) from '/root/testdata/sf0.01/labels.parquet' group by 1").fetchall()
    held = [(got[i].predicted, y) for i, y in truth if fold(i, 5) == 0]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) >= 0.9
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got.values())


def test_contaminated_documents(spark, con):
    got = {(r.doc_id, r.item_id) for r in entry.queries()["op5_benchmark_contamination"](spark, SF).collect()}
    exact = set(con.execute("select doc_id, item_id from documents d, benchmark b where contains(d.text, b.text)").fetchall())
    assert exact and exact <= got and len(got - exact) <= 1


def test_pipeline_equals_its_stages_by_brute_force(spark, con, documents):
    """Stages recomputed in plain Python from the rows the stage before kept."""
    import corpus_pipeline
    from fallowlens.llm import repeats

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    outs = []
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema if len(outs) < 4 else None)
        outs.append({r.doc_id: r for r in docs.collect()})
    assert [n for n, _ in corpus_pipeline.STAGES] and len(outs) == 5
    judged = run(spark, "op6_quality_rules")
    assert set(outs[0]) == {i for i, r in judged.items() if r.kept}
    near = components({i: shingles(r.text) for i, r in outs[0].items()}, 80)
    assert set(outs[1]) == {i for i, c in near.items() if i == c}
    seen: set[bytes] = set()
    for i in sorted(outs[1]):
        own = list(repeats.units(outs[1][i].text))
        flags = [unit in seen or unit in {u[0] for u in own[:k]} for k, (unit, *_) in enumerate(own)]
        gone, k = [], 0
        while k < len(own):
            end = k
            while end < len(own) and flags[end]:
                end += 1
            if end > k and sum(u[3] for u in own[k:end]) >= 20:
                gone += own[k:end]
            k = max(end, k + 1)
        seen |= {u[0] for u in own}
        text = outs[1][i].text
        for _, start, stop, _ in reversed(gone):
            text = text[:start] + text[stop:]
        assert outs[2][i].text == text and outs[2][i].n_chars == (len(text) if gone else outs[1][i].n_chars)
    items = [t for (t,) in con.execute("select text from benchmark").fetchall()]
    norm = lambda t: f" {' '.join(re.findall(r'\w+', t.lower()))} "
    assert set(outs[3]) == {i for i, r in outs[2].items() if not any(norm(t) in norm(r.text) for t in items)}
    assert set(outs[4]) <= set(outs[3])
    final = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in final.collect()} == set(outs[4])
