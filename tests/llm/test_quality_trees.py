"""Quality trees: statistics and traversal against plain Python, held-out accuracy, odd rows."""

import zlib
from collections import Counter

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from fallowlens.llm import quality_trees as qt


def plainly(text: bytes, block=32):
    """Some of the sums and tops of one section, counted word by word."""
    words = text.split()
    keys = set("ABCDEFGHIJKLMNOPQRSTUVWXYZ".encode())
    caps = [sum(c in keys for c in w) >= 2 and not any(97 <= c < 123 for c in w) for w in words]
    again = [k > 0 and words[k - 1] == w for k, w in enumerate(words)]
    lines = [tuple(x.split()) for x in text.split(b"\n") if x.split()]
    most = lambda f: max([sum(f[k : k + block]) / max(block // 2, len(f[k : k + block])) for k in range(0, len(f), block)], default=0)
    return {
        "words": len(words), "caps": sum(caps), "again": sum(again), "distinct": len(set(words)),
        "pairs": max(0, len(words) - 1), "distinct_pairs": len(set(zip(words, words[1:]))), "lines": len(lines),
        "distinct_lines": len(set(lines)), "ended": sum(x[-1][-1:] in b".!?" for x in lines), "break": text.count(b"\n"),
        "squares": sum(len(w) ** 2 for w in words), "most_caps": most(caps), "most_again": most(again),
        "longest_word": max(map(len, words), default=0), "longest_line": max(map(len, lines), default=0),
    }


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("aAB .!|é\n\t", max_size=120), min_size=1, max_size=5))
def test_counts_equal_plain_ones(texts):
    raw = [t.encode() for t in texts]
    sums, tops = qt.counts(raw, 4)
    for text, row in zip(raw, np.concatenate([sums, tops], 1)):
        got = dict(zip((*qt.SUMS, *qt.TOPS), row))
        want = plainly(text, 4)
        assert {k: got[k] for k in want} == want
        assert sum(got[c] for c in qt.CLASSES) == len(text)


@given(st.text("ab \n", max_size=300))
def test_sections_are_the_whole_text(text):
    parts = qt.sections(text.encode(), 20)
    assert b"".join(parts) == text.encode() and all(len(x) <= 20 for x in parts)
    split = [w for x in parts for w in x.split()]
    assert max(map(len, text.split()), default=0) > 18 or split == text.encode().split()


def test_long_texts_measure_like_short_ones():
    text = b"Some words of a line.\nAnother line, with MORE words!\n" * 30_000
    one, many = qt.statistics([text], qt.Params(section_bytes=1 << 30))[0], qt.statistics([text, text[:40_000]], qt.Params())
    at = [qt.NAMES.index(n) for n in ("share_upper", "words_caps", "word_mean", "lines_ended", "most_caps")]
    assert np.allclose(one[at], many[0][at], atol=2e-3) and np.allclose(many[0][at], many[1][at], atol=2e-3)


def test_traversal_equals_walking_each_tree():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] * x[:, 2] > 0)).astype(int)
    p = qt.Params()
    trees = qt.fit(x, y, p)
    margins = trees.margins(x)
    for k in range(0, 3000, 50):
        total = trees.base
        for feature, limit, value in zip(trees.feature, trees.limit, trees.value):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + bool(x[k, feature[node]] > limit[node])
            total += value[node - len(feature)]
        assert np.isclose(total, margins[k])
    assert ((trees.scores(x) >= 0.5) == y).mean() > 0.97


def test_first_division_is_the_best_one():
    """The root of the first tree against every limit of every statistic."""
    rng = np.random.default_rng(1)
    x = rng.integers(0, 12, (400, 4)).astype(np.float32)
    y = (x[:, 2] + rng.integers(0, 3, 400) > 6).astype(int)
    p = qt.Params(trees=1, depth=1)
    trees = qt.fit(x, y, p)
    g, h = y.mean() - y, np.full(400, y.mean() * (1 - y.mean()))
    side = lambda m: g[m].sum() ** 2 / (h[m].sum() + p.penalty)
    best = max(((side(x[:, f] > c) + side(x[:, f] <= c), -f, -c) for f in range(4) for c in np.arange(11) + 0.5))
    assert (trees.feature[0, 0], trees.limit[0, 0]) == (-best[1], -best[2])


def test_quality_on_held_out_texts(spark):
    sf = "/root/testdata/sf0.1"
    rows = entry.queries()["op11_quality_classifier"](spark, sf).collect()
    assert len(rows) == duckdb.sql(f"select count(*) from '{sf}/documents.parquet'").fetchall()[0][0]
    got = {r.doc_id: r for r in rows}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    truth = duckdb.sql(f"select doc_id, min(quality) from '{sf}/labels.parquet' group by 1").fetchall()
    seen = Counter((y, got[i].predicted) for i, y in truth if got[i].held_out)
    assert seen[1, 1] >= 0.98 * (seen[1, 1] + seen[1, 0]) and seen[0, 0] >= 0.9 * (seen[0, 0] + seen[0, 1])


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "good words here.", 1), (1, "good words here.", 2), (2, None, 3), (3, "", 4), (None, "no id!", 5), (4, "x" * 300_000, 6),
         (5, "BAD!! BAD!!", 7), (6, "퟿\U0010ffff \0", 8)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1, "a"), (5, 0, "a"), (5, 1, "a"), (3, None, "a"), (None, 0, "a")], "doc_id long, quality int, text string")
    got = qt.quality_scores(docs, labels, held_out=7).collect()
    assert len(got) == 8 and len({r.score for r in got if r.doc_id == 1}) == 1
    assert len({r.score for r in got if r.doc_id in (2, 3)}) == 1 and all(0 <= r.score <= 1 for r in got)
    only = qt.quality_scores(docs, labels.where("doc_id = 1"), held_out=7).collect()
    assert {r.predicted for r in only} == {1}
    assert {r.score for r in qt.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert qt.quality_scores(docs.limit(0), labels).count() == 0
