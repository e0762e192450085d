"""Fill-in-the-middle: cuts against plain Python, round trips, odd rows."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import connect, differences

import __spark_entry__ as entry
from fallowlens.llm import fill_in_middle as fim

TEXTS = ["", "a", "abcdefgh", "é" * 9, "日本語テキスト", "👍🏽 x", "a\0b", "ß" * 8 + "a", "x" * 16, "é" * 5, "ჿ\U0010ffff"]


def plainly(doc_id, text):
    """The contract in plain Python over code points."""
    h = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h = [int(h[k : k + 8], 16) for k in range(0, 32, 8)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", text, None, None
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", a, b - a
    return n, "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", a, b - a


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), max_size=8), st.randoms())
def test_offsets_of_any_texts(texts, random):
    units = fim.Units([t.encode() for t in texts])
    assert units.count.tolist() == [len(t) for t in texts]
    k = np.array([random.randint(0, len(t)) for t in texts], np.int64)
    assert units.offsets(k).tolist() == [len(t[:x].encode()) for t, x in zip(texts, k)]


@pytest.mark.parametrize("text", TEXTS)
def test_every_cut_of_a_text(text):
    units = fim.Units([text.encode()] * (len(text) + 1))
    assert units.offsets(np.arange(len(text) + 1)).tolist() == [len(text[:k].encode()) for k in range(len(text) + 1)]


@given(st.text("<>PSMa", max_size=12), st.text("<>PSMa", max_size=12), st.text("<>PSMa", max_size=12))
def test_restored_from_parts_with_halves_of_markers(a, b, c):
    text = (a + b + c).encode()
    for form in (fim.PSM, fim.SPM):
        if not any(m in text for m in (b"<P>", b"<S>", b"<M>")):
            assert fim.restore(form, fim.assemble(form, a.encode(), b.encode(), c.encode())) == text


def test_documents_against_plain_python(spark):
    rows = [(i, t, "n") for i, t in enumerate(TEXTS * 20)]
    rows += [(None, "no id", "n"), (None, None, "n"), (7, None, "n"), (3, "has <S> inside", "n"), (3, "has <S> inside", "n"), (9, "é" * 400_000, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string")
    got = fim.fill_in_middle(docs).collect()
    want = [(i, *plainly("" if i is None else i, t or "")) for i, t, _ in rows]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    hashed = fim.digests(docs).collect()
    assert sorted((str(r.doc_id), r.output_sha256) for r in hashed) == sorted((str(r[0]), sha(r[3])) for r in want)
    assert sorted((str(r.doc_id), r.restored_sha256) for r in hashed) == sorted((str(i), sha(t or "")) for i, t, _ in rows)


def test_empty_table_and_small_batches(spark):
    docs = spark.createDataFrame([(i, "ä" * i) for i in range(50)], "doc_id long, text string")
    assert fim.fill_in_middle(docs.limit(0)).count() == 0
    small = fim.fill_in_middle(docs, params=fim.Params(batch_bytes=1)).collect()
    assert sorted(small) == sorted(fim.fill_in_middle(docs).collect())
    for r in small:
        assert fim.restore(r.form, r.output.encode()).decode() == "ä" * r.doc_id


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert differences(entry.queries()["op12_fill_in_middle"](spark, sf), entry.oracle_sql()["op12_fill_in_middle"], connect(sf)) == []
