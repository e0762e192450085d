"""Groups over several blocks: chains, whose ends share nothing, against all pairs."""

import random

import pytest

from fallowlens.llm import near_dedup


def sets(text):
    found = text.lower().split()
    return {tuple(found[k : k + 5]) for k in range(max(1, len(found) - 4))}


def brute(docs, percent):
    label = {i: i for i, _ in docs}
    own = {i: sets(t) for i, t in docs}
    while True:
        before = dict(label)
        for a, _ in docs:
            for b, _ in docs:
                if label[b] < label[a] and 100 * len(own[a] & own[b]) >= percent * len(own[a] | own[b]):
                    label[a] = label[b]
        if label == before:
            return label


@pytest.mark.parametrize("block", [3, 8])
def test_chains_and_stars_over_blocks(spark, block):
    rng = random.Random(block)
    word = lambda: f"w{rng.randrange(10**6)}"
    docs, i = [], 0
    for _ in range(2):
        words = [word() for _ in range(120)]
        for step in range(14):  # each text drops a few words of the one before: ends of the chain are unlike
            docs.append((rng.randrange(10**6) * 100 + i, " ".join(words)))
            words, i = words[3:] + [word() for _ in range(3)], i + 1
    star = [word() for _ in range(100)]
    for k in range(20):
        changed = list(star)
        changed[4 * k] = word()
        docs.append((rng.randrange(10**6) * 100 + i, " ".join(changed)))
        i += 1
    docs += [(rng.randrange(10**6) * 100 + i + k, " ".join(word() for _ in range(40))) for k in range(5)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    params = near_dedup.Params(percent=80, group_block=block, bucket_block=block)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(frame, params=params).collect()}
    want = brute(docs, 80)
    assert got == want and len(set(want.values())) < len(docs) - 30


def test_a_large_group_of_copies_moves_its_texts_twice_at_most(spark, monkeypatch):
    rng = random.Random(5)
    star = [f"w{k}" for k in range(100)]
    docs = []
    for k in range(60):
        changed = list(star)
        changed[rng.randrange(100)] = f"x{k}"
        docs.append((k, " ".join(changed)))
    moved = []
    real = near_dedup.confirmed_edges
    monkeypatch.setattr(near_dedup, "confirmed_edges", lambda grouped, p: moved.append(grouped.count()) or real(grouped, p))
    params = near_dedup.Params(percent=80, group_block=4)
    found = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), params=params).collect()
    assert {r.component_id for r in found} == {0} and moved[0] == 60 and sum(moved) < 2.5 * 60


def test_large_groups_read_the_documents_no_more_often_than_small_ones(spark):
    """Once for the signatures, once for the texts of members, whatever the groups' sizes."""
    def read(block):
        rng, star = random.Random(9), [f"w{k}" for k in range(100)]
        docs = [(k, " ".join(star[:k] + [f"x{k}"] + star[k + 1 :])) for k in range(40)]
        docs += [(1000 + k, " ".join(f"y{rng.randrange(10**6)}" for _ in range(40))) for k in range(50)]
        seen = spark.sparkContext.accumulator(0)

        def counted(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        frame = spark.createDataFrame(docs, "doc_id long, text string").mapInArrow(counted, "doc_id long, text string")
        params = near_dedup.Params(percent=80, group_block=block)
        found = near_dedup.near_duplicates(frame, params=params).collect()
        assert len({r.component_id for r in found}) == 51
        return seen.value

    assert read(4) == read(512) == 2 * 90
