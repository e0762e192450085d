"""Near-duplicate documents by b-bit MinHash, confirmed on full shingle sets.

1. Documents with equal word sequences form a class; its smallest doc_id stands for it.
2. A signature keeps the lowest bits of every minimum, packed; groups of minima form band
   keys, and classes that share a key are candidates of each other.
3. Within a bucket the packed signatures are compared by bit counts. The estimate is
   corrected for equal bits by chance, and pairs that cannot reach the threshold leave.
   A bucket puts out one edge per class, not its pairs: only connection matters.
4. The components of those edges are groups of probable copies. Each group's texts meet
   once, full shingle sets are compared, and confirmed links put out one edge per class.
5. The components of the confirmed links are the result.

Buckets beyond a size are cut into blocks, and every pair of blocks is compared by a task of
its own. A group beyond a size is cut too, but its texts meet block by block first; then
one text stands for all that a block linked. Only where these leave a group in several
pieces are all its pairs of blocks compared, so a large group of copies moves its texts once
and no link is lost. No task holds more than two blocks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fallowlens.llm.common import lowered_words, mix64, rows, stored
from fallowlens.llm.graph import components

SHINGLE = 5
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


@dataclass(frozen=True)
class Params:
    """``percent``: the smallest similarity that links. ``band_rows`` minima make a band key;
    with the default lanes a pair at 80 % shares none of the 38 keys with a chance of
    3e-7. ``slack``: standard deviations below the threshold at which an estimate still
    counts as a candidate."""

    percent: int = 80
    lanes: int = 192
    bits: int = 2
    band_rows: int = 5
    slack: float = 6.0
    bucket_block: int = 1024
    group_block: int = 512
    block_shingles: int = 400_000
    seed: int = 7

    @property
    def bands(self) -> int:
        return self.lanes // self.band_rows

    @property
    def packed(self) -> int:
        return self.lanes * self.bits // 64

    @property
    def least_similarity(self) -> float:
        """The estimate that a candidate needs: the threshold less the slack."""
        chance = 2.0**-self.bits
        match = chance + (1 - chance) * self.percent / 100
        lanes = math.floor(self.lanes * match - self.slack * math.sqrt(self.lanes * match * (1 - match)))
        return (lanes / self.lanes - chance) / (1 - chance) - 1e-9


def similarity(matches: np.ndarray, params: Params) -> np.ndarray:
    """Estimated Jaccard similarity from equal lanes, corrected for equality by chance."""
    chance = 2.0**-params.bits
    return np.maximum(0, (matches / params.lanes - chance) / (1 - chance))


def shingles(found: list[bytes]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles; fewer words are one shingle."""
    if not found:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    n = min(SHINGLE, len(codes))
    total = np.full(len(codes) - n + 1, n, np.uint64)
    for k in range(n):
        total = total * _ODD[0] + codes[k : len(codes) - n + 1 + k] * _ODD[k]
    return np.unique(mix64(total))


class Signatures:
    """Minima of a set under random multiplications, their low bits and band keys."""

    def __init__(self, params: Params):
        rng = np.random.default_rng(params.seed)
        self.params = params
        self.factors = rng.integers(1, 2**63, params.lanes, np.uint64) * np.uint64(2) + np.uint64(1)

    def minima(self, codes: np.ndarray) -> np.ndarray:
        parts = [
            np.multiply.outer(codes[k : k + 512], self.factors).min(axis=0) for k in range(0, len(codes), 512)
        ]
        return np.minimum.reduce(parts) >> np.uint64(32)

    def packed(self, minima: np.ndarray) -> np.ndarray:
        p = self.params
        low = (minima & np.uint64((1 << p.bits) - 1)).reshape(p.packed, -1)
        return np.bitwise_or.reduce(low << (np.arange(low.shape[1], dtype=np.uint64) * np.uint64(p.bits)), axis=1)

    def band_keys(self, minima: np.ndarray) -> np.ndarray:
        p = self.params
        groups = minima[: p.bands * p.band_rows].reshape(p.bands, p.band_rows)
        keys = np.arange(1, p.bands + 1, dtype=np.uint64)
        for k in range(p.band_rows):
            keys = mix64(keys * _ODD[0] + groups[:, k])
        return keys


def matches(a: np.ndarray, b: np.ndarray, params: Params) -> np.ndarray:
    """Equal lanes of packed signatures, along the last axis."""
    diff = a ^ b
    for k in range(1, params.bits):
        diff = diff | ((a ^ b) >> np.uint64(k))
    ones = np.uint64(sum(1 << s for s in range(0, 64, params.bits)))
    return params.lanes - np.bitwise_count(diff & ones).sum(axis=-1, dtype=np.int64)


def signatures(docs: DataFrame, doc_id: str, text: str, params: Params) -> DataFrame:
    """(id, digest, n_shingles, sig, bands) per row; without words the last two and the digest are null."""
    schema = pa.schema([
        ("id", pa.int64()), ("digest", pa.binary()), ("n_shingles", pa.int64()),
        ("sig", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Signatures(params)
        for batch in batches:
            digests, sizes, sigs, bands = [], [], [], []
            for value in batch.column("text"):
                found = lowered_words(value.as_py())
                codes = shingles(found)
                sizes.append(len(codes))
                if not len(codes):
                    digests.append(None), sigs.append(None), bands.append(None)
                    continue
                minima = maker.minima(codes)
                digests.append(hashlib.blake2b(b" ".join(found), digest_size=16).digest())
                sigs.append(maker.packed(minima).view(np.int64))
                bands.append(maker.band_keys(minima).view(np.int64))
            yield rows(schema, id=batch.column("id"), digest=digests, n_shingles=sizes, sig=sigs, bands=bands)

    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(
        run, "id long, digest binary, n_shingles long, sig array<long>, bands array<long>"
    )


def blocked(df: DataFrame, key: str, blocks: Column) -> DataFrame:
    """Rows with the pairs of blocks (i, j) they take part in, dealt and sorted by (key, i, j)."""
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    pair = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.struct(F.least(F.col("own"), j).alias("i"), F.greatest(F.col("own"), j).alias("j")),
    )
    return (
        df.withColumn("blocks", blocks.cast("int")).withColumn("own", own)
        .withColumn("pair", F.explode(F.when(F.col("blocks") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(pair)))
        .select(key, "pair.i", "pair.j", *(c for c in df.columns if c != key))
        .repartition(key, "i", "j").sortWithinPartitions(key, "i", "j")
    )


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that hold only whole groups of equal keys, with the groups' bounds."""
    held: list[pa.RecordBatch] = []

    def split(last: bool) -> tuple[pa.Table, np.ndarray, int]:
        table = pa.Table.from_batches(held).combine_chunks()
        new = np.zeros(table.num_rows, bool)
        for k in keys:
            column = table.column(k).to_numpy()
            new[1:] |= column[1:] != column[:-1]
        bounds = np.concatenate([[0], np.flatnonzero(new), [table.num_rows]])
        return table, bounds, table.num_rows if last else int(bounds[-2])

    for batch in batches:
        if not batch.num_rows:
            continue
        same = held and all(held[-1].column(k)[-1] == batch.column(k)[batch.num_rows - 1] == batch.column(k)[0] for k in keys)
        held.append(batch)
        if same:
            continue
        table, bounds, end = split(False)
        if end:
            yield table.slice(0, end), bounds[:-1]
        held = table.slice(end).to_batches()
    if held:
        table, bounds, end = split(True)
        yield table, bounds


def least_connected(adjacent: np.ndarray) -> np.ndarray:
    """For each node of a symmetric matrix the smallest node of its component."""
    n = len(adjacent)
    label = np.arange(n)
    while True:
        after = np.minimum(label, np.where(adjacent, label[None, :], n).min(axis=1))
        after = after[after]
        if (after == label).all():
            return label
        label = after


def bucket_edges(bucketed: DataFrame, params: Params) -> DataFrame:
    """(a, b): within each bucket, classes joined to the smallest one their estimates connect them with."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    least = params.least_similarity

    def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return similarity(matches(a, b, params), params) >= least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, ["key", "i", "j"]):
            ids = table.column("id").to_numpy()
            sigs = table.column("sig").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(ids), -1)
            sizes = np.diff(bounds)
            twos = bounds[:-1][sizes == 2]
            good = twos[near(sigs[twos], sigs[twos + 1])]
            a, b = [ids[good]], [ids[good + 1]]
            for start, end in zip(bounds[:-1][sizes > 2], bounds[1:][sizes > 2]):
                order = start + np.argsort(ids[start:end])
                own = sigs[order]
                adjacent = np.empty((len(own), len(own)), bool)
                for k in range(0, len(own), 128):
                    adjacent[k : k + 128] = near(own[k : k + 128, None, :], own[None, :, :])
                label = least_connected(adjacent)
                far = np.flatnonzero(label != np.arange(len(label)))
                a.append(ids[order[far]]), b.append(ids[order[label[far]]])
            yield rows(schema, a=np.concatenate(a), b=np.concatenate(b))

    return bucketed.mapInArrow(run, "a long, b long")


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of sorted distinct arrays."""
    n, sizes = len(sets), [len(s) for s in sets]
    owner = np.repeat(np.arange(n), sizes)
    _, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    keep = shared[place]
    place, owner = (np.cumsum(shared) - 1)[place[keep]], owner[keep]
    counts, width = np.zeros((n, n), np.int64), 4096
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    top = int(place[-1]) + 1 if len(place) else 0
    for low in range(0, top, width):
        a, b = np.searchsorted(place, [low, low + width])
        held = np.zeros((n, min(width, top - low)), np.float32)
        held[owner[a:b], place[a:b] - low] = 1
        counts += (held @ held.T).astype(np.int64)
    counts[np.arange(n), np.arange(n)] = sizes
    return counts


def confirmed_edges(grouped: DataFrame, params: Params) -> DataFrame:
    """(a, b): within each group, classes joined to the smallest one that true links connect them with."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    percent = params.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, ["gid", "i", "j"]):
            ids, texts = table.column("id").to_numpy(), table.column("text")
            a, b = [], []
            for start, end in zip(bounds[:-1], bounds[1:]):
                order = start + np.argsort(ids[start:end])
                sets = [shingles(lowered_words(texts[int(k)].as_py())) for k in order]
                common = common_counts(sets)
                sizes = np.diag(common)
                label = least_connected(100 * common >= percent * (sizes[:, None] + sizes[None, :] - common))
                far = np.flatnonzero(label != np.arange(len(label)))
                a += ids[order[far]].tolist()
                b += ids[order[label[far]]].tolist()
            yield rows(schema, a=a, b=b)

    return grouped.mapInArrow(run, "a long, b long")


def sized_groups(members: DataFrame, params: Params) -> DataFrame:
    """(id, gid, parts): members with the number of blocks that their group takes."""
    load = members.groupBy("gid").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("total"))
    blocks = F.ceil(F.greatest(F.col("n") / params.group_block, F.col("total") / params.block_shingles))
    return members.join(load.select("gid", blocks.cast("int").alias("parts")), "gid").select("id", "gid", "parts").distinct()


def group_edges(texts: DataFrame, members: DataFrame, params: Params) -> DataFrame:
    """Confirmed links (a, b) of all groups; ``members`` is (id, gid, n_shingles), ``texts`` (id, text).

    Members grow with the documents, so they are joined alike at every size, never broadcast.
    """
    sized = stored(sized_groups(members, params), "near-sized")
    # the only pass over all documents: what follows reads the texts of members alone
    held = stored(texts.join(sized.hint("merge"), "id").select("gid", "parts", "id", "text"), "near-texts")
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    met = held.select("gid", own.alias("i"), own.alias("j"), "id", "text")
    inside = met.repartition("gid", "i", "j").sortWithinPartitions("gid", "i", "j")
    edges = stored(confirmed_edges(inside, params).distinct(), "near-inside")
    large = sized.where("parts > 1")
    if large.isEmpty():
        return edges

    def across(chosen: DataFrame) -> DataFrame:
        own_texts = held.where("parts > 1").select("id", "text")
        joined = own_texts.join(chosen.hint("merge"), "id").select("gid", "parts", "id", "text")
        return confirmed_edges(blocked(joined, "gid", F.col("parts")), params)

    # one text for all that its block linked; their links connect what they stand for
    label = components(edges)
    standing = large.join(label, "id", "left").where(F.coalesce("label", "id") == F.col("id")).select("id", "gid")
    alone = sized_groups(standing.join(members.select("id", "n_shingles").distinct(), "id"), params)
    edges = stored(edges.union(across(alone)).distinct(), "near-standing")
    name = large.join(components(edges), "id", "left").select("gid", F.coalesce("label", "id").alias("name"))
    apart = name.groupBy("gid").agg(F.min("name").alias("low"), F.max("name").alias("high")).where("low <> high").select("gid")
    rest = stored(large.join(apart, "gid").select("id", "gid", "parts"), "near-apart")
    return edges if rest.isEmpty() else edges.union(across(rest))


def clash_edges(named: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): ids that several different texts share, joined to the classes of all of them."""
    clashing = named.groupBy("id").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).where("low <> high").select("id")
    own = named.select("id", "digest").join(clashing, "id").join(classes, "digest")
    return own.where("id <> cid").select(F.col("id").alias("a"), F.col("cid").alias("b"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", params: Params | None = None) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id``, ``kept``.

    Two documents are linked if ``100 * |intersection| >= percent * |union|`` holds for
    their sets of distinct 5-word shingles (A-Z lower-cased); a text of one to four words
    is one shingle. ``component_id`` is the smallest id that links reach, and ``kept``
    says that it is the document's own. Documents without words, and rows with a null id,
    are linked with nothing: they are kept, a null id with a null component. Rows that
    share an id are one node, which has the links of all their texts. Whole texts of any
    length are compared, and a similarity of just ``percent`` links. Other columns are left
    out; an empty table gives an empty result.
    """
    params = params or Params()
    sig = stored(signatures(docs, doc_id, text, params), "near-signatures")
    named = sig.where(F.col("id").isNotNull() & F.col("digest").isNotNull())
    classes = stored(
        named.groupBy("digest").agg(F.min("id").alias("cid")), "near-classes"
    )
    heads = stored(
        named.join(classes.select(F.col("digest").alias("d"), "cid"), (F.col("digest") == F.col("d")) & (F.col("id") == F.col("cid")))
        .select("id", "digest", "n_shingles", "sig", "bands").dropDuplicates(["id", "digest"])
        .withColumn("head", F.monotonically_increasing_id()).drop("digest"),
        "near-heads",
    )
    keyed = heads.select("head", F.explode("bands").alias("key"))
    sizes = keyed.groupBy("key").count().where("count > 1")
    shared = keyed.join(sizes, "key").join(heads.select("head", "id", "sig"), "head").select("key", "count", "id", "sig")
    buckets = blocked(shared, "key", F.ceil(F.col("count") / params.bucket_block))
    probable = components(bucket_edges(buckets, params).distinct())
    members = stored(
        probable.join(heads.select("id", "n_shingles"), "id")
        .select("id", F.col("label").alias("gid"), "n_shingles"),
        "near-members",
    )
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    links = group_edges(texts, members, params)
    linked = components(links.union(clash_edges(named, classes)).distinct())
    labelled = classes.join(linked, classes["cid"] == linked["id"], "left").select(
        F.col("digest").alias("d"), F.coalesce("label", "cid").alias("label")
    )
    out = sig.join(labelled, F.col("digest") == F.col("d"), "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("label", "id"))
    return out.select(
        F.col("id").alias(doc_id), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def keep_one_each(docs: DataFrame, params: Params | None = None) -> DataFrame:
    """One document of each group of near duplicates, with its own columns.

    Rows with a null id stay all; of rows that share an id, all stay if it is kept, and texts
    without words are copies of nothing. Extra columns, whatever their names, stay; an empty
    table gives an empty one.
    """
    gone = near_duplicates(docs, params=params).where("not kept").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone.hint("merge"), docs["doc_id"] == gone["gone_id"], "left_anti")
