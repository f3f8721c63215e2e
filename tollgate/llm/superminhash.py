"""Near-duplicate documents by SuperMinHash signatures, banding, verification and union-find."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import Store, text_steps
from tollgate.llm.components import components
from tollgate.llm.words import FACTOR, Words, run_hashes, scramble, words_of

SLOTS = 128
BANDS = 32
#: Bytes of text whose shingles go through the permutations at once.
STEP_BYTES = 600_000
#: Pivots a round takes from each bucket; the last number holds for all further rounds.
PIVOTS = (1, 8, 64, 512)


def shingle_sets(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, one after the other, and the texts' borders.

    A text of fewer words has its whole sequence as the one shingle; one without words has none.
    """
    counts = np.diff(words.borders)
    hashes, places = words.runs(length)
    ends = np.searchsorted(places, words.borders)
    short = np.flatnonzero((counts > 0) & (counts < length))
    whole = run_hashes(words.hashes, words.borders[short], words.borders[short + 1])
    sets: list[np.ndarray] = []
    lone = dict(zip(short.tolist(), whole, strict=True))
    for row in range(len(counts)):
        if row in lone:
            sets.append(np.array([lone[row]], np.uint64))
        else:
            sets.append(np.unique(hashes[ends[row] : ends[row + 1]]))
    sizes = np.array([len(one) for one in sets], np.int64)
    joined = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return joined, np.concatenate(([0], np.cumsum(sizes)))


def signatures(elements: np.ndarray, rows: np.ndarray, size: int, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash: per row the smallest j + r over elements whose permutation sends rank j to a slot.

    Each element draws its own permutation of the slots, one rank at a time (Fisher-Yates), and a
    fraction r with each rank. All elements of a row take a rank together; values at rank j lie in
    [j, j + 1), so a row whose slots are all filled cannot change and stops early.
    """
    found = np.full((size, slots), np.inf)
    order, rank = None, 0
    while len(elements) and rank < slots:
        with np.errstate(over="ignore"):
            draw = scramble(elements + np.uint64(2 * rank + 1) * FACTOR)
            swap = rank + (scramble(draw) % np.uint64(slots - rank)).astype(np.int64)
        value = rank + (draw >> np.uint64(11)).astype(np.float64) * 2.0**-53
        if order is None:
            slot = swap
        else:
            each = np.arange(len(elements))
            slot = order[each, swap].astype(np.int64)
            order[each, swap] = order[:, rank]
        np.minimum.at(found.reshape(-1), rows * slots + slot, value)
        active = np.isinf(found).any(axis=1)[rows]
        if order is None:
            # only rows that go on need their elements' permutations; rank 0 has swapped one place
            order = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.int32), (int(active.sum()), 1))
            order[np.arange(len(order)), swap[active]] = 0
        else:
            order = order[active]
        elements, rows, rank = elements[active], rows[active], rank + 1
    return found


def bands_of(found: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One hash for each band of a signature, different for equal values in different bands."""
    size, slots = found.shape
    parts = found.view(np.uint64).reshape(size, bands, slots // bands)
    with np.errstate(over="ignore"):
        keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * FACTOR, (size, bands)).copy()
        for i in range(slots // bands):
            keys = scramble(keys * FACTOR + parts[:, :, i])
    return keys.view(np.int64)


def sketch(shingle: int, slots: int, bands: int):
    """Rows (doc_id, text) to the size and digest of the shingle set and the bands of its signature."""

    def run(batches):
        for part, data, borders in text_steps(batches, "text", STEP_BYTES):
            elements, ends = shingle_sets(words_of(data, borders, lower=True), shingle)
            sizes = np.diff(ends)
            rows = np.repeat(np.arange(len(sizes)), sizes)
            keys = bands_of(signatures(elements, rows, len(sizes), slots), bands)
            full = sizes > 0
            digests = [
                hashlib.blake2b(elements[a:b].tobytes(), digest_size=16).digest() if b > a else None
                for a, b in zip(ends[:-1], ends[1:], strict=True)
            ]
            offsets = np.concatenate(([0], np.cumsum(np.where(full, bands, 0)))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[full].reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes), pa.array(digests, pa.binary()), lists],
                names=["doc_id", "n_shingles", "digest", "bands"],
            )

    return run


def full_sets(shingle: int):
    def run(batches):
        for part, data, borders in text_steps(batches, "text"):
            elements, ends = shingle_sets(words_of(data, borders, lower=True), shingle)
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(elements.view(np.int64)))
            yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["doc_id", "shingles"])

    return run


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 5,
    percent: int = 80,
    slots: int = SLOTS,
    bands: int = BANDS,
) -> DataFrame:
    """Group documents whose sets of word shingles have a Jaccard similarity of percent / 100 or more.

    Gives per row doc_id, n_shingles, component_id (the smallest doc_id reachable by links) and kept
    (doc_id = component_id). Words are runs of anything but ASCII white space, A-Z folded.

    Documents with equal sets form a class with its smallest doc_id for representative. Classes meet
    in buckets, one per band of the signature: at 32 bands of 4 slots a pair at the threshold meets
    in none with probability 5e-8. Pairs of a bucket are confirmed on the full sets. A bucket never
    forms all its pairs: a round compares its pivots (smallest ids) with the members that are not yet
    in their component, then leaves the pivots out; buckets with one component left are finished, and
    later rounds take more pivots. So a large group of near copies costs about one comparison a
    member. After the first round, documents still open leave the bands for buckets of their rarest
    shingles, in which all similar sets meet; documents that have only a common passage together meet
    late in that order or not at all, and entries with too little left after it leave their bucket.
    All other pairs of different components that share a bucket are compared.

    A document without words has no set, is linked with nothing and kept. A null doc_id cannot be
    named: its row takes no part, is kept and has a null component_id. Rows that share a doc_id share
    their links. Other columns are not read; no rows give no rows.
    """
    store = Store(docs.sparkSession, "near-duplicates")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketched = rows.mapInArrow(
        sketch(shingle, slots, bands), "doc_id long, n_shingles long, digest binary, bands array<long>"
    )
    sketched = store.keep(sketched, "sketches")
    named = sketched.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    classes = store.keep(classes, "classes", within=(sketched,))

    heads = named.join(classes.select("digest", "doc_id"), ["digest", "doc_id"], "left_semi")
    entries = heads.select("doc_id", "n_shingles", F.explode("bands").alias("bucket"))
    entries = entries.withColumns({"node": F.col("doc_id"), "n_common": F.col("n_shingles")})
    shared = entries.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    shared = shared.where("low <> high").select("bucket")
    entries = store.keep(entries.join(shared, "bucket").distinct(), "entries", within=(sketched,))

    sets = rows.join(entries.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = store.keep(sets.mapInArrow(full_sets(shingle), "doc_id long, shingles array<long>"), "sets")
    links = store.keep(store.spark.createDataFrame([], "node long, root long"), "links")
    turn = 0
    while not entries.isEmpty():
        pivots = PIVOTS[min(turn, len(PIVOTS) - 1)]
        leading = leaders(entries, pivots)
        pairs = candidates(entries, leading, percent)
        found = store.keep(confirmed(pairs, sets, percent), "found")
        following = entries.join(leading.select("bucket", "doc_id"), ["bucket", "doc_id"], "left_anti")
        if not found.isEmpty():
            roots = components(store, links.unionByName(found))
            following = relabelled(following.drop("node"), roots)
            store.drop(links)
            links = roots
        following = store.keep(following, "entries", within=(entries, links))
        left = unfinished(following if turn == 0 else within_reach(following, percent))
        left = store.keep(left, "entries", within=(following,))
        store.drop(entries, following, found)
        if turn == 0:
            met = store.keep(rarest(left, sets, percent), "entries")
            kept = unfinished(within_reach(met, percent))
            following, left = left, store.keep(kept, "entries", within=(met,))
            store.drop(following, met)
        entries, turn = left, turn + 1
    store.drop(entries, sets)

    changed = relabelled(classes, links).where("copies > 1 OR node <> doc_id").select("digest", "node")
    # only named rows have classes to look up; a null digest joins nothing
    labelled = sketched.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest"))
    labelled = labelled.join(changed, "digest", "left")
    component = F.coalesce("node", "doc_id")
    return labelled.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def relabelled(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows with node, the smallest document that doc_id is linked to by now."""
    known = roots.select(F.col("node").alias("doc_id"), F.col("root"))
    return rows.join(known, "doc_id", "left").withColumn("node", F.coalesce("root", "doc_id")).drop("root")


def unfinished(entries: DataFrame) -> DataFrame:
    """Entries of buckets that hold more than one component."""
    apart = entries.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    return entries.join(apart.where("low <> high").select("bucket"), "bucket", "left_semi")


def rarest(entries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Entries of the same documents in other buckets: one for each of their rarest shingles.

    A link needs percent / 100 of a set in the intersection. With all shingles in one order, rarest
    first, a set has the first that it shares with a similar one while at least that many are left, and
    all that they share lies from there on: n_common, the shingles left from a bucket's on, bounds the
    intersection of two sets that meet there first. Similar sets meet so without fail. Shingles
    are counted over the open documents, and one that a single document has makes no bucket.
    """
    open_sets = sets.join(entries.select("doc_id").distinct(), "doc_id", "left_semi")
    elements = open_sets.select(
        "doc_id",
        F.size("shingles").cast("long").alias("n_shingles"),
        F.xxhash64("shingles").alias("set"),
        F.explode("shingles").alias("bucket"),
    )
    several = elements.groupBy("bucket").agg(
        F.count("*").alias("times"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
    )
    several = several.where("low <> high").select("bucket", "times").hint("shuffle_hash")
    # rows that share a doc_id may have other sets, or the same set again
    order = Window.partitionBy("doc_id", "set").orderBy(F.desc("times"), F.desc("bucket"))
    ranked = elements.join(several, "bucket").withColumn("n_common", F.dense_rank().over(order).cast("long"))
    first = ranked.where(100 * F.col("n_common") >= percent * F.col("n_shingles"))
    nodes = entries.select("doc_id", "node").distinct()
    return first.select("doc_id", "n_shingles", "bucket", "n_common").distinct().join(nodes, "doc_id")


def within_reach(entries: DataFrame, percent: int) -> DataFrame:
    """Entries that can be similar enough to some member of their bucket, by sizes and shingles left.

    A pair needs (100 + percent) * n_common >= percent * (sum of both sizes) on either side, so its
    smaller set must reach its own size: a bucket without such a set has no pairs, and the sizes of
    all others lie between those of the smallest such set and the furthest that one reaches.
    """
    own = percent * F.col("n_shingles")
    reach = (100 + percent) * F.col("n_common") - own
    span = entries.where(reach >= own).groupBy("bucket").agg(F.min(own).alias("least"), F.max(reach).alias("most"))
    near = entries.join(span, "bucket").where(own.between(F.col("least"), F.col("most")) & (reach >= F.col("least")))
    return near.drop("least", "most")


def leaders(entries: DataFrame, pivots: int) -> DataFrame:
    """The smallest ids of every bucket; tasks keep only that many of their own before the exchange."""
    if pivots == 1:
        low = F.min(F.struct("doc_id", "n_shingles", "node", "n_common"))
        return entries.groupBy("bucket").agg(low.alias("one")).select("bucket", "one.*")
    order = Window.partitionBy("bucket").orderBy("doc_id")
    return entries.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= pivots).drop("rank")


def candidates(entries: DataFrame, leading: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs of a pivot and a member of another component that can be similar enough."""
    pivots = leading.select(
        "bucket",
        F.col("doc_id").alias("pivot"),
        F.col("n_shingles").alias("n_pivot"),
        F.col("n_common").alias("common_pivot"),
        F.col("node").alias("at"),
    )
    most, both = F.least("common_pivot", "n_common"), F.col("n_pivot") + F.col("n_shingles")
    possible = (100 + percent) * most >= percent * both
    pairs = entries.join(pivots, "bucket").where((F.col("at") != F.col("node")) & possible)
    return pairs.select(
        F.least("pivot", "doc_id").alias("a"), F.greatest("pivot", "doc_id").alias("b")
    ).distinct()


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    first = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    second = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(first, "a").join(second, "b")
    common = F.size(F.array_intersect("x", "y"))
    both = both.withColumn("common", common).withColumn("all", F.size("x") + F.size("y") - F.col("common"))
    both = both.where(100 * F.col("common") >= percent * F.col("all"))
    return both.select(F.col("b").alias("node"), F.col("a").alias("root")).distinct()
