"""Phrase collocations: frequent n-grams by mergeable Misra-Gries summaries, then exact counts and scores.

The first pass deals hashes of all n-grams of up to `longest` words over buckets. A bucket's summary
keeps more counters than its mass divided by the threshold, so what it forgets on the way is below the
threshold: every frequent n-gram is in it at the end. The second pass counts the n-grams that passed,
by their words, and drops those that are not frequent after all.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import Store, small_batches, text_steps
from tollgate.llm.keyfilter import KeyFilter
from tollgate.llm.words import Words, folded, run_hashes, scramble, words_of

LONGEST, THRESHOLD, LIMIT, OVERLAP = 3, 10, 2000, 50
UNKNOWN = "und"
#: Bytes that end a piece: . , ; : ! ? and U+000A to U+000D.
ENDS = np.zeros(256, bool)
ENDS[[0x2E, 0x2C, 0x3B, 0x3A, 0x21, 0x3F, 10, 11, 12, 13]] = True
#: Bytes that are in no word.
OUTSIDE = ENDS.copy()
OUTSIDE[[9, 32]] = True
#: Counters of a summary for each of mass / threshold: its error is below threshold / SLACK.
SLACK = 4
#: N-grams that one bucket holds on average, about, and that a task gathers before it sends them.
BUCKET_MASS = 3_000_000
SEND = 2_000_000
#: Distinct n-grams a task of the second pass gathers before it sends their counts.
SEND_COUNTS = 500_000
#: Bytes of text whose n-grams are made at once.
STEP_BYTES = 1_000_000

SUMMARY = "bucket long, part int, mass long, single binary, several binary, times binary"


# N-grams


class Grams:
    """The n-grams of some texts: a key for each, by language and words, and the words' bytes."""

    def __init__(self, rows: pa.RecordBatch, data: np.ndarray, borders: np.ndarray, longest: int):
        self.langs = rows.column(rows.schema.get_field_index("lang")).dictionary_encode()
        data = folded(data)
        self.words: Words = words_of(data, borders, outside=OUTSIDE)
        self.data, self.longest = data, longest
        count = len(self.words.hashes)
        self.row = np.repeat(np.arange(len(rows)), np.diff(self.words.borders))
        # pieces are told apart by the ends before them, and by their texts
        ended = np.cumsum(ENDS[data])
        piece = ended[self.words.starts] if count else np.zeros(0, np.int64)
        apart = (np.diff(piece) != 0) | (np.diff(self.row) != 0)
        # words from here to the end of the piece
        last = np.flatnonzero(np.concatenate((apart, [True]))) if count else np.zeros(0, np.int64)
        self.left = last[np.searchsorted(last, np.arange(count))] - np.arange(count) + 1 if count else last
        self.codes = self.langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        salts = np.array([name_hash(x) for x in self.langs.dictionary.to_pylist()], np.uint64)
        self.salt = salts[self.codes][self.row] if count else np.zeros(0, np.uint64)

    def keys(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of all n-grams of so many words, and the places of their first words."""
        places = np.flatnonzero(self.left >= size)
        return scramble(run_hashes(self.words.hashes, places, places + size) + self.salt[places]), places

    def phrases(self, places: np.ndarray, sizes: np.ndarray) -> pa.Array:
        """The words of n-grams, joined by one space."""
        if not len(places):
            return pa.array([], pa.string())
        # every word with one space before it, then one n-gram after the other without its first space
        which = np.repeat(places - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
        starts, lengths = self.words.starts[which], self.words.ends[which] - self.words.starts[which]
        first = np.zeros(len(which), bool)
        first[np.concatenate(([0], np.cumsum(sizes)[:-1]))] = True
        spans = lengths + ~first
        ends = np.cumsum(spans)
        source = np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), spans)
        spaces = (ends - spans)[~first]
        source[spaces] = 0
        text = self.data[source]
        text[spaces] = 32
        offsets = np.concatenate(([0], ends[np.cumsum(sizes) - 1])).astype(np.int32)
        return pa.Array.from_buffers(pa.string(), len(places), [None, pa.py_buffer(offsets), pa.py_buffer(text)])


def name_hash(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def identities(keys: np.ndarray, buckets: int) -> np.ndarray:
    """What remains of a key in its bucket: 32 bits. Keys that fall together are counted together."""
    return (bucket_of(keys, buckets) << np.uint64(32)) | (keys & np.uint64(0xFFFFFFFF))


# First pass: summaries


def send(keys: np.ndarray, buckets: int):
    """Packed counts of keys by bucket: a row with the mass, part 0, and a row with the counters, part 1."""
    found = identities(keys, buckets)
    found.sort()
    first = np.flatnonzero(np.concatenate((np.ones(min(len(found), 1), bool), found[1:] != found[:-1])))
    counts = np.diff(first, append=len(found))
    found = found[first]
    own = (found >> np.uint64(32)).astype(np.int64)
    prints = found.astype(np.uint32)  # the lower half
    present, first = np.unique(own, return_index=True)
    last = np.concatenate((first[1:], [len(own)]))
    mass = np.add.reduceat(counts, first) if len(first) else first
    once = counts == 1

    def packed(values: np.ndarray, chosen: np.ndarray) -> pa.Array:
        seen = np.concatenate(([0], np.cumsum(chosen)))
        ends = np.concatenate(([0], seen[last])).astype(np.int32) * 4
        taken = np.ascontiguousarray(values[chosen])
        return pa.Array.from_buffers(pa.binary(), len(present), [None, pa.py_buffer(ends), pa.py_buffer(taken)])

    none = pa.nulls(len(present), pa.binary())
    for part, columns in (
        (0, [pa.array(mass), none, none, none]),
        (1, [pa.nulls(len(present), pa.int64()), packed(prints, once), packed(prints, ~once),
             packed(counts.astype(np.uint32), ~once)]),
    ):
        yield pa.RecordBatch.from_arrays(
            [pa.array(present), pa.array(np.full(len(present), part, np.int32)), *columns],
            names=["bucket", "part", "mass", "single", "several", "times"],
        )


def count_grams(longest: int, buckets: int):
    """Counters of each task's n-grams."""

    def task(batches):
        held, size = [], 0
        for rows, data, borders in text_steps(batches, "text", STEP_BYTES):
            grams = Grams(rows, data, borders, longest)
            held += [grams.keys(n)[0] for n in range(1, longest + 1)]
            size += sum(len(x) for x in held[-longest:])
            if size >= SEND:
                yield from send(np.concatenate(held), buckets)
                held, size = [], 0
        if size:
            yield from send(np.concatenate(held), buckets)

    return task


class Summary:
    """A Misra-Gries summary: at most `capacity` counters; each is too low by at most `error`."""

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Merge other counters; they wait until they are as many as a full summary."""
        self.waiting.append((keys, counts))
        self.size += len(keys)
        if self.size > max(self.capacity, 100_000):
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *(x[0] for x in self.waiting)])
        counts = np.concatenate([self.counts, *(x[1] for x in self.waiting)])
        self.waiting, self.size = [], 0
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1])))
        self.keys, self.counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        if len(self.keys) > self.capacity:
            # the (capacity + 1)-th largest counter goes from all: that many keep nothing or more
            level = len(self.counts) - self.capacity - 1
            cut = int(np.partition(self.counts, level)[level])
            self.error += cut
            good = self.counts > cut
            self.keys, self.counts = self.keys[good], self.counts[good] - cut

    def frequent(self, threshold: int) -> np.ndarray:
        """Every key that may have reached the threshold."""
        self.merge()
        return self.keys[self.counts + self.error >= threshold]


def merge_summaries(threshold: int):
    """Buckets' rows, those with the masses first, to the identities of n-grams that may be frequent."""

    def task(batches):
        now, mass, summary = None, 0, None
        for batch in batches:
            columns = [batch.column(i) for i in range(6)]
            for at in range(len(batch)):
                bucket = columns[0][at].as_py()
                if bucket != now:
                    if summary is not None:
                        yield from identified(now, summary.frequent(threshold))
                    now, mass, summary = bucket, 0, None
                if columns[1][at].as_py() == 0:
                    mass += columns[2][at].as_py()
                    continue
                if summary is None:
                    summary = Summary(SLACK * mass // threshold + 1)
                single, several, times = (
                    np.frombuffer(columns[i][at].as_buffer(), np.uint32) for i in (3, 4, 5)
                )
                ones = np.ones(len(single), np.int64)
                summary.add(np.concatenate((single, several)), np.concatenate((ones, times.astype(np.int64))))
        if summary is not None:
            yield from identified(now, summary.frequent(threshold))

    return task


def identified(bucket: int, prints: np.ndarray):
    keys = (np.uint64(bucket) << np.uint64(32)) | prints.astype(np.uint64)
    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], names=["key"])


# Second pass: exact counts


def count_frequent(longest: int, buckets: int, known: KeyFilter):
    """Counts of n-grams that may be frequent: (lang, size, phrase, count); and of all words, with size 0."""

    def task(batches):
        held: list[tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]] = []
        size = 0
        for rows, data, borders in text_steps(batches, "text", STEP_BYTES):
            grams = Grams(rows, data, borders, longest)
            counts = np.bincount(grams.codes[grams.row], minlength=len(grams.langs.dictionary))
            used = np.flatnonzero(counts)
            yield counted(grams.langs.dictionary.take(pa.array(used)), 0, pa.nulls(len(used), pa.string()), counts[used])
            passing = None
            found = []
            for n in range(1, longest + 1):
                keys, places = grams.keys(n)
                good = known.passing(identities(keys, buckets))
                if passing is not None:  # both n-grams of one word less are frequent too
                    good &= passing[places] & passing[places + 1]
                passing = np.zeros(len(grams.left) + 1, bool)
                passing[places[good]] = True
                unique, at, counts = np.unique(keys[good], return_index=True, return_counts=True)
                found.append((unique, counts, places[good][at], np.full(len(unique), n)))
            keys, counts, places, sizes = (np.concatenate(x) for x in zip(*found, strict=True))
            langs = grams.langs.dictionary.take(pa.array(grams.codes[grams.row[places]]))
            held.append((keys, counts, langs, grams.phrases(places, sizes), sizes))
            size += len(keys)
            if size >= SEND_COUNTS:
                yield together(held)
                held, size = [], 0
        if size:
            yield together(held)

    return task


def together(held) -> pa.RecordBatch:
    """The counts of several steps, one row for each n-gram."""
    keys = np.concatenate([x[0] for x in held])
    _, first, which = np.unique(keys, return_index=True, return_inverse=True)
    totals = np.bincount(which, weights=np.concatenate([x[1] for x in held])).astype(np.int64)
    langs = pa.concat_arrays([x[2] for x in held]).take(pa.array(first))
    phrases = pa.concat_arrays([x[3] for x in held]).take(pa.array(first))
    return counted(langs, np.concatenate([x[4] for x in held])[first], phrases, totals)


def counted(langs, sizes, phrases, counts) -> pa.RecordBatch:
    sizes = np.broadcast_to(np.asarray(sizes, np.int32), len(counts))
    return pa.RecordBatch.from_arrays(
        [langs.cast(pa.string()), pa.array(sizes), phrases, pa.array(np.asarray(counts, np.int64))],
        names=["lang", "size", "phrase", "count"],
    )


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, threshold: int = THRESHOLD) -> DataFrame:
    """Exact counts of all phrases of 1 to `longest` words that occur threshold times or more in their language.

    Rows (lang, size, phrase, count), and one of size 0 for each language with all its words.
    """
    spark = docs.sparkSession
    store = Store(spark, "phrases")
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("string").alias("text")
    ).where(F.length("text") > 0)
    # a word and what follows it have two bytes at least; about six make one word
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(1, size * longest // 6 // BUCKET_MASS)
    dealt = texts.mapInArrow(count_grams(longest, buckets), SUMMARY).repartition("bucket")
    dealt = dealt.sortWithinPartitions("bucket", "part")
    with small_batches(spark):
        frequent = store.keep(dealt.mapInArrow(merge_summaries(threshold), "key long"), "frequent")
    counts = texts.mapInArrow(
        count_frequent(longest, buckets, KeyFilter(frequent)), "lang string, size int, phrase string, count long"
    )
    counts = counts.groupBy("lang", "size", "phrase").agg(F.sum("count").alias("count"))
    with small_batches(spark):
        kept = store.keep(counts.where((F.col("size") == 0) | (F.col("count") >= threshold)), "counts")
    store.drop(frequent)
    return kept


def part(words: Column, first: Column | int, count: Column) -> Column:
    return F.array_join(F.slice(words, first, count), " ")


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    threshold: int = THRESHOLD,
    limit: int = LIMIT,
    overlap: int = OVERLAP,
) -> DataFrame:
    """The best collocations of each language: lang, rank, phrase, a, l, r, n, score.

    A-Z are folded; pieces end at . , ; : ! ? and U+000A to U+000D, words at spaces and tabs. A phrase is
    2 to `longest` words of one piece that occur threshold times or more (a) in the language (null:
    und; a null text has no words). Cut after its first k words, whose phrases occur l and r times,
    it scores floor(10^6 a a / (l r)); the cut with the lowest score counts, the first of equal ones.
    A phrase goes whose words stand in a longer one of at least overlap percent of its count. Per
    language the first `limit` by score, a, phrase (in byte order) remain. n: all its words. Rows
    need no doc_id; repeated rows count each. Empty tables give empty tables.
    """
    counts = frequent_phrases(docs, longest, threshold)
    words = F.split("phrase", " ", -1)
    several = counts.where("size > 1").select("lang", "phrase", "size", F.col("count").alias("a"))
    known = counts.where("size > 0").select("lang", F.col("phrase").alias("part"), F.col("count").alias("f"))
    cuts = several.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k",
        part(words, 1, F.col("k")).alias("left"),
        part(words, F.col("k") + 1, F.col("size") - F.col("k")).alias("right"),
    )
    cuts = cuts.join(known.select("lang", F.col("part").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(known.select("lang", F.col("part").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    wide = {c: F.col(c).cast("decimal(15,0)") for c in "alr"}  # so that products have 38 digits at most
    cuts = cuts.select("lang", "phrase", "a", "k", "l", "r", (wide["a"] * wide["a"] * F.lit(1_000_000)).alias("_over"),
                       (wide["l"] * wide["r"]).alias("_under"))
    cuts = cuts.withColumn("score", F.expr("_over div _under"))
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = several.where("size > 2").withColumn("part_size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("part_size") + 1)))
    inner = inner.select("lang", part(words, F.col("at"), F.col("part_size")).alias("phrase"), F.col("a").alias("outer"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    single = lowest.join(inner, ["lang", "phrase"], "left")
    alone = single.where(F.col("outer").isNull() | (F.col("outer") * 100 < F.col("a") * overlap))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = alone.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    best = best.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= limit)
    totals = counts.where("size = 0").select("lang", F.col("count").alias("n"))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
