"""Benchmark decontamination: windows of benchmark items found in documents by a prefix-filtered join.

A window holds some shingles (runs of a few words). Its rarest ones, in the order of their counts in
all documents, are its prefix: a document window with enough of the shingles must hold one of them, so
only places with a prefix shingle meet windows. The place fixes where the window would begin; whether
it fits there and holds enough shingles is then checked word by word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.anchors import flatten
from tollgate.llm.common import Store, text_steps
from tollgate.llm.keyfilter import KeyFilter
from tollgate.llm.words import Words, run_hashes, words_of

WINDOW = 10
SHINGLE = 4
#: Bytes that are in no word: all of ASCII but digits and lower-case letters. Texts are folded first.
OUTSIDE = np.ones(256, bool)
OUTSIDE[0x30:0x3A] = OUTSIDE[0x61:0x7B] = OUTSIDE[0x80:] = False
#: Windows that a task makes at once.
STEP_WINDOWS = 50_000

WINDOWS = "item_class long, words array<long>, shingles array<long>"
FOUND = "doc_id long, n_words long, candidates array<struct<place: int, shingle: long, first: int, words: array<long>>>"


def lists(values: np.ndarray, borders: np.ndarray) -> pa.Array:
    """A column of lists of long: values between borders."""
    return pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), pa.array(values.view(np.int64)))


def equal_lists(table: np.ndarray) -> pa.Array:
    return lists(np.ascontiguousarray(table).ravel(), np.arange(len(table) + 1) * table.shape[1])


# In tasks


def item_words(batches):
    """Rows (item_id, words): the hashes of each item's words."""
    for rows, data, borders in text_steps(batches, "text"):
        words = words_of(data, borders, lower=True, outside=OUTSIDE)
        ids = rows.column(rows.schema.get_field_index("item_id"))
        yield pa.RecordBatch.from_arrays([ids, lists(words.hashes, words.borders)], names=["item_id", "words"])


def item_windows(window: int, shingle: int):
    """All windows of `window` words of each row (item_class, words); a shorter row is one window."""

    def task(batches):
        for batch in batches:
            classes = batch.column(0).to_numpy(zero_copy_only=False)
            hashes, rows = flatten(batch.column(1))
            counts = np.bincount(rows, minlength=len(batch))
            left = np.repeat(np.cumsum(counts), counts) - np.arange(len(hashes))
            sizes = np.minimum(counts, window)[rows]
            for size in np.unique(sizes):
                starts = np.flatnonzero((sizes == size) & (left >= size))
                short = min(shingle, int(size))
                for at in range(0, len(starts), STEP_WINDOWS):
                    some = starts[at : at + STEP_WINDOWS, None]
                    places = some + np.arange(size)
                    ends = places[:, : size - short + 1]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(classes[rows[some[:, 0]]]),
                            equal_lists(hashes[places]),
                            equal_lists(run_hashes(hashes, ends, ends + short)),
                        ],
                        names=["item_class", "words", "shingles"],
                    )

    return task


def runs_of(words: Words, lengths: list[int], known: KeyFilter) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of those lengths that pass a filter: their hashes, places and lengths."""
    found = []
    for length in lengths:
        hashes, places = words.runs(length)
        good = known.passing(hashes)
        found.append((hashes[good], places[good], np.full(good.sum(), length)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def count_shingles(lengths: list[int], known: KeyFilter):
    """How often documents hold shingles that may be an item's: (shingle, count)."""

    def task(batches):
        for _, data, borders in text_steps(batches, "text"):
            words = words_of(data, borders, lower=True, outside=OUTSIDE)
            hashes, counts = np.unique(runs_of(words, lengths, known)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(counts)], names=["shingle", "count"]
            )

    return task


def find_candidates(window: int, lengths: list[int], known: KeyFilter):
    """Each document with its number of words and the places that hold a prefix shingle.

    A candidate carries the words around it, as far as any window that holds it reaches.
    """

    def task(batches):
        for rows, data, borders in text_steps(batches, "text"):
            words = words_of(data, borders, lower=True, outside=OUTSIDE)
            hashes, places, sizes = runs_of(words, lengths, known)
            order = np.argsort(places, kind="stable")
            hashes, places, sizes = hashes[order], places[order], sizes[order]
            row = np.searchsorted(words.borders, places, side="right") - 1
            begin = words.borders[row]
            first = np.maximum(places + sizes - window, begin)
            last = np.minimum(places + window, words.borders[row + 1])
            spans = np.concatenate(([0], np.cumsum(last - first)))
            at = np.arange(spans[-1]) + np.repeat(first - spans[:-1], last - first)
            structs = pa.StructArray.from_arrays(
                [
                    pa.array((places - begin).astype(np.int32)),
                    pa.array(hashes.view(np.int64)),
                    pa.array((first - begin).astype(np.int32)),
                    lists(words.hashes[at], spans),
                ],
                names=["place", "shingle", "first", "words"],
            )
            cuts = np.searchsorted(row, np.arange(len(rows) + 1)).astype(np.int32)
            ids = rows.column(rows.schema.get_field_index("doc_id"))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.diff(words.borders)), pa.ListArray.from_arrays(pa.array(cuts), structs)],
                names=["doc_id", "n_words", "candidates"],
            )

    return task


# The join


def needed(count: Column, percent: int) -> Column:
    """Of so many shingles of a window, those that must be there."""
    return F.ceil(count * F.lit(percent) / 100).cast("int")


def prefixes(windows: DataFrame, counts: DataFrame, percent: int) -> DataFrame:
    """The prefix of each window: its rarest shingles, one more than may be missing; (shingle, place, window).

    Windows of which too few shingles are in any document have none.
    """
    each = windows.select("window", "words", F.posexplode("shingles").alias("place", "shingle"))
    ranked = each.join(counts, "shingle", "left").groupBy("window").agg(
        F.first("words").alias("words"),
        F.array_sort(
            F.collect_list(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "shingle", "place"))
        ).alias("order"),
    )
    spare = F.size("order") - needed(F.size("order"), percent) + 1
    prefix = F.filter(F.slice("order", F.lit(1), spare), lambda x: x["count"] > 0)
    here = F.size(F.filter("order", lambda x: x["count"] > 0)) >= needed(F.size("order"), percent)
    return ranked.where(here).select(
        "window", "words", F.size("order").alias("shingles"), F.explode(prefix).alias("one")
    ).select("one.shingle", F.col("one.place").alias("offset"), "window", F.col("words").alias("item"), "shingles")


def held(percent: int) -> Column:
    """Whether the document's words at a candidate hold enough of the window's shingles at their places."""
    skipped, size = F.col("start") - F.col("first"), F.size("item")
    here = F.slice("words", skipped + 1, size)
    if percent == 100:
        return here == F.col("item")
    same = F.zip_with(here, F.col("item"), lambda x, y: x == y)
    short = size - F.col("shingles")  # a shingle has one word more
    whole = F.filter(
        F.sequence(F.lit(1), F.col("shingles")), lambda at: F.forall(F.slice(same, at, short + 1), lambda x: x)
    )
    return F.size(whole) >= needed(F.col("shingles"), percent)


def covered(spans: DataFrame) -> DataFrame:
    """Words of each document under any of its spans (document, start, size)."""
    order = Window.partitionBy("document").orderBy("start", "size")
    end = F.col("start") + F.col("size")
    before = F.coalesce(F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    more = F.greatest(F.lit(0), end - F.greatest("start", before))
    return spans.withColumn("more", more).groupBy("document").agg(F.sum("more").cast("long").alias("n_hit"))


def contaminated(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, percent: int = 100
) -> DataFrame:
    """Documents with the benchmark items whose windows they hold.

    Words are runs of digits, letters and non-ASCII characters, A-Z folded. A window is `window`
    successive words of an item, or all words of a shorter one that has any. A document holds it where
    as many successive words have at least percent of the window's shingles at their places; with 100
    those are the same words.

    Gives per row of docs: doc_id, n_words, n_hit (words inside any such place), n_items, items_sha256
    (of the item ids in order as strings, joined by commas), contaminated. A null text has no words;
    rows without doc_id, or that share one, are judged one by one. Items that share an item_id count
    once; those without one hit words but are not counted. Equal items are compared once; the ids of
    all items found in one document stand in one row, as their digest needs them.
    """
    spark = docs.sparkSession
    store = Store(spark, "decontamination")
    named = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    words = named.mapInArrow(item_words, "item_id string, words array<long>").where(F.size("words") > 0)
    classes = words.groupBy("words").agg(F.collect_set("item_id").alias("item_ids"))
    classes = store.keep(classes.withColumn("item_class", F.monotonically_increasing_id()), "classes")
    windows = classes.select("item_class", "words").mapInArrow(item_windows(window, shingle), WINDOWS)
    own = windows.groupBy("words").agg(F.first("shingles").alias("shingles"))
    own = store.keep(own.withColumn("window", F.monotonically_increasing_id()), "windows")

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    length = F.size("words") - F.size("shingles") + 1
    lengths = [row[0] for row in own.select(length).distinct().collect()]  # at most as many as a shingle has words
    if not lengths:
        lengths = [shingle]
    keys = store.keep(own.select(F.explode("shingles").alias("key")).distinct(), "shingles")
    counts = texts.mapInArrow(count_shingles(lengths, KeyFilter(keys)), "shingle long, count long")
    counts = counts.groupBy("shingle").agg(F.sum("count").alias("count"))
    prefix = store.keep(prefixes(own, counts, percent), "prefixes")
    keys = store.keep(prefix.select(F.col("shingle").alias("key")).distinct(), "prefix-keys")
    found = texts.mapInArrow(find_candidates(window, lengths, KeyFilter(keys)), FOUND)
    found = store.keep(found.withColumn("document", F.monotonically_increasing_id()), "candidates")

    places = found.select("document", F.explode("candidates").alias("one")).select("document", "one.*")
    met = places.join(prefix, "shingle").withColumn("start", F.col("place") - F.col("offset"))
    fits = (F.col("start") >= F.col("first")) & (
        F.col("start") + F.size("item") <= F.col("first") + F.size("words")
    )
    hits = met.where(fits & F.coalesce(held(percent), F.lit(False)))
    hits = store.keep(hits.select("document", "start", F.size("item").alias("size"), "window"), "hits")

    n_hit = covered(hits.select("document", "start", "size").distinct())
    in_class = windows.join(own.select("words", "window"), "words").select("window", "item_class").distinct()
    holds = hits.select("document", "window").distinct().join(in_class, "window")
    holds = holds.select("document", "item_class").distinct().join(classes.select("item_class", "item_ids"), "item_class")
    ids = F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids"))))
    per_document = holds.groupBy("document").agg(ids.alias("ids"))
    per_document = per_document.select(
        "document", F.size("ids").cast("long").alias("n_items"), F.array_join("ids", ",").alias("joined")
    )
    result = found.select("document", "doc_id", "n_words").join(n_hit, "document", "left")
    result = result.join(per_document, "document", "left")
    return result.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("joined", F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
