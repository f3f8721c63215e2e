"""Mixing sources to target weights by pivotal dependent rounding, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import WORD, Store, small_enough

#: Documents one group rounds in sequence, about; the tree's fan-in.
FAN_IN = 32
MOST_COPIES = 3
#: Sources up to which their table is broadcast.
BROADCAST_SOURCES = 10_000


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, cycle: int = 3, most: int = MOST_COPIES) -> DataFrame:
    """Per source its size and target, from rows of (source, size).

    Sources in code-point order, null last, weigh 1 to cycle, repeating. The whole size is shared by
    weight; no source gets more than most times its own size, and what exceeds that is shared again
    by weight among the others. The sources that end at their bound are those with the smallest
    bound per weight, so one running sum in that order finds them. Windows here run over one row
    per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = per_source.select(
        "source",
        "source_size",
        ((F.row_number().over(by_name) - 1) % cycle + 1).cast("double").alias("weight"),
        (F.col("source_size") * most).cast("double").alias("bound"),
    )
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last())
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    shared = weighed.withColumns(
        {
            "left": F.sum("source_size").over(everything) - F.coalesce(F.sum("bound").over(before), F.lit(0.0)),
            "weights": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        }
    )
    # a source is at its bound if its share of what the earlier ones leave reaches it
    level = F.col("left") / F.col("weights")
    shared = shared.withColumn("at_bound", F.col("bound") <= level * F.col("weight"))
    free_level = F.min(F.when(~F.col("at_bound"), F.struct(F.col("bound") / F.col("weight"), level.alias("level"))))
    shared = shared.withColumn("free", free_level.over(everything).getField("level"))
    target = F.when(F.col("at_bound"), F.col("bound")).otherwise(F.col("free") * F.col("weight"))
    return shared.select("source", "source_size", target.alias("target"))


def uniform(seed: int, *columns: Column) -> Column:
    """A number in [0, 1) that these values decide."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) / float(2**53)


def settle(items: Column, seed: int) -> Column:
    """Round a group's fractions in sequence: (decided rows, the row that is left).

    Two rows at a time: mass p * size moves from one to the other until one fraction is 0 or 1. The
    two possible ends are drawn so that both fractions keep their expected value; the sum of
    p * size never changes. At most one row of a group keeps a fraction.
    """

    def step(state: Column, item: Column) -> Column:
        a, b = state.left, item
        up = F.least((1 - a.p) * a.size, b.p * b.size)  # mass a can take from b
        down = F.least(a.p * a.size, (1 - b.p) * b.size)  # mass b can take from a
        draw = uniform(seed, a.doc_id, a.size, b.doc_id, b.size, a.p, b.p)
        a_takes = draw * (up + down) < down
        a_full = (1 - a.p) * a.size <= b.p * b.size  # taking ends with a at 1, else with b at 0
        b_full = (1 - b.p) * b.size <= a.p * a.size  # giving ends with b at 1, else with a at 0
        new_a = F.when(a_takes, a.p + up / a.size).otherwise(a.p - down / a.size)
        new_b = F.when(a_takes, b.p - up / b.size).otherwise(b.p + down / b.size)
        a_done = F.when(a_takes, a_full).otherwise(~b_full)
        extra = F.when(a_takes, F.when(a_full, 1).otherwise(0)).otherwise(F.when(b_full, 1).otherwise(0))
        done = F.when(a_done, a.withField("extra", extra)).otherwise(b.withField("extra", extra))
        left = F.when(a_done, b.withField("p", new_b)).otherwise(a.withField("p", new_a))
        # a fraction that rounding errors left at an end stays inside it
        left = left.withField("p", F.least(F.greatest(left.p, F.lit(0.0)), F.lit(1.0)))
        return F.struct(F.concat(state.done, F.array(done)).alias("done"), left.alias("left"))

    first = F.struct(F.slice(items, 1, 0).alias("done"), F.element_at(items, 1).alias("left"))
    return F.aggregate(F.slice(items, 2, F.size(items)), first, step)


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 7,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """How often each document is taken so that every source comes near its target.

    Gives doc_id, source, size (words), source_size, target, copies (0 to 3) and taken (size times
    copies), one row per input row. A document's expected copies are target / source_size; the whole
    part is certain and the fraction p is rounded: groups of about fan_in documents of one source
    settle in sequence, each passes on at most one unsettled document, and the next round groups
    those, until a source has one left, which a draw settles. So a source misses its target by less
    than that one document. Groups follow from ids, hence reruns agree and a hot source is dealt
    over as many groups as it has documents by fan_in.

    A null text has no words, and documents without words get no copies. A null source is a source
    of its own, the last one. Rows that repeat, or without an id, are documents of their own: their
    group also follows from their size, and equal rows may stand for one another. Other columns are
    not read. No rows give no rows; targets of sources without words are 0.
    """
    store = Store(docs.sparkSession, "mixing")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), words_of(F.col(text)).alias("size")
    )
    rows = store.keep(rows, "sizes")
    aims = store.keep(targets(rows.select("source", "size")), "targets")
    if small_enough(aims, BROADCAST_SOURCES):
        aims = F.broadcast(aims)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rate = F.least(rate, F.lit(float(MOST_COPIES)))
    matched = rows.withColumnRenamed("source", "_source").join(aims, F.col("_source").eqNullSafe(F.col("source")))
    matched = matched.select("doc_id", "source", "size", "source_size", "target", rate.alias("rate"))
    matched = matched.withColumn("base", F.floor("rate").cast("int"))
    matched = matched.withColumn("p", F.col("rate") - F.col("base")).drop("rate")
    certain = (F.col("size") == 0) | (F.col("p") <= 0)
    decided = [matched.where(certain).withColumn("extra", F.lit(0)).drop("p")]
    open_rows = matched.where(~certain)
    counted = open_rows.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    # the groups of a source: as many as its documents by fan_in, a power of fan_in at the top
    rounds = 0
    while counted > fan_in ** (rounds + 1):
        rounds += 1
    item = F.struct(
        uniform(seed, F.col("doc_id"), F.col("size")).alias("place"),
        "doc_id", "size", "p", "base", "source_size", "target", F.lit(0).alias("extra"),
    )
    for level in range(rounds, -1, -1):
        group = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size")), F.lit(fan_in**level))
        grouped = open_rows.groupBy("source", group.alias("group")).agg(F.array_sort(F.collect_list(item)).alias("items"))
        settled = grouped.select("source", settle(F.col("items"), seed + level).alias("state"))
        settled = store.keep(settled.select("source", "state.done", "state.left"), "round", within=(rows,))
        fields = [f"row.{name}" for name in ("doc_id", "size", "source_size", "target", "base", "extra")]
        done = settled.select("source", F.explode("done").alias("row"))
        decided.append(done.select("source", *fields))
        open_rows = settled.select("source", "left.*")
    last = F.when(uniform(seed - 1, F.col("doc_id"), F.col("size")) < F.col("p"), 1).otherwise(0)
    decided.append(open_rows.withColumn("extra", last))
    names = ["doc_id", "source", "size", "source_size", "target", "base", "extra"]
    result = decided[0].select(*names)
    for part in decided[1:]:
        result = result.unionByName(part.select(*names))
    copies = F.when(F.col("size") > 0, F.col("base") + F.col("extra")).otherwise(0)
    result = result.withColumn("copies", copies).withColumn("taken", F.col("size") * F.col("copies"))
    return result.drop("base", "extra")
