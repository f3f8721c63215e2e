"""Velocity of a stream: minute partials of earlier batches as a table, rows of one batch in arrival order.

The state of all batches before is a table (account, minute, count, amount), kept in pieces: each batch
adds one, and every FAN pieces become one that leaves out minutes which no window reaches any more, so
a row is rewritten a few times at most and a batch reads a few dozen pieces. A piece is one of the
outputs that a batch commits together, so records and state cannot part.

An account with many rows in a batch is cut into chunks by source partition and offsets, each with the
minute totals of what came before it: no key is bound to one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.config import DAY_MS, MINUTE_MS, SkewConfig
from tollgate.operators.velocity import as_count, as_money
from tollgate.schemas import ARRIVAL, VELOCITY_WINDOWS

#: Pieces of the state that become one.
FAN = 16
#: Rows that are compared with one another at once.
BLOCK = 512
PARTIALS = T.StructType(
    [
        T.StructField("account_id", T.StringType()),
        T.StructField("minute", T.LongType()),
        T.StructField("cnt", T.LongType()),
        T.StructField("amount", T.DecimalType(38, 4)),
    ]
)
_BACK = [minutes for _, minutes in VELOCITY_WINDOWS]
_LIMB = 1 << 40


# The state


def live_pieces(batch_id: int) -> list[int]:
    """The batches whose pieces make up the state before a batch, oldest first."""
    pieces, span, rest = [], 1, batch_id
    while rest:
        pieces += [(rest - i) * span - 1 for i in range(rest % FAN)]
        rest, span = rest // FAN, span * FAN
    return sorted(pieces)


def joined_pieces(batch_id: int) -> list[int]:
    """The pieces that a batch's own piece replaces."""
    return sorted(set(live_pieces(batch_id)) - set(live_pieces(batch_id + 1)))


def read_pieces(
    spark: SparkSession, folder: str, batches: list[int], schema: T.StructType = PARTIALS
) -> DataFrame:
    if not batches:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{folder}/batch_id={b}" for b in batches))


def minute_of(time: Column) -> Column:
    return F.floor(time / MINUTE_MS).cast("bigint")


def next_piece(rows: DataFrame, replaced: DataFrame, clock: int | None, lateness_ms: int) -> DataFrame:
    """The piece of a batch: its own partials with those of the pieces it replaces.

    clock is the watermark under which the batch's rows were accepted. No later row lies more than the
    lateness behind it, so minutes a day before that are in no later window.
    """
    own = rows.select(
        "account_id", minute_of(F.col("event_time")).alias("minute"), F.lit(1).cast("bigint").alias("cnt"),
        F.col("amount").cast("decimal(38,4)").alias("amount"),
    )
    both = own.unionByName(replaced)
    if clock is not None:
        both = both.where(F.col("minute") >= (clock - lateness_ms - DAY_MS) // MINUTE_MS - 1)
    total = both.groupBy("account_id", "minute").agg(
        F.sum("cnt").alias("cnt"), F.sum("amount").cast("decimal(38,4)").alias("amount")
    )
    return total.sortWithinPartitions("minute")  # so that readers skip what is too old


# The rows of one batch


class _Open:
    """Minute totals of the rows so far of the group that the last block ended in."""

    key, minutes, suffix = None, np.zeros(0, np.int64), np.zeros((1, 3), np.int64)

    def add(self, key: int, minutes: np.ndarray, weights: np.ndarray) -> None:
        if key == self.key:
            minutes = np.concatenate([self.minutes, minutes])
            weights = np.concatenate([self.suffix[:-1] - self.suffix[1:], weights])
        self.key = key
        self.minutes, place = np.unique(minutes, return_inverse=True)
        totals = np.zeros((len(self.minutes) + 1, 3), np.int64)
        np.add.at(totals, place, weights)
        self.suffix = totals[::-1].cumsum(axis=0)[::-1]


def window_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of each row's windows over the elements of its group up to itself.

    Elements are sorted by group; minute totals from before come first in it (kind 0), then its rows in
    arrival order. A window reaches back some minutes from the row's own, and takes later ones too.
    """
    before = _Open()
    for batch in batches:
        column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        key, minute = (column[c].to_numpy(zero_copy_only=False) for c in ("_key", "_minute"))
        weights = np.stack([column[c].to_numpy(zero_copy_only=False) for c in ("_cnt", "_high", "_low")], axis=1)
        out = np.zeros((len(key), len(_BACK), 3), np.int64)
        for first in range(0, len(key), BLOCK):
            part = slice(first, first + BLOCK)
            keys, minutes, own = key[part], minute[part], weights[part]
            earlier = (keys[:, None] == keys[None, :]) & np.tri(len(keys), dtype=bool)
            opened = keys == before.key
            for k, back in enumerate(_BACK):
                reached = earlier & (minutes[None, :] >= minutes[:, None] - back)
                out[part, k] = reached.astype(np.int64) @ own
                if opened.any():
                    places = np.searchsorted(before.minutes, minutes[opened] - back)
                    out[first : first + len(keys), k][opened] += before.suffix[places]
            last = keys == keys[-1]
            before.add(keys[-1], minutes[last], own[last])
        rows = pa.array(column["_kind"].to_numpy(zero_copy_only=False) == 1)
        totals = [
            pa.array(np.ascontiguousarray(out[:, k, j])) for k in range(len(_BACK)) for j in range(3)
        ]
        names = [f"_{name}_{label}" for label, _ in VELOCITY_WINDOWS for name in ("n", "high", "low")]
        yield pa.RecordBatch.from_arrays([column["_row"], *totals], names=["_row", *names]).filter(rows)


def _limbs(amount: Column) -> list[Column]:
    """An amount as two numbers whose sums stay exact: whole times 2^40, and the rest.

    Totals of a minute are held to 10^20: amounts are not negative, so each window with one is far
    beyond its contract type either way.
    """
    held = F.least(amount.cast("decimal(38,4)"), F.lit("1e20").cast("decimal(38,4)"))
    unscaled = (held * 10_000).cast("decimal(38,0)")
    low = F.pmod(unscaled, F.lit(_LIMB).cast("decimal(38,0)"))
    return [((unscaled - low) / F.lit(_LIMB)).cast("bigint").alias("_high"), low.cast("bigint").alias("_low")]


def _renamed(accounts: DataFrame) -> DataFrame:
    return accounts.withColumnRenamed("account_id", "_account")


def _same_account(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on account_id and _account; rows without account are one account's."""
    return left.join(right, F.col("account_id").eqNullSafe(F.col("_account")), how)


def _before_chunks(points: DataFrame, asked: DataFrame) -> DataFrame:
    """What came before each chunk of a hot account, as totals that its windows see alike.

    points (_account, _index, minute, cnt, amount): minute totals of chunks by their number, and of the
    state as number 0. asked (_account, _index, from): the minutes from which windows of a chunk reach.
    The chunks before number c are as many runs of 1, 2, 4, ... chunks as c has binary digits 1, so a
    point and a question stand in a few runs each. In a run, totals from a minute on are a growing
    sum over its minutes: the work grows with rows times the logarithm of chunks, not with chunks
    times minutes. The differences of a chunk's answers are its totals.
    """
    chunks = points.agg(F.max("_index")).first()[0] or 0
    level = F.explode(F.sequence(F.lit(0), F.lit(max(0, int(chunks).bit_length() - 1))))
    run = F.expr("shiftright(_index, _level)")
    run_key = ["_account", "_level", "_run"]
    held = points.withColumn("_level", level).withColumn("_run", run).where("_run % 2 = 0")
    held = held.groupBy(*run_key, "minute").agg(F.sum("cnt").alias("cnt"), F.sum("amount").alias("amount"))
    queries = asked.withColumn("_level", level).withColumn("_run", run - 1).where("_run % 2 = 0")
    nothing = [F.lit(0).cast("bigint").alias("cnt"), F.lit(0).cast("decimal(38,4)").alias("amount")]
    once = queries.select(*run_key, F.col("from").alias("minute"), F.lit(True).alias("_asked"), *nothing).distinct()
    growing = Window.partitionBy(*run_key).orderBy(F.desc("minute")).rangeBetween(Window.unboundedPreceding, 0)
    both = held.withColumn("_asked", F.lit(False)).unionByName(once)
    answers = both.select(*run_key, "_asked", F.col("minute").alias("from"),
                          *(F.sum(c).over(growing).alias(c) for c in ("cnt", "amount"))).where("_asked")
    totals = queries.join(answers.drop("_asked"), [*run_key, "from"]).groupBy("_account", "_index", "from").agg(
        F.sum("cnt").alias("cnt"), F.sum("amount").alias("amount")
    )
    ordered = Window.partitionBy("_account", "_index").orderBy("from")
    return totals.select(
        "_account", "_index", F.col("from").alias("minute"),
        *((F.col(c) - F.coalesce(F.lead(c).over(ordered), F.lit(0))).alias(c) for c in ("cnt", "amount")),
    ).where("cnt > 0")


def batch_velocity(rows: DataFrame, state: DataFrame, skew: SkewConfig | None = None) -> DataFrame:
    """Adds the velocity columns to the rows of one batch, in arrival order after all of state.

    Rows of an account count if they arrived before, or with, the row and lie in a minute not too far
    back, later ones included. An account with more than skew.block_rows rows is cut into chunks of
    as many offsets.
    """
    skew = skew or SkewConfig()
    order = [c for c in ("source_topic", *ARRIVAL) if c in rows.columns]
    accounts = rows.groupBy("account_id").agg(F.count(F.lit(1)).alias("_rows"))
    # at most the batch's rows / block_rows accounts, whatever their number
    hot = accounts.where(F.col("_rows") > skew.block_rows)
    hot = F.broadcast(_renamed(hot.select("account_id", F.lit(True).alias("_hot"))))
    block = F.floor(F.col("source_offset") / skew.block_rows).cast("bigint").alias("block")
    chunk = F.when(F.col("_hot"), F.struct(*order[:-1], block))
    marked = _same_account(rows, hot, "left").withColumn("_chunk", chunk).drop("_hot", "_account")

    needed = _same_account(state, _renamed(accounts.select("account_id")), "left_semi")
    minute = minute_of(F.col("event_time"))
    hot_partials = (
        marked.where(F.col("_chunk").isNotNull())
        .groupBy(F.struct("account_id").alias("_account"), "_chunk", minute.alias("minute"))
        .agg(F.count(F.lit(1)).alias("cnt"), F.sum("amount").cast("decimal(38,4)").alias("amount"))
    )
    number = F.row_number().over(Window.partitionBy("_account").orderBy("_chunk"))
    chunks = hot_partials.select("_account", "_chunk").distinct().withColumn("_index", number)
    numbered = hot_partials.join(chunks, ["_account", "_chunk"])
    of_hot = F.struct("account_id").alias("_account")
    hot_state = needed.select(of_hot, F.lit(0).alias("_index"), "minute", "cnt", "amount").join(
        chunks.select("_account").distinct(), "_account", "left_semi"
    )
    columns = ["_account", "_index", "minute", "cnt", "amount"]
    reach = F.explode(F.array(*[F.col("minute") - back for back in _BACK]))
    before = _before_chunks(
        numbered.select(*columns).unionByName(hot_state.select(*columns)),
        numbered.select("_account", "_index", reach.alias("from")).distinct(),
    )
    columns = ["account_id", "_chunk", "minute", "cnt", F.col("amount").cast("decimal(38,4)").alias("amount")]
    before = before.join(chunks, ["_account", "_index"]).select("_account.account_id", *columns[1:])
    cold = needed.join(chunks.select("_account").distinct(), F.struct("account_id") == F.col("_account"), "left_anti")
    past = cold.withColumn("_chunk", F.lit(None).cast(marked.schema["_chunk"].dataType)).select(*columns)
    past = past.unionByName(before.select(*columns))
    old = past.select(
        "account_id", "_chunk", F.lit(0).alias("_kind"), F.col("minute").alias("_minute"), F.col("cnt").alias("_cnt"),
        *_limbs(F.col("amount")), F.lit(None).cast(rows.schema).alias("_row"),
    )
    new = marked.select(
        "account_id", "_chunk", F.lit(1).alias("_kind"), minute.alias("_minute"), F.lit(1).cast("bigint").alias("_cnt"),
        *_limbs(F.col("amount")), F.struct(*rows.columns).alias("_row"),
    )
    elements = new.unionByName(old).repartition("account_id", "_chunk")
    arrival = [F.col(f"_row.{c}") for c in order]
    elements = elements.sortWithinPartitions("account_id", "_chunk", "_kind", *arrival)
    elements = elements.select(
        F.xxhash64("account_id", F.to_json("_chunk")).alias("_key"), "_kind", "_minute", "_cnt", "_high", "_low", "_row"
    )
    names = [f"_{name}_{label}" for label, _ in VELOCITY_WINDOWS for name in ("n", "high", "low")]
    schema = T.StructType([T.StructField("_row", rows.schema), *(T.StructField(n, T.LongType()) for n in names)])
    found = elements.mapInArrow(window_totals, schema)
    columns = []
    for label, _ in VELOCITY_WINDOWS:
        unscaled = F.col(f"_high_{label}").cast("decimal(25,0)") * F.lit(_LIMB).cast("decimal(13,0)")
        amount = ((unscaled + F.col(f"_low_{label}")).cast("decimal(34,0)") * F.lit("0.0001").cast("decimal(4,4)"))
        columns += [
            as_count(F.col(f"_n_{label}")).alias(f"vel_count_{label}"),
            as_money(amount.cast("decimal(38,4)")).alias(f"vel_amount_{label}"),
        ]
    return found.select("_row.*", *columns)
