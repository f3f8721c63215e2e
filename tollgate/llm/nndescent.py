"""Approximate nearest neighbours: a graph by NN-descent, answered by greedy search on it."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import Store, finite

DEGREE = 20
#: Reverse neighbours that take part at a node, as NN-descent samples them.
REVERSE = 20
#: Random partitions that the graph starts from, and rows of one block of them, about.
TABLES = 8
BLOCK_ROWS = 1000
#: The descent ends when a round renews at most this share of all edges.
CONVERGED = 0.001
BEAM = 400
EXPANDED = 32
SEED = 3

EDGES = "node long, other long, sim float"
FOUND = "query_id long, beam array<struct<sim: float, id: long, done: boolean>>, seen array<long>"


def rows_of(lists: pa.Array) -> tuple[np.ndarray, list[np.ndarray], list[pa.Array]]:
    """Borders of a column of lists of structs, and the structs' fields, flattened."""
    borders = np.concatenate(([0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())))
    rows = lists.flatten()
    return borders, rows.flatten()


def vectors_of(units: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(one, np.float32) for one in units.to_pylist()]


def edges(nodes: np.ndarray, others: np.ndarray, sims: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(nodes), pa.array(others), pa.array(sims.astype(np.float32))]
    return pa.RecordBatch.from_arrays(columns, names=["node", "other", "sim"])


def top(sims: np.ndarray, count: int) -> np.ndarray:
    """Positions of the largest entries of each row, in no order."""
    count = min(count, sims.shape[1])
    return np.argpartition(-sims, count - 1, axis=1)[:, :count]


def unit(vector: Column, length: Column) -> Column:
    return F.transform(vector, lambda x: (x.cast("double") / length).cast("float"))


def pack_units(batches):
    """Rows (id, unit array) with the components as bytes."""
    for batch in batches:
        lists = batch.column(1)
        borders = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float32)
        packed = [values[a:b].tobytes() for a, b in zip(borders[:-1], borders[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["id", "unit"])


def codes(bits: int, tables: int):
    """The side of each random hyperplane on which a vector lies, one code a table; lengths stay apart."""

    def run(batches):
        for batch in batches:
            ids, units = batch.column(0), vectors_of(batch.column(1))
            sizes = np.array([len(one) for one in units], np.int64)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                rows = np.stack([units[i] for i in at])
                planes = np.random.default_rng([SEED, int(size)]).standard_normal((tables, int(size), max(bits, 1)))
                for number in range(tables):
                    sides = (rows @ planes[number].astype(np.float32) > 0)[:, :bits]
                    code = (sides * (1 << np.arange(bits, dtype=np.int64))).sum(axis=1)
                    part = pa.array(at)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(at), number, np.int32)),
                            pa.array(np.full(len(at), size, np.int32)),
                            pa.array(code.astype(np.int64)),
                            ids.take(part),
                            batch.column(1).take(part),
                        ],
                        names=["number", "size", "code", "id", "unit"],
                    )

    return run


def within_blocks(degree: int):
    """The best neighbours of each vector inside its block."""

    def run(batches):
        for batch in batches:
            borders, (ids, units) = rows_of(batch.column(0))
            ids, units = ids.to_numpy(), vectors_of(units)
            for a, b in zip(borders[:-1], borders[1:], strict=True):
                if b - a < 2:
                    continue
                rows = np.stack(units[a:b])
                sims = rows @ rows.T
                np.fill_diagonal(sims, -np.inf)
                best = top(sims, min(degree, b - a - 1))
                nodes = np.repeat(ids[a:b], best.shape[1])
                yield edges(nodes, ids[a:b][best].ravel(), np.take_along_axis(sims, best, 1).ravel())

    return run


def compared(batches):
    """Edges of rows (node, unit, other, other_unit)."""
    for batch in batches:
        nodes, others = (batch.column(i).to_numpy() for i in (0, 2))
        pairs = zip(vectors_of(batch.column(1)), vectors_of(batch.column(3)), strict=True)
        yield edges(nodes, others, np.array([a @ b for a, b in pairs], np.float32))


def random_edges(units: DataFrame, graph: DataFrame, degree: int) -> DataFrame:
    """Edges for nodes with fewer than `degree`, to the nodes of a random group of about 4 * degree.

    Vectors of one length are dealt over groups by hash; with few of them there is one group. So every
    node has `degree` neighbours, or all there are, whatever blocks it stood in.
    """
    sized = units.withColumn("size", F.length("unit"))
    groups = sized.groupBy("size").agg(F.ceil(F.count("*") / (4 * degree)).alias("groups"))
    dealt = sized.join(groups, "size").withColumn("group", F.pmod(F.xxhash64("id", F.lit(SEED)), F.col("groups")))
    counts = graph.groupBy("node").count().withColumnRenamed("node", "id")
    short = dealt.join(counts, "id", "left").where(F.coalesce("count", F.lit(0)) < degree)
    short = short.select(F.col("id").alias("node"), "unit", "size", "group")
    others = dealt.select(F.col("id").alias("other"), F.col("unit").alias("other_unit"), "size", "group")
    pairs = short.join(others, ["size", "group"]).where("node <> other")
    return pairs.select("node", "unit", "other", "other_unit").mapInArrow(compared, EDGES)


def local_joins(offers: int):
    """At each node, compare its neighbours with one another: each hears of the best it does not have.

    A pair of two old neighbours has been compared in an earlier round.
    """

    def run(batches):
        for batch in batches:
            borders, (ids, units, worst, fresh) = rows_of(batch.column(0))
            ids, units = ids.to_numpy(), vectors_of(units)
            worst, fresh = worst.to_numpy(), fresh.to_numpy(zero_copy_only=False)
            out = []
            for a, b in zip(borders[:-1], borders[1:], strict=True):
                own, first = np.unique(ids[a:b], return_index=True)
                first += a
                if len(own) < 2 or not fresh[first].any():
                    continue
                rows = np.stack([units[i] for i in first])
                sims = rows @ rows.T
                sims[~(fresh[first][:, None] | fresh[first][None, :])] = -np.inf
                np.fill_diagonal(sims, -np.inf)
                best = top(sims, offers)
                values = np.take_along_axis(sims, best, 1)
                better = values > worst[first][:, None]
                out.append((np.repeat(own, better.sum(axis=1)), own[best][better], values[better]))
            if out:
                yield edges(*(np.concatenate(parts) for parts in zip(*out, strict=True)))

    return run


def best_edges(rows: DataFrame, degree: int) -> DataFrame:
    """Each node's best distinct neighbours; tasks and exchange keep no more than they need."""
    once = rows.groupBy("node", "other").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    order = Window.partitionBy("node").orderBy(F.desc("sim"), "other")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= degree).drop("rank")


def around(graph: DataFrame, reverse: int) -> DataFrame:
    """(node, other, fresh): forward neighbours, and the `reverse` most similar reverse ones."""
    order = Window.partitionBy("node").orderBy(F.desc("sim"), "other")
    back = graph.select(F.col("other").alias("node"), F.col("node").alias("other"), "sim", "fresh")
    back = back.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= reverse)
    return graph.select("node", "other", "fresh").unionByName(back.select("node", "other", "fresh"))


def neighbour_graph(
    store: Store,
    units: DataFrame,
    degree: int = DEGREE,
    reverse: int = REVERSE,
    tables: int = TABLES,
    block_rows: int = BLOCK_ROWS,
    converged: float = CONVERGED,
) -> DataFrame:
    """NN-descent over rows (id, unit): edges (node, other, sim, fresh), `degree` a node.

    Random hyperplanes cut the rows into blocks of about block_rows; a larger block is divided by
    hash, so none is unbounded. Best neighbours inside the blocks of all tables are the first graph;
    a node that finds fewer than `degree` there gets random ones besides.
    Each round joins every node's forward and reverse neighbours with their vectors, compares new
    ones with all others at that node, and keeps each vector's best. Rounds follow until at most the
    share `converged` of all edges is fresh, however many that takes. A vector is offered the best
    `degree` of one node's neighbours: more could not stay.
    """
    count = units.count()
    bits = max(0, math.ceil(math.log2(max(1, count / block_rows))))
    coded = units.mapInArrow(codes(bits, tables), "number int, size int, code long, id long, unit binary")
    coded = store.keep(coded, "codes")
    key = ["number", "size", "code"]
    large = coded.groupBy(*key).count().select(*key, F.ceil(F.col("count") / (2 * block_rows)).alias("parts"))
    salted = coded.join(large, key).withColumn("part", F.pmod(F.xxhash64("id", "number"), F.col("parts")))
    blocks = salted.groupBy(*key, "part").agg(F.collect_list(F.struct("id", "unit")).alias("rows"))
    first = blocks.select("rows").mapInArrow(within_blocks(degree), EDGES).withColumn("fresh", F.lit(True))
    first = store.keep(best_edges(first, degree), "graph")
    filled = random_edges(units, first, degree).withColumn("fresh", F.lit(True))
    graph = store.keep(best_edges(first.unionByName(filled), degree), "graph")
    store.drop(coded, first)
    while graph.agg(F.avg(F.col("fresh").cast("double")).alias("share")).where(F.col("share") > converged).count():
        worst = graph.groupBy("node").agg(
            F.when(F.count("*") >= degree, F.min("sim")).otherwise(F.lit(-2.0)).cast("float").alias("worst")
        )
        known = units.join(worst.withColumnRenamed("node", "id"), "id", "left")
        known = known.select(F.col("id").alias("other"), "unit", F.coalesce("worst", F.lit(-2.0).cast("float")).alias("worst"))
        member = F.struct(F.col("other").alias("id"), "unit", "worst", "fresh")
        joined = around(graph, reverse).join(known, "other")
        joined = joined.groupBy("node").agg(F.collect_list(member).alias("rows"))
        news = joined.select("rows").mapInArrow(local_joins(degree), EDGES).withColumn("fresh", F.lit(True))
        old = graph.withColumn("fresh", F.lit(False))
        better = store.keep(best_edges(old.unionByName(news), degree), "graph")
        store.drop(graph)
        graph = better
    return graph


def search_step(beam_size: int, expanded: int):
    """Rows (query_id, unit, beam, seen, found) to the next beam: the best of old and newly found.

    done marks nodes whose neighbours have been looked at; each step looks at the best that have not.
    """

    def run(batches):
        for batch in batches:
            columns = [column.to_pylist() for column in batch.columns]
            queries, beams, seens = [], [], []
            for query, vector, beam, seen, found in zip(*columns, strict=True):
                vector = np.frombuffer(vector, np.float32)
                old, fresh = set(seen), {}
                for one in found or []:
                    if one["id"] not in old:
                        fresh[one["id"]] = np.frombuffer(one["unit"], np.float32)
                if fresh:
                    sims = np.stack(list(fresh.values())) @ vector
                    beam = beam + [{"sim": float(s), "id": i, "done": False} for i, s in zip(fresh, sims, strict=True)]
                beam.sort(key=lambda one: (-one["sim"], one["id"]))
                queries.append(query)
                beams.append(beam[:beam_size])
                seens.append(seen + list(fresh))
            kind = pa.list_(pa.struct([("sim", pa.float32()), ("id", pa.int64()), ("done", pa.bool_())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(beams, kind), pa.array(seens, pa.list_(pa.int64()))],
                names=["query_id", "beam", "seen"],
            )

    return run


def greedy_search(
    store: Store, units: DataFrame, graph: DataFrame, starts: DataFrame, reverse: int, beam: int, expanded: int
) -> DataFrame:
    """(query_id, id): for each row (query_id, unit) of starts the beam in which the search ends.

    query_id is itself a node. Steps are joins of the beams' next nodes with their neighbours and
    those with their vectors, until every node of every beam has been looked at.
    """
    sides = store.keep(around(graph, 2 * reverse).select("node", "other").distinct(), "sides")
    own = F.struct(F.lit(1.0).cast("float").alias("sim"), F.col("query_id").alias("id"), F.lit(False).alias("done"))
    state = starts.select("query_id", F.array(own).alias("beam"), F.array("query_id").alias("seen"))
    state, finished = store.keep(state, "beams"), store.path("searched")
    while True:
        state.where(~F.exists("beam", lambda one: ~one.done)).select("query_id", "beam").write.mode("append").parquet(finished)
        going = state.where(F.exists("beam", lambda one: ~one.done))
        if going.isEmpty():
            break
        ahead = F.slice(F.filter("beam", lambda one: ~one.done), 1, expanded).alias("ahead")
        looked = going.select("query_id", "seen", "beam", ahead)
        marked = F.transform(
            "beam",
            lambda one: F.struct(
                one.sim.alias("sim"), one.id.alias("id"), (one.done | F.array_contains("ahead.id", one.id)).alias("done")
            ),
        )
        nodes = looked.select("query_id", F.explode("ahead.id").alias("node"))
        found = nodes.join(sides, "node").select("query_id", F.col("other").alias("id")).distinct()
        found = found.join(units, "id").groupBy("query_id").agg(F.collect_list(F.struct("id", "unit")).alias("found"))
        rows = looked.select("query_id", marked.alias("beam"), "seen").join(starts, "query_id").join(found, "query_id", "left")
        rows = rows.select("query_id", "unit", "beam", "seen", "found")
        following = store.keep(rows.mapInArrow(search_step(beam, expanded), FOUND), "beams")
        store.drop(state)
        state = following
    store.drop(state, sides)
    searched = store.spark.read.schema("query_id long, beam array<struct<sim: float, id: long, done: boolean>>")
    return searched.parquet(finished).select("query_id", F.explode("beam.id").alias("id"))


def dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda total, z: total + z)


def nearest(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = 5,
    query_every: int = 50,
    degree: int = DEGREE,
    reverse: int = REVERSE,
    beam: int = BEAM,
    expanded: int = EXPANDED,
    tables: int = TABLES,
    block_rows: int = BLOCK_ROWS,
    converged: float = CONVERGED,
) -> DataFrame:
    """Each query's k nearest rows found by largest cosine: query_id, rank, vec_id, score.

    Queries are the rows whose id is divisible by query_every; every other row is a candidate. Equal
    vectors make one node of the graph, with their k + 1 smallest ids: no more can be among the k
    nearest. All nodes are in the index; no row is left out of it. The search starts at the query's
    own node. Beams are scored again in double precision on the original vectors.

    Rows without id, and vectors that are null, zero, or hold null or non-finite components, take no
    part; other columns are not read. Vectors of different lengths have no cosine. Rows that share an
    id are one another's own rows and one node, which stands in the graph with one of their vectors;
    each pair keeps its best score.
    Ties go to the smaller id; with fewer candidates all that are found come out. No rows give no rows.
    """
    store = Store(vectors.sparkSession, "nearest")
    wide = F.transform(vector_column, lambda x: x.cast("double"))
    rows = vectors.where(F.col(id_column).isNotNull() & finite(F.col(vector_column)))
    rows = rows.select(F.col(id_column).cast("long").alias("vec_id"), wide.alias("vector"))
    rows = rows.withColumn("norm", F.sqrt(dot(F.col("vector"), F.col("vector")))).where("norm > 0")
    rows = store.keep(rows, "vectors")
    order = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1)
    nodes = few.groupBy("vector", "norm").agg(F.min("vec_id").alias("id"), F.collect_list("vec_id").alias("members"))
    # vectors that share an id share a node: the graph holds one of them, and all are scored
    nodes = store.keep(nodes.withColumn("size", F.size("vector")), "nodes")
    units = nodes.select("id", unit(F.col("vector"), F.col("norm")).alias("unit"))
    units = store.keep(units.mapInArrow(pack_units, "id long, unit binary").dropDuplicates(["id"]), "units")
    degree = max(degree, k)  # so that no query ends with fewer than k
    graph = neighbour_graph(store, units, degree, reverse, tables, block_rows, converged)

    asked = rows.where(F.col("vec_id") % query_every == 0)
    named = asked.join(nodes.select("id", "vector"), "vector").select("vec_id", "id", "vector", "norm")
    starts = named.select(F.col("id").alias("query_id")).distinct()
    starts = store.keep(starts.join(units.withColumnRenamed("id", "query_id"), "query_id"), "starts")
    ends = greedy_search(store, units, graph, starts, reverse, beam, expanded)
    ends = ends.withColumnRenamed("query_id", "at")

    query = named.select(
        F.col("id").alias("at"), F.col("vec_id").alias("query_id"), F.col("vector").alias("x"), F.col("norm").alias("x_norm")
    )
    scored = query.join(ends, "at").join(nodes, "id").where(F.size("x") == F.col("size"))
    score = dot(F.col("x"), F.col("vector")) / (F.col("x_norm") * F.col("norm"))
    scored = scored.select("query_id", score.alias("score"), F.explode("members").alias("vec_id"))
    scored = scored.where("vec_id <> query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    scored = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return scored.select("query_id", "rank", "vec_id", "score")
