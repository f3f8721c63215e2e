"""Token ids in binary files: frequency ranks in whole bytes, with the byte counts in control bytes."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgate.llm.common import Store, small_batches, text_steps
from tollgate.llm.tokens import encoder

#: A file is a row of blocks, each with a line feed after it. A block is this head, the documents'
#: ids (8 bytes), whether each id is null (1 byte), the documents' token counts (8 bytes), control
#: bytes and data bytes; all little-endian.
MAGIC = b"RANK"
HEAD = struct.Struct("<4sQQQ")  # magic, documents, tokens, data bytes
#: Tokens of a file and of a block, about.
FILE_TOKENS = 4_000_000
BLOCK_TOKENS = 1_000_000

#: Bytes of each of the four numbers that one control byte describes, lowest two bits first.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes, two bits a number, and data bytes: each number's low bytes, as many as it needs."""
    ranks = ranks.astype("<u4")
    more = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[: len(ranks)] = more
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    used = np.arange(4) <= more[:, None]
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack_ranks(control: np.ndarray, data: np.ndarray, count: int) -> np.ndarray:
    """The numbers again: a table gives the lengths of each control byte's four numbers."""
    lengths = LENGTHS[control].reshape(-1)[:count]
    ends = np.cumsum(lengths)
    starts = ends - lengths
    ranks = data[starts].astype(np.int64)
    for byte in range(1, int(lengths.max(initial=1))):
        has = np.flatnonzero(lengths > byte)
        ranks[has] |= data[starts[has] + byte].astype(np.int64) << (8 * byte)
    return ranks


def block(doc_ids: list, counts: np.ndarray, ranks: np.ndarray) -> bytes:
    control, data = pack_ranks(ranks)
    null = np.array([one is None for one in doc_ids], np.uint8)
    ids = np.array([one or 0 for one in doc_ids], "<i8")
    head = HEAD.pack(MAGIC, len(ids), len(ranks), len(data))
    return b"".join((head, ids.tobytes(), null.tobytes(), counts.astype("<i8").tobytes(), control, data))


def read_blocks(content: bytes):
    """Each block of a file: document ids, token counts and ranks."""
    at = 0
    while at < len(content):
        magic, docs, tokens, size = HEAD.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError("not a block of token ranks")
        at += HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(content, kind, count, at)
            at += found.nbytes
            return found

        ids, null, counts = take("<i8", docs), take("u1", docs), take("<i8", docs)
        control, data = take("u1", -(-tokens // 4)), take("u1", size)
        at += 1  # the line feed
        doc_ids = [None if no else int(one) for one, no in zip(ids, null, strict=True)]
        yield doc_ids, counts, unpack_ranks(control, data, tokens)


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    file_tokens: int = FILE_TOKENS,
    block_tokens: int = BLOCK_TOKENS,
) -> None:
    """Encode whole texts, with end_id after each, and write path/ids and path/vocabulary.

    path/ids holds files in ascending doc_id order, by the number in the name and inside; path/vocabulary gives
    the id of every rank, most frequent first, ties by id. Texts are tokenised once, into a table in
    the shared folder; ids are counted over it in the tasks and added up, at most one number per id
    of the vocabulary. Rows are dealt once, by ranges of doc_id.

    tokenizer is a path valid on every machine. A null text is an empty one: end_id alone. Null ids
    come first; rows with a repeated id are documents of their own, next to one another. Other
    columns are not read. No rows write no blocks.
    """
    spark = docs.sparkSession
    store = Store(spark, "tokens")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    largest = max(encoder(tokenizer).tokenizer.get_vocab().values(), default=0)
    kind = np.dtype("<u2" if max(largest, end_id) <= 0xFFFF else "<u4")

    def encode(batches):
        coder, last = encoder(tokenizer), np.array([end_id], kind).tobytes()
        for part, data, borders in text_steps(batches, "text"):
            ids, ends = coder.encode(data, borders)
            raw, ends = ids.astype(kind).tobytes(), ends * kind.itemsize
            texts = [raw[a:b] + last for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(texts, pa.binary())], names=["doc_id", "ids"]
            )

    def count(batches):
        totals = np.zeros(0, np.int64)
        for batch in batches:
            seen = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind), minlength=len(totals))
            seen[: len(totals)] += totals
            totals = seen
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])], names=["id", "n"])

    with small_batches(spark):
        encoded = store.keep(rows.mapInArrow(encode, "doc_id long, ids binary"), "ids")
        counted = encoded.select("ids").mapInArrow(count, "id long, n long")
        totals = counted.groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    ordered_ids = totals.sort_values(["n", "id"], ascending=[False, True])["id"].to_numpy()
    vocabulary = [(rank, int(one)) for rank, one in enumerate(ordered_ids)]
    spark.createDataFrame(vocabulary, "rank long, id long").coalesce(1).write.parquet(f"{path}/vocabulary")
    rank_of = np.zeros(int(ordered_ids.max(initial=0)) + 1, np.uint32)
    rank_of[ordered_ids] = np.arange(len(ordered_ids))
    shared = spark.sparkContext.broadcast(rank_of)

    def write(batches):
        doc_ids, lists, waiting = [], [], 0

        def ready():
            counts = np.array([len(one) for one in lists])
            ranks = shared.value[np.concatenate(lists)]
            return pa.RecordBatch.from_arrays(
                [pa.array([block(doc_ids, counts, ranks)], pa.binary())], names=["block"]
            )

        for batch in batches:
            for one, row in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                doc_ids.append(one)
                lists.append(np.frombuffer(row.as_buffer(), kind))
                waiting += len(lists[-1])
                if waiting >= block_tokens:
                    yield ready()
                    doc_ids, lists, waiting = [], [], 0
        if lists:
            yield ready()

    files = max(1, round(int(totals["n"].sum()) / file_tokens))
    dealt = encoded.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id")
    blocks = dealt.mapInArrow(write, "block binary")
    with small_batches(spark):
        blocks.select(F.col("block").cast("string").alias("value")).write.text(f"{path}/ids")
    store.drop(encoded)


def file_number(path: Column) -> Column:
    """Place of a file among the files of a table, from its name; names alone do not sort beyond 100,000."""
    return F.regexp_extract(path, r"part-(\d+)[^/]*$", 1).cast("long")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Read the files back: per document doc_id, start, n_tokens and ids_crc32, in any order.

    start counts the ids of all documents before it. Each file is decoded in one task; the files'
    totals are added up over one row per file.
    """
    store = Store(spark, "tokens-read")
    known = spark.read.parquet(f"{path}/vocabulary").toPandas()
    id_of = np.zeros(len(known), "<u4")
    id_of[known["rank"].to_numpy()] = known["id"].to_numpy()
    shared = spark.sparkContext.broadcast(id_of)

    def decode(batches):
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                before = 0
                for doc_ids, counts, ranks in read_blocks(content.as_buffer()):
                    ids = shared.value[ranks]
                    ends = np.cumsum(counts)
                    crcs = [zlib.crc32(ids[b - n : b].tobytes()) for b, n in zip(ends, counts, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([file] * len(doc_ids), pa.int64()),
                            pa.array(doc_ids, pa.int64()),
                            pa.array(before + ends - counts),
                            pa.array(counts),
                            pa.array(crcs, pa.int64()),
                        ],
                        names=["file", "doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                    before += int(ends[-1])

    files = spark.read.format("binaryFile").load(f"{path}/ids").select(file_number(F.col("path")), "content")
    schema = "file long, doc_id long, start long, n_tokens long, ids_crc32 long"
    with small_batches(spark):  # a file or two at a time
        decoded = store.keep(files.mapInArrow(decode, schema), "docs")
    totals = decoded.groupBy("file").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    start = (F.col("start") + F.col("base")).alias("start")
    return decoded.join(bases, "file").select("doc_id", start, "n_tokens", "ids_crc32")
