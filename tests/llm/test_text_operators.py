"""Operators on documents against brute force, over awkward texts and empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tollgate.llm import superminhash, tokens
from tollgate.llm.common import Store, setting
from tollgate.llm.components import components
from tollgate.llm.language import identify, learn
from tollgate.llm.mixing import mix, targets
from tollgate.llm.packing import best_fit, pack
from tollgate.llm.sharding import shard
from tollgate.llm.substrings import remove_repeats
from tollgate.llm.suffixes import passage_spans, remove_passages
from tollgate.llm.superminhash import near_duplicates, signatures
from tollgate.llm.tokenfiles import file_number, pack_ranks, read_token_files, unpack_ranks, write_token_files
from tollgate.llm.tokens import Chunks, Encoder
from tollgate.session import fresh_path

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def low(doc_id):
    return -(2**63) if doc_id is None else doc_id


def shingles(text, size):
    found = split((text or "").translate(FOLD))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1)))


@pytest.mark.parametrize("size", [1, 4, 5])
def test_near_duplicates(documents, size):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    sets = [(i, shingles(text, size)) for i, text in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x in sets:
        for b, y in sets:
            if None not in (a, b) and x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    want = [(i, len(x), find(i) if i is not None else None, i is None or find(i) == i) for i, x in sets]
    found = near_duplicates(documents, shingle=size).collect()
    assert Counter(map(tuple, found)) == Counter(want)


def test_near_duplicates_of_a_large_group(spark):
    # a ring in which only neighbours are similar: a pivot links few, later rounds find the rest
    text = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(text[8 * i : 8 * i + 100])) for i in range(37)]
    rows += [(100 + i, " ".join([*text[:60], f"x{i}", f"y{i}", *text[62:100]])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: shingles(t, 5) for i, t in rows}
    root = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root[a], root[b]
                root = {i: min(x, y) if r in (x, y) else r for i, r in root.items()}
    found = {r.doc_id: r.component_id for r in near_duplicates(docs).collect()}
    assert found == root


def test_near_duplicates_of_a_common_passage(spark, monkeypatch):
    """Documents with a long passage in common, too little for links, are not compared in pairs; near copies link."""
    rng = random.Random(11)

    def words(count):
        return [f"w{rng.randrange(10**6)}" for _ in range(count)]

    passage, docs = words(160), []
    for i in range(150):
        own = words(rng.choice([28, 30, 40, 55]))
        docs.append(own[: len(own) // 2] + passage + own[len(own) // 2 :])
        if i % 10 == 0:
            near = [*docs[-1]]
            near[rng.randrange(len(near))] = "changed"
            docs.append(near)
    compared, confirm = [], superminhash.confirmed

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return confirm(pairs, *rest)

    monkeypatch.setattr(superminhash, "confirmed", counted)
    rows = spark.createDataFrame([(i, " ".join(text)) for i, text in enumerate(docs)], "doc_id long, text string")
    found = {row.doc_id: row.component_id for row in near_duplicates(rows).collect()}
    sets = [{tuple(text[i : i + 5]) for i in range(len(text) - 4)} for text in docs]
    expected = list(range(len(docs)))
    for b in range(len(docs)):
        for a in range(b):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = sorted((expected[a], expected[b]), reverse=True)
                expected = [new if one == old else one for one in expected]
    assert found == dict(enumerate(expected))
    assert 15 <= len(docs) - len(set(expected)) < 30
    assert sum(compared[1:]) < len(docs)


def test_rounds_of_near_duplicates_write_few_files(spark, monkeypatch):
    """Tables of a round have files by their size, not one for each partition."""
    files, keep = [], Store.keep

    def counted(store, df, name, *rest, **options):
        kept = keep(store, df, name, *rest, **options)
        if name in ("classes", "entries"):
            files.append(len(kept.inputFiles()))
        return kept

    monkeypatch.setattr(Store, "keep", counted)
    text = [f"w{i}" for i in range(1100)]
    rows = [(i, " ".join(text[8 * i : 8 * i + 100])) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    most = 2 * spark.sparkContext.defaultParallelism
    with (
        setting(spark, "spark.sql.shuffle.partitions", str(most + 24)),
        setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"),
    ):
        found = near_duplicates(docs).collect()
    assert {row.component_id for row in found} == {0}
    assert files[0] > 4 and max(files) <= most


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    shared, one, two = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (300, 100, 100))
    a, b = np.concatenate((shared, one)), np.concatenate((shared, two))
    rows = np.repeat([0, 1, 2], [400, 400, 3])
    found = signatures(np.concatenate((a, b, a[:3])), rows, 3, 256)
    assert not np.isinf(found).any()
    assert abs((found[0] == found[1]).mean() - 300 / 500) < 0.1
    again = signatures(a[::-1].copy(), np.zeros(400, np.int64), 1, 256)
    assert (again[0] == found[0]).all()  # order does not matter, nor which rows stop when


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 40)] + [(3, 3), (500, 400), (400, 500)]
    rows = spark.createDataFrame(edges, "node long, root long").repartition(7)
    found = {r.node: r.root for r in components(Store(spark, "test"), rows).collect()}
    assert found == {i: 100 for i in range(101, 161)} | {i: 7 for i in range(8, 40)} | {500: 400}


def test_passages(documents):
    rows = sorted(((low(r.doc_id), r.doc_id, r.text) for r in documents.collect()), key=lambda r: r[0])
    seen, spans, texts = {}, Counter(), Counter()
    first = {}
    for key, _, text in rows:
        found = split(text)
        for start in range(len(found) - 49):
            first.setdefault(tuple(found[start : start + 50]), (key, start))
    for key, doc_id, text in rows:
        found = split(text)
        gone = [False] * len(found)
        for start in range(len(found) - 49):
            if first[tuple(found[start : start + 50])] < (key, start):
                gone[start : start + 50] = [True] * 50
        texts[(doc_id, " ".join(w for w, g in zip(found, gone) if not g))] += 1
        edges = [i for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1])]
        for start in edges:
            end = next((i for i in range(start, len(gone)) if not gone[i]), len(gone))
            spans[(doc_id, start, end - start, len(found))] += 1
    assert spans and not seen
    found = Counter(map(tuple, passage_spans(documents).collect()))
    assert found == spans
    cut = remove_passages(documents, columns=("lang", "size"))
    assert cut.columns == ["doc_id", "text", "lang", "size", "n_removed"]
    kept = cut.collect()
    assert Counter((r.doc_id, " ".join(split(r.text))) for r in kept) == texts
    assert any(r.text is None for r in kept)


@pytest.mark.parametrize("window", [20, 3])
def test_substrings(documents, window):
    rows = [(low(r.doc_id), r.doc_id, r.text) for r in documents.collect()]
    first = {}
    for key, _, text in sorted(rows, key=lambda r: r[0]):
        found = split(text)
        for start in range(len(found) - window + 1):
            run = tuple(found[start : start + window])
            first[run] = min(first.get(run, (key, start)), (key, start))
    want = Counter()
    for key, doc_id, text in rows:
        found = split(text)
        gone = [False] * len(found)
        for start in range(len(found) - window + 1):
            if first[tuple(found[start : start + window])] < (key, start):
                gone[start : start + window] = [True] * window
        kept = " ".join(w for w, g in zip(found, gone) if not g)
        want[(doc_id, kept, len(found), sum(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    assert Counter(map(tuple, remove_repeats(documents, window=window).collect())) == want


def token_ids(documents, name, end_id):
    coder = Tokenizer.from_file(public_tokenizers.path(name))
    rows = sorted(documents.collect(), key=lambda r: (low(r.doc_id), r.text or ""))
    return [(r.doc_id, np.array([*coder.encode(r.text or "", add_special_tokens=False).ids, end_id], "<u4")) for r in rows]


def test_packing(documents):
    want = Counter()
    for doc_id, ids in token_ids(documents, "word_bpe_49k.json", 0):
        for piece, start in enumerate(range(0, len(ids), 2048)):
            own = ids[start : start + 2048]
            want[(doc_id, piece, start, len(own), zlib.crc32(own.tobytes()))] += 1
    rows = pack(documents, public_tokenizers.path("word_bpe_49k.json"), passed_up=3, fan_in=2).collect()
    assert Counter(tuple(r)[:5] for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048


def test_best_fit_fills_bins():
    sizes = np.random.default_rng(2).integers(1, 900, 5000)
    chosen = best_fit(sizes, 1000)
    fills = np.bincount(chosen, weights=sizes)
    assert fills.max() <= 1000 and len(fills) <= 1.01 * math.ceil(sizes.sum() / 1000)


def test_token_files(spark, documents):
    path = fresh_path(spark, "test")
    write_token_files(documents, path, public_tokenizers.path("byte_bpe_50k.json"), file_tokens=20_000, block_tokens=900)
    want, start = Counter(), 0
    found = read_token_files(spark, path).collect()
    for doc_id, ids in token_ids(documents, "byte_bpe_50k.json", 2):
        want[(low(doc_id), len(ids), zlib.crc32(ids.tobytes()))] += 1
        start += len(ids)
    assert Counter((low(r.doc_id), r.n_tokens, r.ids_crc32) for r in found) == want
    end = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == end
        end += r.n_tokens
    assert end == start and [low(r.doc_id) for r in sorted(found, key=lambda r: r.start)] == sorted(low(r.doc_id) for r in found)
    assert spark.read.format("binaryFile").load(f"{path}/ids").count() > 1


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("kept_bytes", [0, 20_000, 64_000_000])
def test_encoder_on_random_texts(name, kept_bytes):
    """Runs of mixed scripts, marks, combining characters and special tokens, as the library encodes them."""
    rng = random.Random(kept_bytes)
    coder = Encoder(public_tokenizers.path(name))
    coder.chunks = Chunks(kept_bytes)
    pool = [*"abcXYZ  \n\t.,!'’éñß漢字Ω𝔘12_<|>\u0301\u00a0\u200d", "<|endoftext|>", "[MASK]", " the"]
    pool += [chr(rng.randrange(0x20, 0xD800)) for _ in range(40)]
    for _ in range(20):
        texts = ["".join(rng.choices(pool, k=rng.choice([0, 1, 5, 60, 400]))) for _ in range(20)]
        raw = [text.encode() for text in texts]
        borders = np.concatenate(([0], np.cumsum([len(one) for one in raw])))
        ids, ends = coder.encode(np.frombuffer(b"".join(raw), np.uint8), borders)
        want = [coder.tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
        assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == want


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_bytes_of_chunks_go_to_the_model(name):
    """Chunks are taken as bytes, letters and marks without a string for each; ids as the library gives them."""
    coder = Encoder(public_tokenizers.path(name))
    texts = [" word", "Word", " Éñß", "ÿ", "...", " ?!", "'", " don't", "×", " a÷", "漢", "\u00a0", " ", "\n ", "  a", "A1", "e\u0301"]
    want = [coder.tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert coder.chunk_ids([text.encode() for text in texts]) == want
    assert [coder.chunk_ids([text.encode()])[0] for text in texts] == want


def test_chunks_met_again_stay_at_the_bound():
    """Rare chunks fill the store again and again; the frequent ones between them go to the model twice at most."""
    coder = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    coder.chunks = Chunks(40_000)
    seen, chunk_ids = Counter(), coder.chunk_ids

    def counted(chunks):
        seen.update(chunks)
        return chunk_ids(chunks)

    coder.chunk_ids = counted
    frequent = [f" {a}{b}qu" for a in "abcdefghij" for b in "lmnop"]
    rng, taken = random.Random(3), []
    for _ in range(40):
        rare = [" " + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=12)) for _ in range(150)]
        text = "".join(frequent + rare)
        ids, _ = coder.encode(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
        assert ids.tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids
        taken.append(coder.chunks.taken())
    assert sum(b < a for a, b in zip(taken, taken[1:], strict=False)) > 3
    assert max(seen[one.encode()] for one in frequent) <= 2


def test_chunks_of_equal_hash_keep_their_own_ids(monkeypatch):
    monkeypatch.setattr(tokens, "run_hashes", lambda data, starts, ends: np.full(len(starts), 7, np.uint64))
    coder = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("the words of one text", "of other words", "the the one", "words"):
        ids, _ = coder.encode(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
        assert ids.tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


def test_more_than_100_000_token_files_are_in_order(spark):
    name = F.format_string("file:/a/part-7/ids/part-%05d-0aa1-part-99-c000.txt", "id")
    rows = spark.range(99_990, 100_020).withColumn("path", name)
    assert rows.where(file_number(F.col("path")) != F.col("id")).count() == 0
    assert rows.orderBy("path").first().id == 100_000  # as names they are not


def test_rank_coding_round_trip():
    ranks = np.array([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1, 7])
    control, data = pack_ranks(ranks)
    assert len(control) == 3 and len(data) == 1 + 1 + 2 + 2 + 3 + 3 + 4 + 4 + 1
    assert (unpack_ranks(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), 9) == ranks).all()


@pytest.mark.parametrize("shards", [3, 40])
def test_sharding(documents, shards):
    rows = shard(documents, shards=shards, range_rows=2).collect()
    want = Counter((r.doc_id, r.text, len((r.text or "").encode()) + 16) for r in documents.collect())
    assert Counter((r.doc_id, r.text, r.size) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert set(slots) <= set(range(shards))


def test_sharding_divides_a_group_of_copies(spark):
    rows = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("copy " * 10)).otherwise(F.repeat(F.col("id").cast("string"), 10)).alias("text")
    )
    found = shard(rows, shards=8).groupBy("shard").agg(F.sum("size").alias("size")).collect()
    sizes = [r["size"] for r in found]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 0.01 * max(sizes) + 132


def water_level(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, capped = {}, set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        total = sum(weight[s] for s in order if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else left * weight[s] / total for s in order}
        above = {s for s in order if target[s] > 3 * sizes[s] * (1 + 1e-12)}
        if not above:
            return target
        capped |= above


@pytest.mark.parametrize(
    "sizes", [{"a": 10, "b": 10, None: 1}, {"a": 1, "b": 1, "c": 1000, "d": 5}, {"x": 0, "y": 7}, {"é": 3, "z": 900, "Z": 1}]
)
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    found = {r.source: r.target for r in targets(rows).collect()}
    assert found == pytest.approx(water_level(sizes))


def test_mixing(spark, documents):
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 60, 900).tolist()
    rows = [(i, "w " * n, ["a", "b", None, "c"][min(i % 9, 3)]) for i, n in enumerate(counts)]
    for docs, near in ((spark.createDataFrame(rows, "doc_id long, text string, source string"), True), (documents, False)):
        found = mix(docs, fan_in=8).collect()
        assert Counter((r.doc_id, r.source, r.size) for r in found) == Counter(
            (r.doc_id, r.source, len(split(r.text))) for r in docs.collect()
        )
        size, taken, target = Counter(), Counter(), {}
        for r in found:
            assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
            size[r.source] += r.size
            taken[r.source] += r.taken
            target[r.source] = r.target
        assert target == pytest.approx(water_level(dict(size)))
        assert all(r.source_size == size[r.source] for r in found)
        if near:
            assert all(abs(taken[s] - target[s]) <= 60 for s in target)
        again = mix(docs.repartition(5), fan_in=8).collect()
        assert Counter(map(tuple, again)) == Counter(map(tuple, found))


def test_language(spark, documents):
    rows = [(i, t, l) for i, (t, l) in enumerate([("the house and the river", "en"), ("der Fluss und das Haus", "de")] * 20)]
    model = learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    docs = spark.createDataFrame(
        [(1, "and the house"), (2, "das Haus"), (3, None), (4, ""), (5, "12 %"), (6, "DER FLUSS" * 5000)], "doc_id long, text string"
    )
    found = {r.doc_id: (r.lang_pred, r.score) for r in identify(docs, model).collect()}
    assert [found[i][0] for i in range(1, 7)] == ["en", "de", "und", "und", "und", "de"]
    assert all(0 <= score <= 1 for _, score in found.values()) and found[3][1] == 0
    awkward = identify(documents, learn(documents), keep=("doc_id", "text", "size")).collect()
    assert len(awkward) == documents.count()
    for r in awkward:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))


def test_empty_tables(spark, empty):
    assert near_duplicates(empty).collect() == []
    assert passage_spans(empty).collect() == []
    assert remove_passages(empty).collect() == []
    assert remove_repeats(empty).collect() == []
    assert pack(empty, public_tokenizers.path("word_bpe_49k.json")).collect() == []
    assert shard(empty).collect() == []
    assert mix(empty).collect() == []
    assert identify(empty, learn(empty)).collect() == []
    path = fresh_path(spark, "test")
    write_token_files(empty, path, public_tokenizers.path("byte_bpe_50k.json"))
    assert read_token_files(spark, path).collect() == []


def test_token_files_pass_small_batches_to_python(spark, monkeypatch):
    """A batch of 64 MB, in the JVM and again in Python, is too much beside the tokenizer."""
    seen, keep = [], Store.keep

    def noted(self, df, name, *partition_by):
        seen.append((name, spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")))
        return keep(self, df, name, *partition_by)

    monkeypatch.setattr(Store, "keep", noted)
    path = fresh_path(spark, "token-files")
    write_token_files(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), path, public_tokenizers.path("byte_bpe_50k.json"))
    assert len(read_token_files(spark, path).collect()) == 1
    assert dict(seen) == {"ids": "8m", "docs": "8m"}
