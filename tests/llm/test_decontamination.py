"""Decontamination against brute force over windows of words."""

import hashlib
import re

import pytest

from tollgate.llm.decontamination import contaminated

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string, window int, document int"


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def brute(docs, items, window, shingle, percent):
    windows = []
    for item, text in items:
        found = split(text)
        size = min(len(found), window)
        if size:
            windows += [(item, found[i : i + size]) for i in range(len(found) - size + 1)]
    out = []
    for doc_id, text in docs:
        found, hit, ids = split(text), set(), set()
        for item, one in windows:
            size, short = len(one), min(shingle, len(one))
            for start in range(len(found) - size + 1):
                here = found[start : start + size]
                count = size - short + 1
                same = sum(here[i : i + short] == one[i : i + short] for i in range(count))
                if 100 * same >= percent * count:
                    hit |= set(range(start, start + size))
                    ids |= {str(item)} if item is not None else set()
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc_id, len(found), len(hit), len(ids), digest, len(hit) > 0))
    return sorted(out, key=str)


@pytest.mark.parametrize("window,shingle,percent", [(10, 4, 100), (10, 4, 60), (6, 1, 80), (10, 12, 100), (3, 2, 100)])
def test_contaminated(spark, documents, texts, window, shingle, percent):
    passage = split(texts[10])[30:100]
    changed = [*passage[5:25]]
    changed[3] = "other"
    items = [
        (1, " ".join(passage[:14])),
        (2, "...".join(passage[2:30]).upper()),
        (2, "one Two"),
        (10, " ".join(passage[2:30])),
        (3, None),
        (4, " -- "),
        (None, " ".join(split(texts[6])[:20])),
        (5, " ".join(changed)),
        (6, "日本語"),
        (7, "one, TWO three!"),
        (8, "words that no document holds at all, not one of them in such a row"),
        (9, " ".join(split(texts[13])[:30])),
    ]
    benchmark = spark.createDataFrame([(*one, 1, 2) for one in items], ITEMS).repartition(3)
    docs = [(r.doc_id, r.text) for r in documents.collect() if len(r.text or "") < 50_000]
    few = documents.where("text is null or length(text) < 50000")
    found = contaminated(few, benchmark, window, shingle, percent).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(docs, items, window, shingle, percent)


def test_hot_passage(spark):
    """A third of all documents hold one passage that many equal items hold too."""
    passage = " ".join(f"w{i}" for i in range(25))
    docs = [(None if i % 2 else i, passage + f" tail {i}" if i % 3 == 0 else f"clean {i} text") for i in range(600)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(i, passage) for i in range(50)], "item_id long, text string")
    found = contaminated(frame, items).collect()
    assert sorted((r.n_hit, r.n_items) for r in found) == [(0, 0)] * 400 + [(25, 50)] * 200


def test_empty(spark, empty, documents):
    none = spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "one two three", 1, 1)], ITEMS)
    assert contaminated(empty, some).collect() == []
    assert {r.contaminated for r in contaminated(documents, none).collect()} == {False}
