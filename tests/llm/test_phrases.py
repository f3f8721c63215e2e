"""Collocations against brute force, and the guarantee of the summaries."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tollgate.llm.phrases import Summary, collocations

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, longest, threshold, limit):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            found = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(found)
            for size in range(1, longest + 1):
                for i in range(len(found) - size + 1):
                    counts.setdefault(lang, Counter())[tuple(found[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= threshold}
        covered = Counter()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    covered[p[i : i + size]] = max(covered[p[i : i + size]], a)
        scored = []
        for p, a in candidates.items():
            if 100 * covered[p] >= 50 * a and covered[p]:
                continue
            cuts = [(10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:limit], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def corpus():
    rng = random.Random(8)
    vocabulary = [f"{a}{b}" for a in ("al", "Bé", "co", "日") for b in ("", "x", "Y", "z")] + ["the"] * 8
    rows = []
    for i in range(160):
        found = []
        for _ in range(rng.randrange(60)):
            found.append(rng.choice(vocabulary))
            found.append(rng.choice([" "] * 9 + ["  ", "\t", " \t ", ". ", ",", "\n", " ! ", "\r\n", "\x0b", "\x00 "]))
            if rng.random() < 0.15:
                found.append("new york city ")
        rows.append(("".join(found), [None, "en", "und", "fr", ""][min(4, i % 7)]))
    return rows + [(None, "en"), ("", None), (" .,\t", "fr"), rows[1], rows[1], ("word " * 5000, "de")]


@pytest.mark.parametrize("longest,threshold,limit", [(3, 10, 2000), (3, 4, 7), (2, 3, 2000), (5, 3, 2000), (1, 2, 10)])
def test_collocations(spark, longest, threshold, limit):
    rows = corpus()
    data = [(1, text, lang, "x", 5) for text, lang in rows]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, phrase string, size int").repartition(5)
    found = sorted(tuple(r) for r in collocations(docs, longest, threshold, limit).collect())
    assert found == brute(rows, longest, threshold, limit)


def test_empty(spark, empty):
    assert collocations(empty).collect() == []


@pytest.mark.parametrize("capacity", [5, 40, 1000])
def test_summary_keeps_what_is_frequent(capacity, monkeypatch):
    """Merged in any order, no counter is too low by more than mass / (capacity + 1), nor too high."""
    rng = np.random.default_rng(capacity)
    truth, summary = Counter(), Summary(capacity)
    for _ in range(60):
        keys, counts = np.unique(rng.zipf(1.4, 400).astype(np.uint32) % 900, return_counts=True)
        truth.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
        summary.add(keys.astype(np.uint32), counts)
        summary.merge()
    mass = sum(truth.values())
    assert len(summary.keys) <= capacity and summary.error <= mass / (capacity + 1)
    kept = dict(zip(summary.keys.tolist(), summary.counts.tolist(), strict=True))
    for key, count in truth.items():
        assert count - summary.error <= kept.get(key, 0) <= count
    threshold = mass // (capacity + 1) + 1
    assert {k for k, c in truth.items() if c >= threshold} <= set(summary.frequent(threshold).tolist())
