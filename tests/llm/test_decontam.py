"""Decontamination against brute force."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest

from visitloom.llm import decontam

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def plain(text):
    return " ".join((text or "").lower().split())


def distance(item, text):
    """Edits from the item to the nearest substring, by the full table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        last, row = row, [i] + [0] * len(text)
        for j, d in enumerate(text, 1):
            row[j] = min(last[j - 1] + (c != d), last[j] + 1, row[j - 1] + 1)
    return min(row)


def brute(docs, items, rate=0.1):
    out = []
    for item_id, item in items:
        item = plain(item).encode()
        for doc_id, text in docs:
            edits = distance(item, plain(text).encode()) if item else 1
            if edits <= decontam.edit_budget(len(item), rate):
                out.append((doc_id, item_id, edits))
    return sorted(out, key=str)


def got(spark, docs, items, rate=0.1):
    found = decontam.find_leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), rate)
    return sorted(map(tuple, found.collect()), key=str)


def spoiled(rng, text, edits):
    text = list(text)
    for _ in range(edits):
        at = rng.randrange(len(text))
        kind = rng.random()
        if kind < 0.3:
            del text[at]
        elif kind < 0.6:
            text.insert(at, rng.choice("abc "))
        else:
            text[at] = rng.choice("xyz")
    return "".join(text)


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8))) for _ in range(40)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, say(rng.randint(2, 30))) for i in range(12)]
    docs = []
    for i in range(40):
        item = rng.choice(items)[1]
        size = len(plain(item).encode())
        part = spoiled(rng, item, rng.choice([0, 1, int(0.08 * size), int(0.12 * size)]))
        docs.append((i, say(rng.randint(0, 25)) + rng.choice([" ", "\n", ""]) + part.upper() + say(rng.randint(0, 25))))
    assert got(spark, docs, items) == brute(docs, items)


def test_odd_rows(spark):
    items = [(1, None), (2, ""), (3, "short"), (None, "an item that has no number"), (5, "two rows  of one text"), (6, "Two rows of one text"), (7, "exact sixteen by")]
    docs = [(1, None), (2, ""), (None, "x short y"), (4, "an item\nthat HAS no number!"), (4, "an item that has no numbers"), (6, "two rows of one text")] + [
        (8, "pad " * 4000 + "two rows of one test" + " pad" * 4000)
    ]
    assert got(spark, docs, items) == sorted(brute(docs[:-1], items) + [(8, 5, 1), (8, 6, 1)], key=str)


def test_without_leaks_keeps_rows_and_columns(spark):
    docs = spark.createDataFrame([(1, "clean text of a document", 7), (2, "it has a leaked item inside", 8), (None, None, 9)], DOCS + ", compared long")
    items = spark.createDataFrame([(1, "a leaked item")], ITEMS)
    left = decontam.without_leaks(docs, items)
    assert left.columns == docs.columns and sorted(r["compared"] for r in left.collect()) == [7, 9]


def test_empty_tables(spark):
    assert got(spark, [], [(1, "item of a benchmark")]) == []
    assert got(spark, [(1, "text")], []) == []


def test_several_indexes(spark, monkeypatch):
    monkeypatch.setattr(decontam, "INDEX_BYTES", 60)
    items = [(i, f"benchmark item number {i} of a few") for i in range(9)]
    docs = [(i, f"before benchmark item number {i} of a few after") for i in range(0, 18, 2)]
    assert got(spark, docs, items) == brute(docs, items)


def wanted_alignments(seed, n):
    """Items of many lengths, spoiled inside a text, and bands around where they lie or beside it."""
    rng = random.Random(seed)
    text, wanted, told = "", [], []
    for _ in range(n):
        item = "".join(rng.choice("abcd ") for _ in range(rng.randint(8, 120)))
        budget = decontam.edit_budget(len(item), 0.1)
        doc = "".join(rng.choice("abcd ") for _ in range(rng.randint(0, 30)))
        low = len(doc) - budget + rng.choice([0, 0, 0, rng.randint(-40, 40)])
        doc += spoiled(rng, item, rng.randint(0, budget + 2)) + "tail" * rng.randint(0, 3)
        told.append((item, doc, budget, low))
        wanted.append(decontam.Alignment(item.encode(), len(text), len(text) + len(doc), low, 2 * budget, budget))
        text += doc
    return np.frombuffer(text.encode(), np.uint8), wanted, told


def in_band(item, text, low, width, budget):
    """Edits to the nearest substring over alignments within the band, cell by cell."""
    far = budget + 1
    row = {p: 0 if 0 <= p <= len(text) else far for p in range(low, low + width + 1)}
    for i, c in enumerate(item):
        last, row = row, {}
        for p in range(low + i + 1, low + i + width + 2):
            same = 0 <= p - 1 < len(text) and text[p - 1] == c
            row[p] = min(last[p - 1] + (not same), last.get(p, far) + 1, row.get(p - 1, far) + 1, far)
    return min(row.values())


def test_alignments_together_equal_single_ones(monkeypatch):
    text, wanted, told = wanted_alignments(5, 400)
    right = [in_band(item, doc, low, 2 * budget, budget) for item, doc, budget, low in told]
    assert decontam.aligned(text, wanted).tolist() == right
    assert min(right) == 0 and sum(e <= w.budget for e, w in zip(right, wanted)) > 100
    monkeypatch.setattr(decontam, "CELLS", 300)
    assert decontam.aligned(text, wanted).tolist() == right
    assert decontam.aligned(text, []).tolist() == []


def test_many_alignments_cost_far_less_than_one_by_one():
    text, wanted, _ = wanted_alignments(6, 2000)
    begin = time.process_time()
    decontam.aligned(text, wanted)
    together = time.process_time() - begin
    begin = time.process_time()
    for w in wanted:
        decontam.aligned(text, [w])
    assert together < (time.process_time() - begin) / 3


@pytest.mark.parametrize("far", [0, 1 << 60])
def test_counts_of_bands_equal_plain_ones(far):
    """Also where pair and band do not fit one number together."""
    items = [(1, b"abcdefghij" * 12), (2, b"bcdefghijk" * 3), (3, b"klm")]
    index = decontam.build_index(items, 0.1)
    key, times = np.arange(len(index.keys)).repeat(3), np.diff(index.first)
    rng = np.random.default_rng(1)
    row, place = np.sort(rng.integers(0, 4, len(key))), rng.integers(0, 200, len(key)) * np.int64(1 + far // 200)
    counts = {}
    for r, p, k in zip(row.tolist(), place.tolist(), key.tolist()):
        for e in range(index.first[k], index.first[k] + times[k]):
            item = int(index.item[e])
            band = (p - int(index.at[e])) // (int(index.budget[item]) + 1)
            for b in (band, band - 1):
                counts[r * 3 + item, b] = counts.get((r * 3 + item, b), 0) + 1
    found = decontam.banded(index, row, place, key)
    assert len(found[0]) == len(counts)
    assert {(p, b): n for p, b, n in zip(*(x.tolist() for x in found))} == counts
