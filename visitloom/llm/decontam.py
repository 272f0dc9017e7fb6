"""Benchmark decontamination by q-gram counts in diagonal bands and banded alignment."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitloom.llm.common import Rolling, by_value, small_batches, text_buffer, with_row

GRAM = 8
#: Bytes of benchmark text in one index; more text makes more indexes.
INDEX_BYTES = 8 << 20
#: Places of shared q-grams looked at together.
PLACES = 1 << 21
#: Cells of alignments made together, item by item of the texts beside each other.
CELLS = 1 << 17


@dataclass
class Index:
    """The q-grams of some benchmark items, and each item's edit budget.

    ``keys``: sorted hashes; those of ``keys[i]`` lie at ``first[i]:first[i + 1]`` of ``item`` and ``at``.
    """

    ids: list[int | None]
    texts: list[bytes]
    budget: np.ndarray
    least: np.ndarray
    keys: np.ndarray
    first: np.ndarray
    item: np.ndarray
    at: np.ndarray
    maybe: np.ndarray


def plain(text: str) -> Column:
    """Lower case, with each run of white space as one space."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\s\u00a0]+", " "))


def edit_budget(size: int, rate: float, gram: int = GRAM) -> int:
    """``rate`` of the bytes, rounded down, and so few that a shared q-gram is certain."""
    return max(0, min(int(rate * size), size // gram - 1))


def build_index(items: list[tuple[int | None, bytes]], rate: float) -> Index:
    rolling = Rolling()
    items = [(i, t) for i, t in items if t]
    budget = np.array([edit_budget(len(t), rate) for _, t in items], np.int64)
    # The q-gram lemma: so many of an item's q-grams outlive as many edits as the budget allows.
    least = np.array([len(t) + 1 - GRAM * (e + 1) for (_, t), e in zip(items, budget.tolist())], np.int64)
    hashes, item, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n, (_, text) in enumerate(items):
        grams = rolling.grams(rolling.prefix(np.frombuffer(text, np.uint8)), GRAM)
        hashes.append(grams)
        item.append(np.full(len(grams), n))
        at.append(np.arange(len(grams)))
    hashes, item, at = np.concatenate(hashes), np.concatenate(item), np.concatenate(at)
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    first = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]]) if len(hashes) else np.zeros(0, np.int64)
    maybe = np.zeros(1 << max(16, (8 * len(first)).bit_length()), bool)
    keys = hashes[first]
    maybe[(keys & np.uint64(len(maybe) - 1)).astype(np.int64)] = True
    return Index(
        [i for i, _ in items], [t for _, t in items], budget, least, keys, np.r_[first, len(hashes)].astype(np.int64),
        item[order], at[order], maybe,
    )


@dataclass
class Alignment:
    """An item to align with ``text[begin:end]``, over alignments whose diagonals (place in that text
    minus place in item) are ``low`` to ``low + width``."""

    item: bytes
    begin: int
    end: int
    low: int
    width: int
    budget: int

    @property
    def cells(self) -> int:
        return self.width + len(self.item) + 2


def aligned(text: np.ndarray, wanted: list[Alignment]) -> np.ndarray:
    """Edits from each item to the nearest substring of its text; its budget + 1 if more.

    Items of about one length are aligned together, byte by byte, each in a column of its own.
    """
    edits = np.zeros(len(wanted), np.int64)
    order = sorted(range(len(wanted)), key=lambda n: wanted[n].cells)
    while order:
        # The last needs most cells.
        together = max(1, CELLS // wanted[order[-1]].cells)
        order, some = order[:-together], order[-together:]
        edits[some] = aligned_together(text, [wanted[n] for n in some])
    return edits


def aligned_together(text: np.ndarray, wanted: list[Alignment]) -> np.ndarray:
    size = max(w.width for w in wanted) + 1
    length = np.array([len(w.item) for w in wanted])
    items = np.zeros((length.max(), len(wanted)), np.int16)
    padded = np.full((size + length.max(), len(wanted)), 256, np.int16)
    step = np.arange(size, dtype=np.int32)[:, None]
    low, ends = np.array([w.low for w in wanted]), np.array([w.end - w.begin for w in wanted])
    width, most = np.array([w.width for w in wanted]), np.array([w.budget for w in wanted], np.int32) + 1
    for n, w in enumerate(wanted):
        items[: len(w.item), n] = np.frombuffer(w.item, np.uint8)
        a, b = max(0, w.low), min(w.end - w.begin, w.low + len(padded))
        if b > a:
            padded[a - w.low : b - w.low, n] = text[w.begin + a : w.begin + b]
    # A narrower band ends before the last row: nothing comes from beyond its end.
    least = np.where(step <= width, 0, most)
    # Before the text begins and after it ends nothing can be matched or inserted.
    cost = np.where((step + low >= 0) & (step + low <= ends), least, most)
    column, edits = np.arange(len(wanted)), most.astype(np.int64)
    for i in range(len(items)):
        changed = cost + (padded[i : i + size] != items[i])
        changed[:-1] = np.minimum(changed[:-1], cost[1:] + 1)
        cost = np.minimum.accumulate(changed - step, axis=0) + step
        cost = np.maximum(np.minimum(cost, most), least)
        nearest = cost.min(axis=0)
        done = length == i + 1
        edits[column[done]] = nearest[done]
        left = ~done & (nearest < most)
        if not left.any():
            break
        # Columns that are done change nothing; they go when they are many.
        if 4 * np.count_nonzero(left) < 3 * len(left):
            cost, padded, items, least = (np.ascontiguousarray(x[:, left]) for x in (cost, padded, items, least))
            length, most, column = length[left], most[left], column[left]
    return edits


def banded(index: Index, row: np.ndarray, place: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, ...]:
    """How many shared q-grams lie in each band of diagonals: pair (row and item), band, count.

    Diagonals of one alignment differ by the budget at most: each such range lies in a band of twice
    its width, as neighbouring bands overlap by half.
    """
    times = index.first[key + 1] - index.first[key]
    entry = np.repeat(index.first[key], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    item = index.item[entry]
    band = (np.repeat(place, times) - index.at[entry]) // (index.budget[item] + 1)
    pair = np.repeat(row, times) * np.int64(len(index.ids)) + item
    pair, band, count = counted(pair, band)
    # Each lies in the band before, too. That band is there already, or takes its place in between.
    after = np.r_[(pair[1:] == pair[:-1]) & (band[1:] == band[:-1] + 1), False]
    new = ~np.r_[False, after[:-1]] if len(pair) else after
    both = count + np.where(after, np.r_[count[1:], 0], 0)
    return np.r_[pair, pair[new]], np.r_[band, band[new] - 1], np.r_[both, count[new]]


def counted(pair: np.ndarray, band: np.ndarray) -> tuple[np.ndarray, ...]:
    """How often each pair and band is there, in order."""
    if not len(pair):
        return pair, band, pair
    least = int(band.min())
    span = int(band.max()) - least + 1
    if (int(pair.max()) + 1) * span >= 1 << 63:
        return added(pair, band, np.ones(len(pair), np.int64))
    # One number each sorts much faster than two.
    both = np.sort(pair * np.int64(span) + (band - least))
    new = np.flatnonzero(np.r_[True, both[1:] != both[:-1]])
    return both[new] // span, both[new] % span + least, np.diff(np.r_[new, len(both)])


def added(pair: np.ndarray, band: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """Counts of equal pairs and bands added up."""
    order = np.lexsort((band, pair))
    pair, band, count = pair[order], band[order], count[order]
    new = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (band[1:] != band[:-1])]) if len(pair) else order
    return pair[new], band[new], np.add.reduceat(count, new) if len(new) else count


def likely_bands(index: Index, row: np.ndarray, place: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs and bands with as many shared q-grams as the lemma asks for.

    A few texts at a time, so that no more than about ``PLACES`` places are looked at together; one
    text with more is counted in parts.
    """
    times = index.first[key + 1] - index.first[key]
    total = np.cumsum(times)
    texts = np.flatnonzero(np.r_[True, row[1:] != row[:-1], True]) if len(row) else np.zeros(1, np.int64)
    pairs, bands, begin = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    while begin < len(texts) - 1:
        first = texts[begin]
        before = total[first] - times[first]
        # Whole texts, at least one.
        reach = np.searchsorted(total[texts[1:] - 1], before + PLACES, side="right")
        stop = max(begin + 1, int(reach))
        last, found = texts[stop], []
        while first < last:
            before = total[first] - times[first]
            cut = min(last, max(first + 1, int(np.searchsorted(total, before + PLACES, side="right"))))
            found.append(banded(index, row[first:cut], place[first:cut], key[first:cut]))
            first = cut
        pair, band, count = found[0] if len(found) == 1 else added(*map(np.concatenate, zip(*found)))
        keep = count >= index.least[pair % len(index.ids)]
        pairs.append(pair[keep])
        bands.append(band[keep])
        begin = stop
    return np.concatenate(pairs), np.concatenate(bands)


def find_in_texts(index: Index, column: pa.Array, rolling: Rolling) -> list[tuple[int, int, int]]:
    """Row, item and edits of the items that lie within their budgets in the texts of a column."""
    data, offsets = text_buffer(column)
    grams = rolling.grams(rolling.prefix(data), GRAM)
    hit = np.flatnonzero(index.maybe[(grams & np.uint64(len(index.maybe) - 1)).astype(np.int64)])
    row = np.searchsorted(offsets, hit, side="right") - 1
    inside = hit + GRAM <= offsets[row + 1] if len(hit) else np.zeros(0, bool)
    hit, row = hit[inside], row[inside]
    raw, found = data.tobytes(), []
    if len(hit) and len(index.keys):
        key = np.minimum(np.searchsorted(index.keys, grams[hit]), len(index.keys) - 1)
        true = index.keys[key] == grams[hit]
        hit, row, key = hit[true], row[true], key[true]
        pair, band = likely_bands(index, row, hit - offsets[row], key)
        best: dict[int, int] = {}
        wanted: list[tuple[int, Alignment]] = []
        for p, b in zip(pair.tolist(), band.tolist()):
            r, i = divmod(p, len(index.ids))
            budget = int(index.budget[i])
            if best.get(p, budget + 1) == 0:
                continue
            start, end = int(offsets[r]), int(offsets[r + 1])
            low, wide = b * (budget + 1) - budget, 2 * (budget + 1) + 2 * budget
            a = start + max(0, low)
            # An exact copy needs no alignment.
            if raw.find(index.texts[i], a, min(end, start + max(0, low + wide) + len(index.texts[i]))) >= 0:
                best[p] = 0
                continue
            wanted.append((p, Alignment(index.texts[i], start, end, low, wide, budget)))
        wanted = [(p, w) for p, w in wanted if best.get(p, w.budget + 1) > 0]
        for (p, w), edits in zip(wanted, aligned(data, [w for _, w in wanted]).tolist()):
            if edits <= w.budget:
                best[p] = min(edits, best.get(p, edits))
        found = [(*divmod(p, len(index.ids)), e) for p, e in best.items()]
    for i, text in enumerate(index.texts):
        if len(text) < GRAM:
            found += [
                (r, i, 0)
                for r, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist()))
                if raw.find(text, a, b) >= 0
            ]
    return found


def indexes(benchmark: DataFrame, rate: float) -> list:
    """Indexes of all items, for tasks. Equal texts are one entry, under their least item_id; each
    index holds about 8 MB of text, whatever the size of the benchmark."""
    spark = benchmark.sparkSession
    items = benchmark.select("item_id", plain("text").alias("text")).where("text <> ''")
    items = items.groupBy("text").agg(F.min("item_id").alias("item_id"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = -(-size // INDEX_BYTES)
    chunk = F.pmod(F.xxhash64("text"), F.lit(max(1, chunks)))
    told = []
    for n in range(chunks):
        rows = items.where(chunk == n).orderBy("item_id", "text").collect()
        told.append(by_value(spark, build_index([(r["item_id"], r["text"].encode()) for r in rows], rate)))
    return told


def find_leaks(documents: DataFrame, benchmark: DataFrame, rate: float = 0.1) -> DataFrame:
    """Benchmark items in documents: doc_id, item_id, edits.

    An item is in a document if some substring of the document is at most ``rate`` of the item's
    bytes away in edits (inserted, removed or replaced bytes; fewer for items under 80 bytes, none
    under 16). Both are compared in lower case with single spaces. Shared q-grams of 8 bytes are
    counted in overlapping bands of diagonals; bands that reach what the q-gram lemma asks for are
    aligned. Items of fewer than 8 bytes must lie there exactly; empty and null ones lie nowhere.

    Items with equal texts have a row each. Null texts are empty; null ids stay; repeated documents
    have repeated rows; other columns are dropped; empty tables give no rows.
    """
    texts = documents.select("doc_id", plain("text").alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    found = documents.sparkSession.createDataFrame([], f"doc_id {kind}, head long, edits long")
    for sent in indexes(benchmark, rate):

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            rolling, index = Rolling(), sent()
            for batch in batches:
                for part in small_batches(batch, 2 << 20):
                    rows = find_in_texts(index, part.column(1), rolling)
                    r, i, e = (list(x) for x in zip(*rows)) if rows else ([], [], [])
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0).take(pa.array(r, pa.int64())),
                            pa.array([index.ids[x] for x in i], pa.int64()), pa.array(e, pa.int64()),
                        ],
                        ["doc_id", "head", "edits"],
                    )

        found = found.unionByName(texts.mapInArrow(run, f"doc_id {kind}, head long, edits long"))
    named = benchmark.select("item_id", plain("text").alias("text")).where("text <> ''")
    heads = named.groupBy("text").agg(F.min("item_id").cast("long").alias("head"))
    named = named.join(heads, "text").select("item_id", "head")
    return found.join(named, found["head"].eqNullSafe(named["head"])).select("doc_id", "item_id", "edits")


def without_leaks(documents: DataFrame, benchmark: DataFrame, rate: float = 0.1) -> DataFrame:
    """The documents, with all their columns, in which ``find_leaks`` finds no item. No shuffle.

    A null or empty text has no item, so its row stays; null and repeated ids are rows like others,
    and any other columns of any name stay as they are. An empty benchmark keeps all.
    """
    for sent in indexes(benchmark, rate):

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            rolling, index = Rolling(), sent()
            for batch in batches:
                for part in small_batches(batch, 2 << 20):
                    bad = {r for r, _, _ in find_in_texts(index, part.column(1), rolling)}
                    keep = pa.array([n not in bad for n in range(part.num_rows)], pa.bool_())
                    yield part.select(["row"]).filter(keep)

        compared = with_row(documents, plain("text"))
        documents = compared.mapInArrow(run, compared.select("row").schema).select("row.*")
    return documents
