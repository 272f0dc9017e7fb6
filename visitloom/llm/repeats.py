"""Removal of repeated passages by arrays of longest previous factors over sorted suffixes."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitloom.llm.common import NULL_ID, Rolling, checkpointed, mixed, sliding_min, small_batches, text_buffer

#: Bytes of the anchor that stands for a passage: the one with the least hash among those inside.
ANCHOR = 16
#: Bytes of anchor hashes that travel, beside the bucket, which is of the other bytes. Anchors that
#: agree by chance only bring passages that are looked at in vain.
KEPT = 4
#: Bytes of texts looked at together, and of runs sorted together.
BATCH = 3 << 20
SORTED = 1 << 20
#: Bytes of texts for each bucket of passages, at most.
BUCKET = 16 << 20


def anchors(column: pa.Array, length: int, rolling: Rolling) -> tuple[np.ndarray, ...]:
    """Runs of starts of passages of ``length`` bytes that have the same anchor: row, first start
    in the row, number of starts, anchor hash; and the bytes and row offsets of the column."""
    data, offsets = text_buffer(column)
    empty = np.zeros(0, np.int64)
    least = sliding_min(rolling.grams(rolling.prefix(data), ANCHOR), length - ANCHOR + 1)
    if not len(least):
        return empty, empty, empty, np.zeros(0, np.uint64), data, offsets
    # Whole passages only, none across rows.
    sizes = np.maximum(np.diff(offsets) - length + 1, 0)
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    least = least[offsets[row] + at]
    first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (least[1:] != least[:-1])]) if len(row) else empty
    return row[first], at[first], np.diff(np.r_[first, len(row)]), least[first], data, offsets


def packed(hashes: np.ndarray) -> bytes:
    return np.ascontiguousarray(hashes).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEPT].tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    whole = np.zeros((len(blob) // KEPT, 8), np.uint8)
    whole[:, :KEPT] = np.frombuffer(blob, np.uint8).reshape(-1, KEPT)
    return whole.view("<u8").reshape(-1)


def told_part(hashes: np.ndarray) -> np.ndarray:
    """What ``unpacked(packed(hashes))`` gives."""
    return hashes & np.uint64((1 << 8 * KEPT) - 1)


def squeezed(values: np.ndarray) -> bytes:
    """Whole numbers byte plane by byte plane, compressed."""
    return zlib.compress(values.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def spread(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(blob), np.uint8).reshape(8, -1).T).view("<i8").reshape(-1)


def heads(*columns: np.ndarray) -> np.ndarray:
    """Where a new combination of values begins in sorted columns."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def by_bucket(values: np.ndarray, buckets: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order of the values by bucket, and each bucket with where it begins and ends there."""
    bucket = (mixed(values.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = [*heads(bucket[order]).tolist(), len(order)]
    return order, [(int(bucket[order[a]]), a, b) for a, b in zip(cuts, cuts[1:])]


def table(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def shared_anchors(texts: DataFrame, length: int, buckets: int) -> DataFrame:
    """unit and hashes (packed) of the anchors that at least two of the ``texts`` (unit, text, row) have.

    What a batch of texts shares is known in the batch: such hashes come with each of their owners,
    as known, and go on unsorted. One owner of each hash is sorted among those of other batches.
    """
    names = ["bucket", "known", "ids", "counts", "hashes"]
    kinds = [pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]

    def rows(known: bool, owner: np.ndarray, hashes: np.ndarray) -> list[tuple]:
        order, found = by_bucket(hashes, buckets)
        out = []
        for bucket, a, b in found:
            part = order[a:b]
            part = part[np.argsort(owner[part], kind="stable")]
            ids, counts = np.unique(owner[part], return_counts=True)
            out.append((bucket, known, squeezed(ids), squeezed(counts), packed(hashes[part])))
        return out

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for batch in batches:
            for part in small_batches(batch, BATCH):
                row, _, _, hashes, _, _ = anchors(part.column(1), length, rolling)
                owner = part.column(0).to_numpy()[row]
                order = np.lexsort((owner, hashes))
                hashes, owner = hashes[order], owner[order]
                first = heads(hashes)
                size = np.diff(np.r_[first, len(hashes)])
                known = np.repeat(owner[first] != owner[first + size - 1], size)
                told = heads(hashes, owner)
                told = told[known[told]]
                yield table(rows(True, owner[told], hashes[told]) + rows(False, owner[first], hashes[first]), names, kinds)

    def meet(group: pa.Table) -> pa.Table:
        ids, hashes, known = [], [], []
        for row in group.to_pylist():
            ids.append(np.repeat(spread(row["ids"]), spread(row["counts"])))
            hashes.append(unpacked(row["hashes"]))
            known.append(np.full(len(hashes[-1]), row["known"]))
        ids, hashes, known = np.concatenate(ids), np.concatenate(hashes), np.concatenate(known)
        told_ids, told = ids[known], hashes[known]
        ids, hashes = ids[~known], hashes[~known]
        order = np.lexsort((ids, hashes))
        ids, hashes = ids[order], hashes[order]
        first = heads(hashes)
        size = np.diff(np.r_[first, len(ids)])
        shared = np.repeat(ids[first] != ids[first + size - 1], size)
        ids, hashes = np.r_[told_ids, ids[shared]], np.r_[told, hashes[shared]]
        order = np.argsort(ids, kind="stable")
        ids, blob = ids[order], packed(hashes[order])
        first = heads(ids)
        ends = np.r_[first, len(ids)][1:]
        blobs = [blob[a * KEPT : b * KEPT] for a, b in zip(first, ends)]
        return pa.table({"unit": pa.array(ids[first], pa.int64()), "hashes": pa.array(blobs, pa.binary())})

    sent = texts.select("unit", "text", "row").mapInArrow(send, "bucket long, known boolean, ids binary, counts binary, hashes binary")
    return sent.groupBy("bucket").applyInArrow(meet, "unit long, hashes binary")


def passages(texts: DataFrame, length: int, buckets: int) -> DataFrame:
    """Runs of passages with a shared anchor in ``texts`` (id, unit, text, lists, row), by bucket of the
    anchor: ids, units, starts and sizes (number of starts) of runs, and their texts one after the
    other. Without texts (null) come the runs that are known to go: a text of a smaller id in the
    same batch has an equal one.
    """
    names = ["bucket", "ids", "units", "starts", "sizes", "bodies"]
    kinds = [pa.int64(), *[pa.binary()] * 5]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, squeeze = Rolling(), zstandard.ZstdCompressor(3)
        for batch in batches:
            for part in small_batches(batch, BATCH):
                ids, units = part.column(0).to_numpy(), part.column(1).to_numpy()
                row, at, size, hashes, data, offsets = anchors(part.column(2), length, rolling)
                lists = [np.unique(np.concatenate([unpacked(x) for x in some])) for some in part.column(3).to_pylist()]
                cuts = np.searchsorted(row, np.arange(len(lists) + 1))
                keep = np.concatenate(
                    [np.isin(told_part(hashes[a:b]), own) for a, b, own in zip(cuts, cuts[1:], lists)] or [np.zeros(0, bool)]
                )
                row, at, size, hashes = row[keep], at[keep], size[keep], hashes[keep]
                start = offsets[row] + at
                raw, out = data.tobytes(), []
                body = numbered(raw, start, start + size + length - 1, {})
                order = np.lexsort((ids[row], body))
                first = heads(body[order])
                least = np.repeat(ids[row[order[first]]], np.diff(np.r_[first, len(order)]))
                known = np.zeros(len(order), bool)
                known[order] = least < ids[row[order]]
                for is_known in (True, False):
                    some = np.flatnonzero(known == is_known)
                    order, found = by_bucket(hashes[some], buckets)
                    for bucket, a, b in found:
                        own = some[order[a:b]]
                        bodies = None
                        if not is_known:
                            ends = (start[own] + size[own] + length - 1).tolist()
                            bodies = squeeze.compress(b"".join([raw[i:j] for i, j in zip(start[own].tolist(), ends)]))
                        numbers = (ids[row[own]], units[row[own]], at[own], size[own])
                        out.append((bucket, *map(squeezed, numbers), bodies))
                yield table(out, names, kinds)

    schema = "bucket long, ids binary, units binary, starts binary, sizes binary, bodies binary"
    return texts.select("id", "unit", "text", "lists", "row").mapInArrow(run, schema)


def ranks(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(np.uint64)


def sorted_suffixes(data: np.ndarray, starts: np.ndarray, order: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of ``data`` that begin at ``starts``, sorted by their first ``length`` bytes, those
    that agree in them by ``order``; and in how many of these bytes each agrees with the one before it.

    Ranks of 8 bytes are doubled up to the depth. Read from the deepest down, the same ranks tell where
    neighbours part.
    """
    data = np.r_[data, np.zeros(length + 16, np.uint8)]
    n, depth = len(data) - 8, 8
    words = np.lib.stride_tricks.sliding_window_view(data, 8)[:n].copy().view(">u8").reshape(-1).astype(np.uint64)
    levels = [(depth, ranks(words))]
    while depth * 2 < length:
        rank = levels[-1][1]
        levels.append((depth * 2, ranks(rank[: n - depth] * np.uint64(n + 1) + rank[depth:n])))
        n, depth = n - depth, depth * 2
    rank = levels[-1][1]
    rank = ranks(rank[starts] * np.uint64(n + 1) + rank[starts + (length - depth)])
    suffixes = np.lexsort((order, rank))
    agreed = np.zeros(len(suffixes), np.int64)
    parts = np.flatnonzero(rank[suffixes[1:]] != rank[suffixes[:-1]]) + 1
    agreed[1:] = length
    a, b = starts[suffixes[parts - 1]], starts[suffixes[parts]]
    done = np.zeros(len(parts), np.int64)
    for depth, rank in reversed(levels):
        done += depth * (rank[a + done] == rank[b + done])
    differ = words[a + done] ^ words[b + done]
    for zeros in range(8, 64, 8):
        done += differ < np.uint64(1 << (64 - zeros))
    agreed[parts] = done
    return suffixes, agreed


def previous_smaller(order: np.ndarray, agreed: np.ndarray, least: int) -> np.ndarray:
    """In how many bytes each sorted suffix agrees with the nearest one before it of a smaller
    ``order``; 0 where these are fewer than ``least`` (at least 1).

    Each suffix looks at the one before it; if that is not smaller, then at what that one looks at, for
    all between are not smaller either. Suffixes of one text in a row halve their way each time.
    """
    agreed, seen = agreed.copy(), np.arange(len(order)) - 1
    going = np.flatnonzero(agreed >= least)
    while len(going := going[order[seen[going]] >= order[going]]):
        via = seen[going]
        seen[going], agreed[going] = seen[via], np.minimum(agreed[going], agreed[via])
        going = going[agreed[going] >= least]
    return np.where(agreed >= least, agreed, 0)


def longest_previous_factors(
    data: np.ndarray, starts: np.ndarray, order: np.ndarray, length: int, least: int = 1
) -> np.ndarray:
    """For each suffix of ``data`` that begins at ``starts``, its longest previous factor: the most
    bytes, up to ``length``, in which it agrees with a suffix of smaller ``order``.

    Of all suffixes of smaller order, the nearest before and the nearest after it in suffix order
    agree the longest. Factors of fewer than ``least`` bytes count as 0 and are not followed.
    """
    suffixes, agreed = sorted_suffixes(data, starts, order, length)
    own = order[suffixes]
    before = previous_smaller(own, agreed, least)
    after = previous_smaller(own[::-1], np.r_[agreed[:1], agreed[:0:-1]], least)[::-1]
    factors = np.zeros(len(starts), np.int64)
    factors[suffixes] = np.maximum(before, after)
    return factors


def run_anchors(bodies: np.ndarray, sizes: np.ndarray, length: int, rolling: Rolling) -> np.ndarray:
    """Anchor of each run, from their texts one after the other."""
    bounds = np.cumsum(sizes + length - 1) - (sizes + length - 1)
    return sliding_min(rolling.grams(rolling.prefix(bodies), ANCHOR), length - ANCHOR + 1)[bounds]


def numbered(raw: bytes, starts: np.ndarray, ends: np.ndarray, known: dict[bytes, int]) -> np.ndarray:
    """The numbers of raw[start:end], equal for equal bytes; ``known`` keeps them."""
    spans = zip(starts.tolist(), ends.tolist())
    return np.fromiter((known.setdefault(raw[a:b], len(known)) for a, b in spans), np.int64, len(starts))


def earlier_runs(
    bodies: np.ndarray, sizes: np.ndarray, ids: np.ndarray, anchor: np.ndarray, same: np.ndarray, length: int
) -> tuple[np.ndarray, ...]:
    """Which starts of which runs go: number of the run, first and last start.

    ``bodies``: the texts of all runs, one after the other; ``sizes``: their numbers of starts;
    ``same``: equal for equal texts. Equal texts are looked at once, with their least id; the others
    with one anchor are sorted together.
    """
    bounds = np.r_[0, np.cumsum(sizes + length - 1)]
    order = np.lexsort((ids, same, anchor))
    first = heads(same[order])
    number = np.diff(np.r_[first, len(order)])
    lead = order[first]
    low = np.empty(len(ids), np.int64)
    low[order] = np.repeat(ids[lead], number)
    later = ids > low
    runs, begins, stops = [np.flatnonzero(later)], [np.zeros(later.sum(), np.int64)], [sizes[later] - 1]
    # Of the first ones, some starts may be in other texts of a smaller id.
    weight = np.cumsum(sizes[lead] + length - 1)
    part, cuts, base = heads(anchor[lead]).tolist() + [len(lead)], [0], 0
    for a, b in zip(part, part[1:]):
        if weight[b - 1] - base > SORTED:
            cuts.append(b)
            base = weight[b - 1]
    if cuts[-1] != len(lead):
        cuts.append(len(lead))
    group = np.repeat(np.arange(len(lead)), number)
    alike = {}
    for a, b in zip(cuts, cuts[1:]):
        some = lead[a:b]
        spans = (sizes + length - 1)[some]
        begin = np.cumsum(spans) - spans
        take = np.repeat(bounds[some] - begin, spans) + np.arange(spans.sum())
        owner = np.repeat(np.arange(len(some)), sizes[some])
        at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes[some]) - sizes[some], sizes[some])
        found = longest_previous_factors(bodies[take], begin[owner] + at, ids[some][owner], length, length) == length
        edge = found & ~np.r_[False, found[:-1] & (owner[1:] == owner[:-1])]
        stop = found & ~np.r_[found[1:] & (owner[1:] == owner[:-1]), False]
        for n, x, y in zip((owner[edge] + a).tolist(), at[edge].tolist(), at[stop].tolist()):
            alike.setdefault(n, []).append((x, y))
    rest = order[~later[order]]
    for r, n in zip(rest.tolist(), group[~later[order]].tolist()):
        for x, y in alike.get(n, ()):
            runs.append(np.array([r]))
            begins.append(np.array([x]))
            stops.append(np.array([y]))
    return np.concatenate(runs), np.concatenate(begins), np.concatenate(stops)


def removed_spans(runs: DataFrame, length: int) -> DataFrame:
    """unit and spans (begin and end of bytes that go; packed) from what ``passages`` deals out."""

    def find(group: pa.Table) -> pa.Table:
        told: list[tuple[np.ndarray, ...]] = []
        ids, units, starts, sizes, bodies, anchor, same = ([] for _ in range(7))
        rolling, unsqueeze, known = Rolling(), zstandard.ZstdDecompressor(), {}
        for row in group.to_pylist():
            i, u, at, n = (spread(row[c]) for c in ("ids", "units", "starts", "sizes"))
            if row["bodies"] is None:
                told.append((u, at, at + n - 1 + length))
                continue
            for kept, values in ((ids, i), (units, u), (starts, at), (sizes, n)):
                kept.append(values)
            raw = unsqueeze.decompress(row["bodies"])
            bodies.append(np.frombuffer(raw, np.uint8))
            anchor.append(run_anchors(bodies[-1], n, length, rolling))
            ends = np.cumsum(n + length - 1)
            same.append(numbered(raw, ends - (n + length - 1), ends, known))
        if ids:
            i, u, at, n = map(np.concatenate, (ids, units, starts, sizes))
            known.clear()
            run, a, b = earlier_runs(np.concatenate(bodies), n, i, np.concatenate(anchor), np.concatenate(same), length)
            told.append((u[run], at[run] + a, at[run] + b + length))
        u, a, b = (np.concatenate(c) for c in zip(*told))
        order = np.lexsort((a, u))
        u, spans = u[order], np.stack([a[order], b[order]], axis=1)
        first = heads(u)
        ends = np.r_[first, len(u)][1:]
        blobs = [squeezed(spans[x:y].T.reshape(-1)) for x, y in zip(first, ends)]
        return pa.table({"unit": pa.array(u[first], pa.int64()), "spans": pa.array(blobs, pa.binary())})

    return runs.groupBy("bucket").applyInArrow(find, "unit long, spans binary")


def whole_characters(raw: bytes, begin: int, end: int) -> tuple[int, int]:
    """The span, moved outwards to where characters of UTF-8 begin."""
    while 0 < begin < len(raw) and raw[begin] & 0xC0 == 0x80:
        begin -= 1
    while end < len(raw) and raw[end] & 0xC0 == 0x80:
        end += 1
    return begin, end


def remove_repeats(documents: DataFrame, length: int = 50) -> DataFrame:
    """What is left of every text: doc_id, n_bytes, n_removed, n_spans, kept (bytes).

    A byte goes if a string of ``length`` bytes that covers it also starts in a document with a
    smaller doc_id; matches lie within documents and are judged on the whole input. n_spans: maximal
    removed runs.

    Copies of a whole text go without a look at their bytes. Each passage of ``length`` bytes has an
    anchor, its 16 bytes of least hash; only passages whose anchor another text has are looked at.
    They are dealt out by anchor, as runs of neighbours, each different run once with its least id.
    Longest previous factors then show which passages a text of a smaller id has. They are cut at
    ``length``: a longer factor covers the same bytes as those of the starts that follow.

    A null text is empty; a text of fewer bytes stays whole. A null doc_id is larger than all others;
    documents of one doc_id take nothing from each other; other columns are dropped.
    """
    left = _left(documents.select("doc_id", "text"), length, whole=False)
    doc_id = F.when(F.col("id") != NULL_ID, F.col("id")).alias("doc_id")
    return left.select(doc_id, "n_bytes", "n_removed", "n_spans", "kept")


def without_repeats(documents: DataFrame, length: int = 50) -> DataFrame:
    """The documents, a row for each with all its columns, without what ``remove_repeats`` removes.

    Characters of which a byte goes, go whole.
    """
    left = _left(documents, length, whole=True)
    columns = [F.col("kept").cast("string").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in documents.columns]
    return left.select(*columns)


def _left(documents: DataFrame, length: int, whole: bool) -> DataFrame:
    """id (doc_id, or NULL_ID), row (other columns than text) and what is left of every text."""
    docs = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"), F.coalesce("text", F.lit("")).alias("text"),
        F.struct(*(c for c in documents.columns if c != "text")).alias("row"),
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))
    short = F.octet_length("text") < length
    named = docs.select(
        "id", "row", "digest", F.octet_length("text").cast("long").alias("n_bytes"),
        F.when(short, F.col("text")).alias("short"),
    )
    first = named.groupBy("digest").agg(F.min("id").alias("low"))
    named = checkpointed(named.join(first, "digest"))
    copies = named.where((F.col("id") > F.col("low")) | (F.col("n_bytes") < length))
    done = copies.select(
        "id", "row", "n_bytes",
        F.when(F.col("n_bytes") < length, 0).otherwise(F.col("n_bytes")).cast("long").alias("n_removed"),
        (F.col("n_bytes") >= length).cast("long").alias("n_spans"),
        F.coalesce("short", F.lit("")).cast("binary").alias("kept"),
    )
    # Each text has a number of its own, also where several have one id or none.
    standing = named.where((F.col("id") == F.col("low")) & (F.col("n_bytes") >= length)).select("id", "digest", "n_bytes").distinct()
    standing = checkpointed(standing.withColumn("unit", F.monotonically_increasing_id()))
    n_bytes = standing.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(4 * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_bytes // BUCKET)
    standing = standing.drop("n_bytes")
    # The texts move once, by id and digest; each use reads the same shuffle, as long as it takes the
    # same columns of it. What is found out about a text goes there, so no task holds all texts of one id.
    key = ["id", "digest"]
    texts = docs.join(standing, key)

    def told(found: DataFrame, column: str, name: str) -> DataFrame:
        return found.join(standing, "unit").groupBy(*key).agg(F.collect_list(column).alias(name))

    lists = told(shared_anchors(texts, length, buckets), "hashes", "lists")
    spans = told(removed_spans(passages(texts.join(lists, key), length, buckets), length), "spans", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, blobs in zip(*(c.to_pylist() for c in batch.columns[2:])):
                raw, kept, at, n, removed = text.encode(), [], 0, 0, 0
                found = np.concatenate([spread(x).reshape(2, -1).T for x in blobs] if blobs else [np.zeros((0, 2), np.int64)])
                for a, b in sorted(map(tuple, found.tolist())):
                    if whole:
                        a, b = whole_characters(raw, a, b)
                    if a > at or not n:
                        kept.append(raw[at:a])
                        n, removed, at = n + 1, removed + b - a, b
                    elif b > at:
                        removed, at = removed + b - at, b
                kept.append(raw[at:])
                out.append((len(raw), removed, n, b"".join(kept)))
            names = ["n_bytes", "n_removed", "n_spans", "kept"]
            counted = table(out, names, [pa.int64()] * 3 + [pa.binary()])
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *counted.columns], ["id", "row", *names])

    cut_texts = texts.join(spans, key, "left").select("id", "row", "text", "spans")
    kinds = T.StructType([cut_texts.schema["id"], cut_texts.schema["row"]])
    for name in ("n_bytes", "n_removed", "n_spans"):
        kinds = kinds.add(name, T.LongType())
    return cut_texts.mapInArrow(cut, kinds.add("kept", T.BinaryType())).unionByName(done)
