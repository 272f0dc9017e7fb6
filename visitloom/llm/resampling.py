"""Importance resampling towards a target distribution, over hashed word features."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitloom.llm.common import checkpointed, small_batches
from visitloom.llm.words import Words, folding, words_of

#: Columns of a matrix of bytes; longer features are rows of several such blocks.
BLOCK = 64
#: Bytes of texts looked at together.
BATCH = 4 << 20


def crc_table() -> np.ndarray:
    """The register after each byte, from an empty register (reflected polynomial of CRC-32)."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


def advance(register: np.ndarray, matrix: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The registers of all rows of bytes, updated column by column."""
    for column in range(matrix.shape[1]):
        register = table[(register ^ matrix[:, column]) & 0xFF] ^ (register >> 8)
    return register


def shift_tables(table: np.ndarray) -> np.ndarray:
    """By byte of a register: what that byte becomes when ``BLOCK`` zero bytes follow."""
    single = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).reshape(-1)
    return advance(single, np.zeros((len(single), BLOCK), np.uint8), table).reshape(4, 256)


def crc32_of(letters: np.ndarray, cuts: np.ndarray, table: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """CRC-32 of each ``letters[cuts[i]:cuts[i + 1]]``.

    Strings of equal length are the rows of one matrix of bytes, whose columns update all registers
    at once. Strings of more than ``BLOCK`` bytes are grouped by their number of blocks: zero bytes in
    front leave an empty register as it is, and the preset register is folded into the first bytes.
    """
    sizes = np.diff(cuts)
    blocks = -(-sizes // BLOCK)
    shape = np.where(sizes <= BLOCK, sizes, blocks * BLOCK)
    order = np.argsort(shape, kind="stable")
    out = np.zeros(len(sizes), np.uint32)
    bounds = np.flatnonzero(np.r_[True, shape[order][1:] != shape[order][:-1], True]) if len(order) else []
    for a, b in zip(bounds[:-1], bounds[1:]):
        some = order[a:b]
        width = int(shape[some[0]])
        if width <= BLOCK:
            matrix = letters[cuts[some][:, None] + np.arange(width)]
            out[some] = advance(np.full(len(some), 0xFFFFFFFF, np.uint32), matrix, table)
            continue
        matrix = np.zeros((len(some), width), np.uint8)
        for n, i in enumerate(some.tolist()):
            begin = width - int(sizes[i])
            matrix[n, begin:] = letters[cuts[i] : cuts[i + 1]]
            matrix[n, begin : begin + 4] ^= 0xFF
        parts = matrix.reshape(-1, BLOCK)
        parts = advance(np.zeros(len(parts), np.uint32), parts, table).reshape(len(some), -1)
        register = np.zeros(len(some), np.uint32)
        for column in range(parts.shape[1]):
            register = np.bitwise_xor.reduce([shifts[k][(register >> (8 * k)) & 0xFF] for k in range(4)]) ^ parts[:, column]
        out[some] = register
    return out ^ np.uint32(0xFFFFFFFF)


class Features:
    """Buckets of the features of texts: runs of ``least`` to ``most`` consecutive words."""

    def __init__(self, least: int, most: int, buckets: int) -> None:
        self.widths = range(least, most + 1)
        self.buckets = buckets
        self.folding, self.table = folding(), crc_table()
        self.shifts = shift_tables(self.table)

    def _distinct(self, letters: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Each feature's bucket; the CRC of equal features is taken once."""
        buffers = [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(letters))]
        coded = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, buffers).dictionary_encode()
        different, bounds = text_buffer_of(coded.dictionary)
        crc = crc32_of(different, bounds, self.table, self.shifts)
        return (crc % np.uint32(self.buckets)).astype(np.int64)[coded.indices.to_numpy()]

    def __call__(self, column: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
        """The words of a text column; text and bucket of every feature, the shorter features first."""
        words = words_of(column, self.folding)
        rows, buckets = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for width in self.widths:
            letters, cuts, row = runs_of(words, width)
            rows.append(row)
            if len(row):
                buckets.append(self._distinct(letters, cuts))
        return words, np.concatenate(rows), np.concatenate(buckets)


def text_buffer_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(array.buffers()[1], np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    return np.frombuffer(array.buffers()[2], np.uint8), offsets


def runs_of(words: Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All runs of ``width`` words of one text, joined by one space: bytes, cuts, text of each."""
    if width == 1:
        return words.letters, words.cuts, words.row
    n = max(0, len(words.row) - width + 1)
    first = np.flatnonzero(words.row[:n] == words.row[width - 1 :][:n])
    # Every word with a space behind it; a run ends before its last space.
    sizes = np.diff(words.cuts)
    spaced = np.full(len(words.letters) + len(sizes), 32, np.uint8)
    spaced[np.arange(len(words.letters)) + np.repeat(np.arange(len(sizes)), sizes)] = words.letters
    starts = words.cuts[first] + first
    lengths = words.cuts[first + width] + width - 1 - words.cuts[first]
    cuts = np.r_[0, np.cumsum(lengths)]
    return spaced[np.repeat(starts - cuts[:-1], lengths) + np.arange(cuts[-1])], cuts, words.row[first]


def bucket_counts(texts: DataFrame, least: int, most: int, buckets: int) -> np.ndarray:
    """How often each bucket's features stand in the whole table; a task sends a row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(least, most, buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for part in small_batches(batch, BATCH):
                total += np.bincount(features(part.column(0))[2], minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    counted = texts.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "bucket long, n long")
    # As many rows as there are buckets, a parameter.
    rows = counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for bucket, n in rows:
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """By bucket: 1000 times the logarithm of its smoothed share in the target over that in the corpus."""
    buckets, all_corpus, all_target = len(corpus), int(corpus.sum()), int(target.sum())
    out = [
        math.floor(1000 * math.log(float(t + 1) * float(all_corpus + buckets) / (float(s + 1) * float(all_target + buckets))))
        for s, t in zip(corpus.tolist(), target.tolist())
    ]
    return np.array(out, np.int64)


def importance_weights(
    documents: DataFrame, target: DataFrame, least: int = 1, most: int = 1, buckets: int = 10_000
) -> DataFrame:
    """The documents with n_words, n_features and weight, as one struct column ``row`` and these three.

    Words are runs of ASCII letters (lower-cased), digits and characters beyond ASCII; features are
    all runs of ``least`` to ``most`` consecutive words, joined by one space; a feature's bucket is
    the CRC-32 of its UTF-8 bytes modulo ``buckets``. A bucket's gain is the floored 1000-fold
    logarithm of its share in ``target`` (a table with a column text) over that in ``documents``, both
    with one added; weight is the sum over the document's features, repeats counted.

    A null or empty text has no words and weight 0. Every row stays one row, with all its columns
    under ``row``, also with a null or repeated doc_id. With an empty target all features have the
    share 1 / ``buckets`` there.
    """
    told = gains(bucket_counts(documents, least, most, buckets), bucket_counts(target, least, most, buckets))
    names = ["n_words", "n_features", "weight"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(least, most, buckets)
        for batch in batches:
            for part in small_batches(batch, BATCH):
                words, row, bucket = features(part.column(1))
                weight = np.zeros(part.num_rows, np.int64)
                np.add.at(weight, row, told[bucket])
                numbers = words.per_row, np.bincount(row, minlength=part.num_rows), weight
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(n, pa.int64()) for n in numbers)], ["row", *names])

    sent = documents.select(F.struct(*documents.columns).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    kinds = T.StructType([sent.schema["row"]])
    for name in names:
        kinds = kinds.add(name, T.LongType())
    return sent.mapInArrow(run, kinds)


def noise(seed: int, doc_id: Column) -> Column:
    """1000-fold Gumbel noise, floored, from a hash of the seed and the id (null: empty)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(share))).cast("long")


def resample(
    documents: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, seed: int = 2024,
    least: int = 1, most: int = 1, buckets: int = 10_000,
) -> DataFrame:
    """Draw ``percent`` of 100 documents of at least ``least_words`` words, likely ones by weight first:
    doc_id, n_features, weight, score, rank (1 for the highest score; null if not drawn).

    score is the weight (see ``importance_weights``) plus noise that depends on the seed and doc_id
    only, so the draw is without replacement and repeatable. Equal scores go by the smaller doc_id, a
    null id is the largest; rows that agree in both are drawn in any order. Every document has a row,
    however short; an empty table gives none; other columns are dropped.

    The narrow rows are sorted once over all tasks; a row's rank is its place in its part plus the
    rows of the parts before, one number for each part.
    """
    weighed = importance_weights(documents.select("doc_id", "text"), target, least, most, buckets)
    doc_id = F.col("row.doc_id")
    weighed = weighed.select(
        doc_id.alias("doc_id"), "n_features", "weight", (F.col("weight") + noise(seed, doc_id)).alias("score"),
        (F.col("n_words") >= least_words).alias("fit"), F.monotonically_increasing_id().alias("nth"),
    )
    # Sorting draws a sample first; the texts are not read again for that. ``nth`` parts rows of one id.
    ordered = checkpointed(weighed).orderBy(F.desc("fit"), F.desc("score"), F.asc_nulls_last("doc_id"), "nth").drop("nth")
    ordered = checkpointed(ordered).withColumn("place", F.monotonically_increasing_id())
    place_bits = 33
    part = F.shiftright("place", place_bits)
    sizes = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.count_if("fit").alias("fit")).orderBy("part")
    before, rows = 0, []
    parts = sizes.collect()
    for number, n, _ in parts:
        rows.append((number, before))
        before += n
    drawn = percent * sum(r["fit"] for r in parts) // 100
    starts = documents.sparkSession.createDataFrame(rows, "part long, before long")
    # A row for each part of the sort, as many as spark.sql.shuffle.partitions at most.
    placed = ordered.withColumn("part", part).join(F.broadcast(starts), "part")
    rank = F.col("before") + F.col("place").bitwiseAND((1 << place_bits) - 1) + 1
    rank = F.when(rank <= drawn, rank).cast("long").alias("rank")
    return placed.select("doc_id", "n_features", "weight", "score", rank)


def drawn_documents(documents: DataFrame, target: DataFrame, **choices: int) -> DataFrame:
    """The drawn documents with all their columns, by doc_id (see ``resample``); a document without
    an id is not drawn, and rows of one id are drawn together."""
    told = resample(documents, target, **choices).where("rank is not null").select(F.col("doc_id").alias("drawn_id"))
    row = documents.select(F.struct(*documents.columns).alias("row"))
    return row.join(told, F.col("row.doc_id") == F.col("drawn_id"), "left_semi").select("row.*")
