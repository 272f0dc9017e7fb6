"""Bounded-space online packing of token ids into fixed-length training sequences."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitloom.llm.common import checkpointed, id_and_text, small_batches
from visitloom.llm.token_counts import byte_characters

PIECE = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
#: Partitions whose last windows are merged together.
MERGED = 64


def text_encoder(vocabulary: str) -> Callable[[str], np.ndarray]:
    """Text to ids, as ``tokenizers`` gives them for the file without added special tokens.

    The same vocabulary runs through ``tiktoken``, which is about six times as fast; what that
    refuses goes through ``tokenizers`` itself. Special strings in a text get their own id.
    """
    import json

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(vocabulary, encoding="utf-8") as file:
        told = json.load(file)
    number = {c: b for b, c in enumerate(byte_characters())}
    ranks = {bytes(number[c] for c in token): i for token, i in told["model"]["vocab"].items()}
    special = {t["content"]: t["id"] for t in told["added_tokens"]}
    ranks = {token: i for token, i in ranks.items() if i not in special.values()}
    quick = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    library = Tokenizer.from_file(vocabulary)

    def encode(text: str) -> np.ndarray:
        try:
            return quick.encode_to_numpy(text, allowed_special="all").astype(np.uint32)
        except BaseException as error:  # the native code panics on some very long runs
            if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return np.array(library.encode(text, add_special_tokens=False).ids, np.uint32)

    return encode


class Packer:
    """Open windows, at most ``windows`` of ``length`` ids; full ones leave through ``out``."""

    def __init__(self, length: int, windows: int, first: int, out: list[tuple]) -> None:
        self.length, self.windows, self.next, self.out = length, windows, first, out
        self.open: list[list] = []  # each: ids in it, its pieces (doc_id, start, ids, doc_tokens)

    def close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            self.out.append((doc_id, start, len(ids), crc, total, self.next, offset))
            offset += len(ids)
        self.next += 1

    def put(self, window: list, piece: tuple) -> None:
        window[0] += len(piece[2])
        window[1].append(piece)
        if window[0] == self.length:
            self.open.remove(window)
            self.close(window[1])

    def add(self, doc_id: int | None, start: int, ids: np.ndarray, total: int) -> None:
        """Whole lengths leave at once; the rest goes to the open window that it fills best.

        If it fits none and no window can be opened, it is cut to fill the fullest, which
        leaves; what is left of it goes on.
        """
        while len(ids) >= self.length:
            self.close([(doc_id, start, ids[: self.length], total)])
            ids, start = ids[self.length :], start + self.length
        while len(ids):
            fits = [w for w in self.open if self.length - w[0] >= len(ids)]
            if fits:
                self.put(max(fits, key=lambda w: w[0]), (doc_id, start, ids, total))
                return
            if len(self.open) < self.windows:
                self.open.append([0, []])
                self.put(self.open[-1], (doc_id, start, ids, total))
                return
            fullest = max(self.open, key=lambda w: w[0])
            n = self.length - fullest[0]
            self.put(fullest, (doc_id, start, ids[:n], total))
            ids, start = ids[n:], start + n

    def merge(self) -> list[tuple]:
        """Fills the fullest windows from the emptiest; the pieces of the last open one."""
        while len(self.open) > 1:
            self.open.sort(key=lambda w: w[0])
            pieces = self.open.pop(0)[1]
            self.windows = len(self.open)
            for doc_id, start, ids, total in pieces:
                self.add(doc_id, start, ids, total)
        return self.open[0][1] if self.open else []

    def finish(self) -> None:
        """The last window, cut into sequences of powers of two, which need no padding."""
        pieces = self.merge()
        left = sum(len(p[2]) for p in pieces)
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            taken: list[tuple] = []
            while size:
                doc_id, start, ids, total = pieces.pop(0)
                taken.append((doc_id, start, ids[:size], total))
                if len(ids) > size:
                    pieces.insert(0, (doc_id, start + size, ids[size:], total))
                size -= len(taken[-1][2])
            self.close(taken)


def pack(documents: DataFrame, vocabulary: str, length: int = 1024, windows: int = 16, end: int = 0) -> DataFrame:
    """Pieces of documents in sequences of ``length`` ids: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset.

    A document is the ids of its text and then ``end``. Each input partition packs online with
    ``windows`` open windows. Their leftovers are merged within the partition, then the last
    window of every 64 partitions; what is left there becomes sequences of powers of two. So no
    sequence needs padding, and a task holds some windows, never a partition.

    A null or empty text is the one id ``end``; a null id stays; repeated rows are packed each;
    other columns are dropped; no documents give no pieces. ``ids_crc32``: of the piece's ids as
    little-endian unsigned 32-bit numbers. Sequence ids are unique, not gapless.
    """
    texts = id_and_text(documents)
    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in PIECE[1:])

    def table(rows: list[tuple], part: int | None, left: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        rows = [(*r, None, None) for r in rows]
        rows += [(d, s, len(i), None, t, None, None, part, i.tobytes()) for d, s, i, t in left]
        kinds = [id_type, *[pa.int64()] * 7, pa.binary()]
        columns = list(zip(*rows)) if rows else [()] * 9
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], [*PIECE, "part", "ids"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, out, part, id_type = text_encoder(vocabulary), [], TaskContext.get().partitionId(), None
        packer = Packer(length, windows, part << 32, out)
        for batch in batches:
            id_type = batch.column(0).type
            for some in small_batches(batch):
                for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    ids = np.append(encode(text), np.uint32(end)).astype(np.uint32)
                    packer.add(doc_id, 0, ids, len(ids))
                yield table(out, None, [], id_type)
                out.clear()
        if id_type is not None:
            left = packer.merge()
            yield table(out, part, left, id_type)

    def merge(key: tuple, group: pa.Table) -> pa.Table:
        out: list[tuple] = []
        packer = Packer(length, windows, 1 << 62 | key[0].as_py() << 32, out)
        group = group.sort_by([("part", "ascending"), ("doc_id", "ascending"), ("start", "ascending")])
        for row in group.to_pylist():
            packer.add(row["doc_id"], row["start"], np.frombuffer(row["ids"], np.uint32), row["doc_tokens"])
        packer.finish()
        return pa.Table.from_batches([table(out, None, [], group.schema.field("doc_id").type)]).select(PIECE)

    packed = checkpointed(texts.mapInArrow(run, f"{schema}, part long, ids binary"))
    left = packed.where("part is not null").withColumn("merged", F.floor(F.col("part") / MERGED).cast("long"))
    merged = left.groupBy("merged").applyInArrow(merge, schema)
    return packed.where("part is null").select(*PIECE).unionByName(merged)


def padding(pieces: DataFrame, length: int = 1024) -> DataFrame:
    """Sequences, ids, and ids of padding: up to ``length``, or none at a power of two."""
    sizes = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    exact = F.col("n").bitwiseAND(F.col("n") - 1) == 0
    return sizes.agg(
        F.count("*").alias("sequences"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("ids"),
        F.coalesce(F.sum(F.when(exact, 0).otherwise(length - F.col("n"))), F.lit(0)).alias("padding"),
    )
