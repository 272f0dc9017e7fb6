"""Packing: every id once, in gapless sequences."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from visitloom.llm import packing

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string"


def ids_of(text):
    return [*Tokenizer.from_file(VOCABULARY).encode(text or "", add_special_tokens=False).ids, 0]


def check(pieces, rows, length):
    """Pieces cover each document's ids once; sequences have no gaps and are full or a power of two."""
    ids = {d: ids_of(t) for d, t in rows}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        part = np.array(ids[p["doc_id"]][p["start"] : p["start"] + p["length"]], "<u4")
        assert len(part) == p["length"] > 0 and zlib.crc32(part.tobytes()) == p["ids_crc32"]
        assert p["doc_tokens"] == len(ids[p["doc_id"]])
        by_doc[p["doc_id"]].append((p["start"], p["length"]))
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    assert set(by_doc) == set(ids)
    for kept, total in [(v, len(ids[d])) for d, v in by_doc.items()] + [(v, None) for v in by_sequence.values()]:
        at = 0
        for start, n in sorted(kept):
            assert start == at
            at += n
        if total is None:
            assert at <= length and at & (at - 1) == 0
        else:
            assert at == total


def test_packing(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["the", "río", "x1", "and", "\n"]) for _ in range(rng.choice([0, 3, 40, 200, 900])))) for i in range(120)]
    rows += [(200, None), (None, "no id"), (201, "a <|endoftext|> b"), (202, "漢字\U0001f600 " * 50), (203, " " * 3000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5, "doc_id")
    pieces = packing.pack(docs, VOCABULARY, 64, 4)
    check(pieces.collect(), rows, 64)
    assert packing.padding(pieces, 64).first()["padding"] == 0


def test_repeated_rows_are_packed_each(spark):
    docs = spark.createDataFrame([(1, "one two")] * 3, SCHEMA + "")
    pieces = packing.pack(docs, VOCABULARY).collect()
    assert sum(p["length"] for p in pieces) == 3 * len(ids_of("one two"))


def test_no_rows_and_other_columns(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), VOCABULARY).count() == 0
    docs = spark.createDataFrame([(1, "t", 2, 3)], SCHEMA + ", part long, ids long")
    assert packing.pack(docs, VOCABULARY).columns == list(packing.PIECE)


@pytest.mark.parametrize("windows", [1, 3])
def test_packer_keeps_few_windows(windows):
    rng, out = random.Random(2), []
    packer = packing.Packer(32, windows, 0, out)
    total = 0
    for i in range(300):
        ids = np.arange(rng.randint(1, 80), dtype=np.uint32)
        total += len(ids)
        packer.add(i, 0, ids, len(ids))
        assert len(packer.open) <= windows
    packer.finish()
    assert sum(r[2] for r in out) == total


def test_ids_equal_the_library_on_test_documents(spark):
    library, encode = Tokenizer.from_file(VOCABULARY), packing.text_encoder(VOCABULARY)
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    for text in [r[0] for r in rows] + ["<|endoftext|>x", "a\u00a0\u2003b", "\x00\x85"]:
        assert encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
