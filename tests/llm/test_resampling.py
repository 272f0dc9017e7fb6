"""Importance resampling against a version in plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.compare import connect, duck_rows, spark_rows
from visitloom.llm import catalog, resampling
from visitloom.llm.words import folding, words_of

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
FOLD = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
SCHEMA = "doc_id long, text string"


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def features(text, least, most):
    found = words(text)
    return [" ".join(found[i : i + n]) for n in range(least, most + 1) for i in range(len(found) - n + 1)]


def brute(docs, target, percent=10, least_words=20, seed=2024, least=1, most=1, buckets=10_000):
    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    def counts(texts):
        return Counter(bucket(f) for t in texts for f in features(t, least, most))

    s, t = counts(d[1] for d in docs), counts(target)
    all_s, all_t = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, text in docs:
        found = [bucket(f) for f in features(text, least, most)]
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in found)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None, len(words(text))])
    fit = sorted((r for r in rows if r[5] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(fit[: percent * len(fit) // 100], 1):
        row[4] = rank
    return Counter(tuple(r[:5]) for r in rows)


def some_texts(n, seed=1):
    rng = random.Random(seed)
    vocabulary = ["The", "río", "x1", "漢字" * 40, "a" * 64, "b" * 65, "c" * 300, "ÀÉ", "of", "data", "\U0001f600"]
    return [rng.choice([" ", "\n", "-", "\x00"]).join(rng.choice(vocabulary) for _ in range(rng.choice([0, 5, 30, 200]))) for _ in range(n)]


@pytest.mark.parametrize(("least", "most", "buckets"), [(1, 1, 10_000), (1, 2, 97), (2, 3, 1000)])
def test_equals_brute_force(spark, least, most, buckets):
    docs = [*enumerate(some_texts(150)), (None, "one two"), (900, None), (901, ""), (901, "twice " * 30), (901, "twice " * 30)]
    target = [*some_texts(10, 2), None, ""]
    choices = {"least": least, "most": most, "buckets": buckets, "percent": 30}
    frame = spark.createDataFrame(docs, SCHEMA).repartition(5)
    told = resampling.resample(frame, spark.createDataFrame([(t,) for t in target], "text string"), **choices)
    assert told.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, told.collect())) == brute(docs, target, **choices)


def test_many_rows_of_one_id_are_ranked_each(spark):
    docs = [(None, "word " * 25)] * 40 + [(7, "word " * 25)] * 40
    told = resampling.resample(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame([("word",)], "text string"), percent=50)
    ranks = sorted(r["rank"] for r in told.collect() if r["rank"])
    assert ranks == list(range(1, 41)) and told.count() == 80


def test_empty_tables(spark):
    none, nothing = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "text string")
    assert resampling.resample(none, nothing).count() == 0
    docs = [(1, "a b " * 15), (2, None)]
    assert Counter(map(tuple, resampling.resample(spark.createDataFrame(docs, SCHEMA), nothing).collect())) == brute(docs, [])


def test_columns_of_the_table_stay_apart(spark):
    names = ["row", "nth", "place", "part", "before", "weight", "n_words", "drawn_id", "rank", "score"]
    docs = spark.createDataFrame([(n, "w " * 30, *([n] * len(names))) for n in range(20)], f"{SCHEMA}, " + ", ".join(f"{n} long" for n in names))
    docs = docs.selectExpr("*", "map('a', doc_id) as extra")
    target = spark.createDataFrame([("w",)], "text string")
    assert resampling.resample(docs, target).where("rank is not null").count() == 2
    left = resampling.drawn_documents(docs, target, percent=50)
    assert left.columns == docs.columns and left.count() == 10
    assert all(r[n] == r["doc_id"] for r in left.collect() for n in names)


def test_crc_of_any_length():
    rng = np.random.default_rng(3)
    table = resampling.crc_table()
    shifts = resampling.shift_tables(table)
    strings = [rng.integers(0, 256, n, np.uint8).tobytes() for n in [*range(140), 511, 512, 513, 100_000, 64, 64, 128]]
    cuts = np.r_[0, np.cumsum([len(s) for s in strings])]
    found = resampling.crc32_of(np.frombuffer(b"".join(strings), np.uint8), cuts, table, shifts)
    assert found.tolist() == [zlib.crc32(s) for s in strings]


def test_words_of_neighbouring_texts_stay_apart():
    texts = ["", "ab", "cd EF", "", "9", " é ", "x", ""]
    found = words_of(pa.array(texts), folding())
    raw = found.letters.tobytes()
    told = [raw[a:b].decode() for a, b in zip(found.cuts, found.cuts[1:])]
    assert told == [w for t in texts for w in words(t)]
    assert found.per_row.tolist() == [len(words(t)) for t in texts]
    assert found.number.tolist() == [0, 0, 1, 0, 0, 0]


def test_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    name = "op11_importance_resampling"
    columns, rows = spark_rows(catalog.QUERIES[name](spark, sf))
    assert (columns, rows) == duck_rows(connect(sf), catalog.ORACLE_SQL[name])
