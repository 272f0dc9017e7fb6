"""Language identification: held-out accuracy and odd rows."""

from __future__ import annotations

import corpus_pipeline as pipeline
import numpy as np
import pytest

from visitloom.llm import catalog, langid

SCHEMA = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def model(spark):
    return langid.fit_languages(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id % 4 <> 2"))


def test_held_out_accuracy(spark):
    found = catalog.op7_language_id(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 200
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_rows(spark, model):
    docs = spark.createDataFrame(
        [(1, None, 0), (2, "", 0), (3, "12 ## !!", 0), (None, "the and that", 0), (4, "a", 0), (5, "x" * 200_000, 0), (4, "a", 0)],
        "doc_id long, text string, score long",
    )
    found = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    assert [found[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and found[3]["score"] == 0
    assert found[None]["lang_pred"] == "en"
    assert found[4]["lang_pred"] in model.languages and found[5]["score"] < 0.3
    assert langid.identify(docs, model).count() == 7
    kept = langid.identified(docs, model, 0.3)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} <= {None, 4}


def test_no_labels_and_no_rows(spark):
    none = langid.fit_languages(spark.createDataFrame([(1, "text", None)], SCHEMA))
    docs = spark.createDataFrame([(1, "text", None)], SCHEMA)
    assert [tuple(r) for r in langid.identify(docs, none).collect()] == [(1, "und", 0.0)]
    assert langid.identify(spark.createDataFrame([], SCHEMA), none).count() == 0


def test_masks_give_all_languages_of_a_gram():
    """70 languages: the filters' masks against plain sets, beyond chance."""
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 2**63, 300).astype(np.uint64) for _ in range(70)]
    size = 1 << 13
    slices = np.zeros((2, size), np.uint64)
    for n, grams in enumerate(sets):
        for slot in langid.slots(grams, size):
            slices[n // 64][slot] |= np.uint64(1 << (n % 64))
    filled = np.array([((slices[n // 64] >> np.uint64(n % 64)) & np.uint64(1)).mean() for n in range(70)])
    model = langid.LanguageModel([str(n) for n in range(70)], slices, filled**langid.HASHES)
    shares = langid.language_shares(model, np.concatenate([sets[3], sets[69]]), np.repeat([0, 1], 300), 2)
    assert shares[0].argmax() == 3 and shares[1].argmax() == 69 and shares[0, 3] == 1
    assert abs(np.delete(shares[0], 3)).mean() < 0.01


def test_grams_stay_in_words():
    is_letter = langid.letters()
    one = langid.text_grams(["ab, cd"], is_letter)[0]
    two = langid.text_grams(["AB", "cd"], is_letter)[0]
    assert sorted(one) == sorted(two) and len(one) == 2 * (2 + 1)


def test_language_of_many_different_grams_stays(spark):
    """Words of a large alphabet, as in Chinese prose: many n-grams come once."""
    rng = np.random.default_rng(4)
    words = np.array(["".join(map(chr, rng.integers(0x4E00, 0x9FA5, 2))) for _ in range(4000)])
    often = 1 / np.arange(1, 4001)
    texts = ["".join(rng.choice(words, 400, p=often / often.sum())) for _ in range(400)]
    rows = [(n, t, "zh" if n % 4 else None) for n, t in enumerate(texts)]
    rows += [(1000 + n, "the and that of this with a word " * 3, "en") for n in range(50)]
    docs = spark.createDataFrame(rows + [(2000, "\u0436\u044b\u0448" * 90, None)], SCHEMA)
    model = langid.fit_languages(docs)
    kept = {r[0] for r in langid.identified(docs, model, langid.least_scores(docs, model)).select("doc_id").collect()}
    assert len(kept) == 450 and 2000 not in kept


def test_documents_pass_without_a_learned_language(spark):
    docs = spark.createDataFrame([(1, "text", None), (2, "12", None), (3, None, None)], SCHEMA)
    model = langid.fit_languages(docs)
    kept = langid.identified(docs, model, langid.least_scores(docs, model))
    assert [r[0] for r in kept.collect()] == [1]


def rows_that_differ(n, seed):
    """Rows of two languages whose texts hold between none and all words of their own."""
    rng = np.random.default_rng(seed)
    say = lambda letters, n: np.array(["".join(w) for w in rng.choice(list(letters), (n, 6))])
    own, rare = {"aa": say("abcdefghij", 300), "bb": say("klmnopqrst", 300)}, say("uvwxyz\u0436\u0448\u044b", 5000)
    rows = []
    for i in range(n):
        lang = ("aa", "bb")[i % 2]
        mine = rng.random(20) < rng.random()
        words = np.where(mine, own[lang][rng.integers(0, 300, 20)], rare[rng.integers(0, 5000, 20)])
        rows.append((i if i % 3 else None, " ".join(words.tolist()), lang))
    return rows


def test_least_scores_come_from_all_labelled_rows(spark):
    rows = rows_that_differ(3000, 1)
    # Of a language with far more rows than a sample holds; repeated rows count once.
    rows += [(i, t, "aa") for i, (_, t, lang) in enumerate(rows_that_differ(6000, 2)) if lang == "aa"] + rows[:50]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = langid.fit_languages(docs, grams=200, coverage=0.1)
    least = langid.least_scores(docs, model, most=1.0, low=0.3)
    is_letter, once = langid.letters(), sorted(set(rows), key=str)
    for number, lang in enumerate(model.languages):
        texts = [t for _, t, told in once if told == lang]
        grams, owner, _ = langid.text_grams(texts, is_letter)
        own = np.sort(langid.language_shares(model, grams, owner, len(texts))[:, number])
        assert least[lang] == own[int(np.ceil(0.3 * len(texts))) - 1] / 2


def test_fit_of_all_rows_equals_a_sample_that_holds_all(spark):
    rows = rows_that_differ(600, 3)
    # Many rows of one id and text, and a language without a letter.
    rows += rows[:100] * 3 + [(7, "words of one row", "aa")] * 400 + [(8, None, "cc"), (9, "12", "cc"), (10, "none", None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    every, drawn = (langid.fit_languages(docs, per_language=n) for n in (None, 2000))
    assert every.languages == drawn.languages == ["aa", "bb", "cc"]
    assert np.array_equal(every.slices, drawn.slices) and np.array_equal(every.false_share, drawn.false_share)


def test_pipeline_draws_no_sample(spark, monkeypatch):
    def none(*_):
        raise AssertionError("a sample was drawn")

    monkeypatch.setattr(langid, "labelled_sample", none)
    rows = [(n, "the and that of this with a word " * 3, "en") for n in range(60)] + [(60, "12", "en")]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert dict(pipeline.STAGES)["language ID"](spark, docs, "").count() == 60
