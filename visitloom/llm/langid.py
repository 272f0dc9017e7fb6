"""Language identification with n-gram filters that hold a bitmask of languages."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitloom.llm.common import Scratch, by_value, mixed, small_batches, with_row

UNKNOWN = "und"
WIDTHS = (3, 4)
HASHES = 3
#: Languages of a model; of more labels, those with most documents are learned.
MOST_LANGUAGES = 4096


@dataclass(frozen=True)
class LanguageModel:
    """Languages and the bit-sliced Bloom filters of their n-grams.

    ``slices[w]`` has, by slot, a bit for each of the languages 64w to 64w + 63. ``false_share``:
    the share of unseen n-grams that a language's filter takes for its own.
    """

    languages: list[str]
    slices: np.ndarray
    false_share: np.ndarray

    @property
    def learned(self) -> bool:
        """Whether any language has an n-gram."""
        return bool(self.slices.any())


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def text_grams(texts: list[str], is_letter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the texts' n-grams, the text of each, and whether a text has a letter.

    Texts are lower-cased; each run of other characters than letters is one space. An n-gram lies
    in a word and the space before and after it.
    """
    texts = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), sizes)
    word = is_letter[codes]
    has_letter = np.bincount(owner[word], minlength=len(texts)) > 0
    keep = word.copy()
    keep[:-1] |= word[1:]
    keep[1:] |= word[:-1]
    codes, owner, word = np.where(word, codes, 32).astype(np.uint64)[keep], owner[keep], word[keep]
    hashes, owners = [], []
    value = codes.copy()
    for width in range(2, max(WIDTHS) + 1):
        n = len(codes) - width + 1
        if n <= 0:
            break
        value = value[:n] * np.uint64(0x100000001B3) + codes[width - 1 :]
        if width in WIDTHS:
            inner = np.ones(n, bool)
            for j in range(1, width - 1):
                inner &= word[j : j + n]
            inner &= owner[:n] == owner[width - 1 :]
            hashes.append(mixed(value[inner] * np.uint64(2) + np.uint64(width & 1)))
            owners.append(owner[:n][inner])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), has_letter
    return np.concatenate(hashes), np.concatenate(owners), has_letter


def slots(grams: np.ndarray, size: int) -> list[np.ndarray]:
    step = (grams >> np.uint64(32)) | np.uint64(1)
    return [((grams + np.uint64(i) * step) & np.uint64(size - 1)).astype(np.int64) for i in range(HASHES)]


def labelled_rows(labelled: DataFrame) -> DataFrame:
    """lang, text and key of the rows with a lang: rows that agree in doc_id and text have one key."""
    text = F.coalesce("text", F.lit(""))
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text)
    return labelled.where(F.col("lang").isNotNull()).select("lang", text.alias("text"), key.alias("key"))


def most_labelled(rows: DataFrame, most: int = MOST_LANGUAGES) -> DataFrame:
    """The ``most`` languages with most rows: lang, documents."""
    return rows.groupBy("lang").agg(F.count("*").alias("documents")).orderBy(F.desc("documents"), "lang").limit(most)


def labelled_sample(labelled: DataFrame, per_language: int, most: int = MOST_LANGUAGES) -> tuple[DataFrame, DataFrame]:
    """lang and text of about ``per_language`` rows of each of the ``most`` languages with most rows;
    and these languages.

    Rows are drawn by a hash of doc_id and text; rows that agree in both count once, so the sample is
    bounded whatever repeats.
    """
    rows = labelled_rows(labelled)
    sizes = most_labelled(rows, most)
    drawn = F.pmod("key", F.lit(1_000_000)) * F.col("documents") < F.lit(per_language) * 1_000_000
    # At most ``most`` rows; so the texts stay where they are read until they are drawn.
    sample = rows.join(F.broadcast(sizes), "lang").where(drawn).dropDuplicates(["lang", "key"])
    return sample.select("lang", "text"), sizes


def labelled_once(labelled: DataFrame, stored: Scratch, most: int = MOST_LANGUAGES) -> tuple[DataFrame, DataFrame]:
    """lang and text of all rows of each of the ``most`` languages with most rows, those that agree in
    doc_id and text once; and these languages.

    The keys that repeat are stored, so Spark knows how many they are. Where they fit a broadcast,
    only the texts of rows that repeat are shuffled.
    """
    rows = labelled_rows(labelled)
    sizes = most_labelled(rows, most)
    # At most ``most`` rows.
    rows = rows.join(F.broadcast(sizes), "lang").select("lang", "text", "key")
    repeated = stored(rows.groupBy("lang", "key").agg(F.count("*").alias("n")).where("n > 1").select("lang", "key"))
    alone = rows.join(repeated, ["lang", "key"], "left_anti")
    once = rows.join(repeated, ["lang", "key"], "left_semi").dropDuplicates(["lang", "key"])
    return alone.unionByName(once).select("lang", "text"), sizes


def fit_languages(
    labelled: DataFrame, per_language: int | None = 2000, grams: int = 6000, least: float = 2e-5, own: float = 0.2,
    coverage: float = 0.8,
) -> LanguageModel:
    """A model from rows with doc_id, text and a non-null lang.

    The fit reads about ``per_language`` documents of each language (at most 4096 languages), drawn by
    a hash of id and text (all if there are fewer, or if it is None), repeated rows once. A language's
    filter holds its ``grams`` most frequent n-grams among those with a share of ``least`` of its
    n-grams, and of ``own`` times their share in any other language; where these are less than
    ``coverage`` of its n-grams, as many more as reach that, or all.
    The model's size is bounded by these parameters and the number of languages. Without rows it
    knows no language; a language without any letters has no n-grams. Null texts and ids are no
    different from empty ones.
    """
    if per_language is not None:
        return learned(*labelled_sample(labelled, per_language), grams, least, own, coverage)
    with Scratch(labelled.sparkSession) as stored:
        return learned(*labelled_once(labelled, stored), grams, least, own, coverage)


def learned(
    texts: DataFrame, sizes: DataFrame, grams: int, least: float, own: float, coverage: float
) -> LanguageModel:
    """The model of ``fit_languages`` from lang and text of the rows to read, and the languages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter = letters()
        for batch in batches:
            for part in small_batches(batch, 1 << 20):
                told = part.column(0).to_pylist()
                langs = {lang: i for i, lang in enumerate(sorted(set(told)))}
                number = np.array([langs[lang] for lang in told])
                found, owner, _ = text_grams(part.column(1).to_pylist(), is_letter)
                for lang, i in langs.items():
                    values, n = np.unique(found[number[owner] == i], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(values), pa.string()), pa.array(values.view(np.int64), pa.int64()),
                            pa.array(n, pa.int64()),
                        ],
                        ["lang", "gram", "n"],
                    )

    counts = texts.mapInArrow(count, "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    # One row a language.
    shares = counts.join(F.broadcast(totals), "lang").select("lang", "gram", (F.col("n") / F.col("total")).alias("share"))
    most = shares.where(F.col("share") >= least).withColumn("most", F.max("share").over(Window.partitionBy("gram")))
    by_share = Window.partitionBy("lang").orderBy(F.desc("share"), "gram").rowsBetween(Window.unboundedPreceding, 0)
    ranked = most.where(F.col("share") >= own * F.col("most")).withColumns(
        {"rank": F.count("*").over(by_share), "covered": F.sum("share").over(by_share)}
    )
    more = F.col("covered") - F.col("share") < coverage
    chosen = ranked.where((F.col("rank") <= grams) | more).select("lang", "gram").toPandas()
    languages = sorted(r["lang"] for r in sizes.select("lang").collect())
    largest = max([grams, *chosen["lang"].value_counts().tolist()])
    size = 1 << max(12, (16 * largest - 1).bit_length())
    slices = np.zeros((-(-len(languages) // 64) or 1, size), np.uint64)
    for number, lang in enumerate(languages):
        own_grams = chosen.loc[chosen["lang"] == lang, "gram"].to_numpy(np.int64).view(np.uint64)
        for slot in slots(own_grams, size):
            slices[number // 64][slot] |= np.uint64(1 << (number % 64))
    filled = np.array(
        [((slices[n // 64] >> np.uint64(n % 64)) & np.uint64(1)).mean() for n in range(len(languages))]
    )
    return LanguageModel(languages, slices, filled**HASHES)


def language_shares(model: LanguageModel, grams: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """By text and language the share of n-grams in the language's filter, without the share that
    is there by chance."""
    places = slots(grams, model.slices.shape[1])
    total = np.maximum(np.bincount(owner, minlength=n), 1)
    shares = np.zeros((n, len(model.languages)))
    for w, words in enumerate(model.slices):
        mask = words[places[0]]
        for place in places[1:]:
            mask = mask & words[place]
        for number in range(64 * w, min(64 * w + 64, len(model.languages))):
            hit = (mask >> np.uint64(number % 64)) & np.uint64(1)
            shares[:, number] = np.bincount(owner, weights=hit, minlength=n) / total
    return np.clip((shares - model.false_share) / (1 - model.false_share), 0, 1)


def predict(model: LanguageModel, texts: list[str], is_letter: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    grams, owner, has_letter = text_grams(texts, is_letter)
    if not model.learned:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    shares = language_shares(model, grams, owner, len(texts))
    best = shares.argmax(axis=1)
    names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, has_letter)]
    return names, np.where(has_letter, shares[np.arange(len(texts)), best], 0.0)


def identify(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """The language of every whole text: doc_id, lang_pred, score (0 to 1).

    Each n-gram's slots, combined by AND, give all languages that contain it; the language with the
    largest corrected share of the text's n-grams is predicted, the first by name among equal ones.
    score is that share. A null text, one without letters, or a model without n-grams gives
    ``und`` and 0. A null id stays; repeated rows are judged each; other columns are dropped.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    sent = by_value(documents.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter, model = letters(), sent()
        for batch in batches:
            for part in small_batches(batch, 1 << 20):
                names, score = predict(model, part.column(1).to_pylist(), is_letter)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"]
                )

    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def own_shares(model: LanguageModel, grams: np.ndarray, owner: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Of each text the value of ``language_shares`` for one language, whose number is given."""
    word, bit = (number // 64)[owner], (number % 64).astype(np.uint64)[owner]
    hit = np.ones(len(grams), np.uint64)
    for place in slots(grams, model.slices.shape[1]):
        hit &= model.slices[word, place] >> bit
    n = len(number)
    shares = np.bincount(owner, weights=hit, minlength=n) / np.maximum(np.bincount(owner, minlength=n), 1)
    chance = model.false_share[number]
    return np.clip((shares - chance) / (1 - chance), 0, 1)


def least_scores(labelled: DataFrame, model: LanguageModel, most: float = 0.3, low: float = 0.05) -> dict[str, float]:
    """The score from which on a text is taken to be in a language, for each of the model.

    Half of what all labelled documents of the language (repeated rows once) reach but for the share
    ``low`` of them, at most ``most``: languages differ in how many of their n-grams a filter holds.
    """
    sent = by_value(labelled.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter, model = letters(), sent()
        numbers = {lang: n for n, lang in enumerate(model.languages)}
        for batch in batches:
            for part in small_batches(batch, 1 << 20):
                found, owner, has_letter = text_grams(part.column(1).to_pylist(), is_letter)
                number = np.array([numbers.get(lang, -1) for lang in part.column(0).to_pylist()], np.int64)
                told = np.zeros(part.num_rows)
                if model.languages:
                    # Rows of a language beyond the model's take the first one's number, and go.
                    told = own_shares(model, found, owner, np.maximum(number, 0))
                judged = pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(told, pa.float64())], ["lang", "key", "own"]
                )
                yield judged.filter(pa.array(has_letter & (number >= 0)))

    # Equal texts have equal shares, so repeated rows can go after the texts.
    judged = labelled_rows(labelled).mapInArrow(run, "lang string, key long, own double").dropDuplicates(["lang", "key"])
    reached = judged.groupBy("lang").agg(F.percentile_approx("own", low).alias("low"))
    return {lang: most for lang in model.languages} | {r["lang"]: min(most, r["low"] / 2) for r in reached.collect()}


def identified(documents: DataFrame, model: LanguageModel, least: float | dict[str, float] = 0.3) -> DataFrame:
    """The documents, with all their columns, whose language is known with at least this score (or
    that of the language, see ``least_scores``). Where no language could be learned, all with letters.

    A null text has no letters, so its row goes; null and repeated ids are rows like others, and any
    other columns of any name stay as they are. An empty table stays empty.
    """
    sent = by_value(documents.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter, model = letters(), sent()
        for batch in batches:
            for part in small_batches(batch, 1 << 20):
                texts = part.column(1).to_pylist()
                if model.learned:
                    names, score = predict(model, texts, is_letter)
                    keep = [
                        n != UNKNOWN and s >= (least[n] if isinstance(least, dict) else least) for n, s in zip(names, score)
                    ]
                else:
                    keep = text_grams(texts, is_letter)[2]
                yield part.select(["row"]).filter(pa.array(keep, pa.bool_()))

    judged = with_row(documents, F.coalesce("text", F.lit("")))
    return judged.mapInArrow(run, judged.select("row").schema).select("row.*")
