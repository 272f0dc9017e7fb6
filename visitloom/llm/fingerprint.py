"""Document fingerprints by Order MinHash, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Tokens are runs of other characters than white space, cut after so many characters.
TOKEN = r"\S{1,8}"


#: A k-mer is one number: its hash in the upper 33 bits, its place in the text in these lower ones. A
#: string has at most 2**31 bytes and so fewer than 2**30 tokens with space between: every place fits,
#: and its highest bit is free.
PLACE_BITS = 31
#: Bytes of texts that are fingerprinted one after the other, in order of doc_id.
TURN = 256 << 20


def order_minhash(rows: DataFrame, text: str, to: str, kmer: int = 3, bins: int = 64, taken: int = 2) -> DataFrame:
    """Adds ``to``: the Order MinHash of a text, an array of strings (bin and hash, in hex).

    k-mers are ``kmer`` tokens in a row (a shorter text is one k-mer); the first, second, ...
    occurrence of a k-mer count as different. One hash of k-mer and occurrence deals them into
    ``bins`` bins of equal hash ranges; each bin selects its ``taken`` least ones, puts them back
    into text order and hashes that tuple. Bins without k-mers are left out; a text without
    tokens has an empty array. ``bins`` is a power of two, 256 at most.
    """
    bits = bins.bit_length() - 1
    tokens, kmers, runs, numbered, least, firsts = (f"_{to}_{i}" for i in range(6))
    places = F.lit((1 << PLACE_BITS) - 1).cast("long")
    hash_of = lambda x: F.shiftright(x, PLACE_BITS)
    bin_of = lambda x: F.shiftrightunsigned(x, 64 - bits) if bits else F.lit(0).cast("long")
    placed = lambda h, at: F.shiftleft(h, PLACE_BITS).bitwiseOR(at.bitwiseAND(places))
    at = lambda array, i: F.get(F.col(array), i)
    last = F.greatest(F.lit(1), F.size(tokens) - (kmer - 1))
    hashed = F.transform(
        F.sequence(F.lit(0), last - 1),
        lambda i: placed(F.xxhash64(*(at(tokens, i + j) for j in range(kmer))), i.cast("long")),
    )
    starts = F.filter(
        F.sequence(F.lit(0), F.size(kmers) - 1),
        lambda i: (i == 0) | (hash_of(at(kmers, i - 1)) != hash_of(at(kmers, i))),
    )
    number = lambda x, o: placed(F.xxhash64(hash_of(x), o), x)
    # Equal k-mers lie side by side in text order: the place in their run is the occurrence.
    run = lambda s, n: F.slice(F.col(kmers), s + 1, F.coalesce(at(runs, n + 1), F.size(kmers)) - s)
    repeated = F.flatten(F.transform(runs, lambda s, n: F.transform(run(s, n), number)))
    single = F.transform(kmers, lambda x: number(x, F.lit(0)))
    occurrences = F.when(F.size(runs) == F.size(kmers), single).otherwise(repeated)
    few = F.filter(F.col(numbered), lambda x, i: (i < taken) | (bin_of(at(numbered, i - taken)) != bin_of(x)))
    first = F.filter(
        F.sequence(F.lit(0), F.size(least) - 1),
        lambda i: (i == 0) | (bin_of(at(least, i - 1)) != bin_of(at(least, i))),
    )

    def tuple_of(i: Column) -> Column:
        own = bin_of(at(least, i))
        of_bin = F.filter(F.slice(F.col(least), i + 1, taken), lambda x: bin_of(x) == own)
        # The place moves to the upper bits, so that sorting gives the text order.
        moved = lambda x: F.shiftleft(x, 64 - PLACE_BITS).bitwiseOR(F.shiftrightunsigned(x, PLACE_BITS))
        in_order = F.sort_array(F.transform(of_bin, moved))
        digest = F.aggregate(
            in_order, F.lit(0).cast("long"), lambda whole, x: F.xxhash64(whole, F.shiftleft(x, PLACE_BITS))
        )
        return F.concat(F.lpad(F.lower(F.hex(own)), 2, "0"), F.right(F.lpad(F.lower(F.hex(digest)), 16, "0"), F.lit(8)))

    some = F.size(tokens) > 0
    none = F.array()
    return (
        rows.withColumn(tokens, F.regexp_extract_all(F.col(text), F.lit(TOKEN), F.lit(0)))
        .withColumn(kmers, F.when(some, F.sort_array(hashed)).otherwise(none.cast("array<bigint>")))
        .withColumn(runs, F.when(some, starts).otherwise(none.cast("array<int>")))
        .withColumn(numbered, F.sort_array(occurrences))
        .withColumn(least, few)
        .withColumn(firsts, F.when(some, first).otherwise(none.cast("array<int>")))
        .withColumn(to, F.transform(firsts, tuple_of))
        .drop(tokens, kmers, runs, numbered, least, firsts)
    )


def likeness(a: str, b: str) -> Column:
    """Share of equal tuples among the bins that either fingerprint has; 1 if both are empty."""
    bins = lambda c: F.transform(c, lambda x: F.left(x, F.lit(2)))
    either = F.size(F.array_union(bins(a), bins(b)))
    return F.when(either == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / either)


def listed(numbers: Iterable[float], kind: str) -> Column:
    """The numbers as a constant array, sent as one text however many they are."""
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast(f"array<{kind}>")


def with_next(documents: DataFrame, splits: int | None = None) -> DataFrame:
    """Documents (doc_id, text), dealt out in order of doc_id, with the columns turn and at that
    order them: in each ``turn``, by ``at``, the row before a document is its next one in descending
    order. Rows with ``at`` 0 are copies that only stand before others.

    Quantiles of the ids deal the rows out. A quantile is an id, so the last row of a turn is known
    beforehand and its copy also leads the following turn; the largest id leads the first one. Turns
    are as many as the bytes of the texts ask for, and several for each shuffle partition, so that
    these fill evenly; ``splits`` sets another number. Rows of one doc_id are in one turn.
    """
    spark = documents.sparkSession
    if splits is None:
        n_bytes = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        splits = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), n_bytes // TURN)
    splits = max(2, splits)
    shares = listed((n / splits for n in range(1, splits)), "double")
    told = documents.agg(F.percentile_approx("doc_id", shares, max(10_000, 10 * splits)), F.max("doc_id")).first()
    largest = told[1]
    # One id for each turn.
    cuts = sorted(set(told[0] or []) - {largest})
    own = F.lit(0)
    lead = F.when(F.col("doc_id").eqNullSafe(F.lit(largest).cast("long")), F.lit(0))
    if cuts:
        ids = listed(cuts, "bigint")
        # How many of them are smaller, by binary search.
        steps = F.array(*(F.lit(1 << n) for n in reversed(range(len(cuts).bit_length()))))
        further = lambda n, step: F.when(F.get(ids, n + step - 1) < F.col("doc_id"), n + step).otherwise(n)
        own = F.aggregate(steps, F.lit(0), further)
        lead = lead.when(F.get(ids, own) == F.col("doc_id"), own + 1)
    places = F.array(F.struct(own.alias("turn"), F.lit(1).alias("at")), F.struct(lead.alias("turn"), F.lit(0).alias("at")))
    return documents.withColumn("place", F.explode(places)).select("doc_id", "text", "place.turn", "place.at").where("turn is not null")


def fingerprint_edits(documents: DataFrame) -> DataFrame:
    """Fingerprints of every whole text and of its edited text: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last third (rounded down) replaced by as many first code points of the
    next document in descending doc_id, or all of them; after the last document comes the first.
    near_edited and near_next: likeness of the fingerprint to that of the edited text and of the
    next document. A fingerprint is the tuples' text, joined by spaces.

    A null text is empty; an empty text has an empty fingerprint. A null doc_id is less than all
    others. Documents with equal doc_id follow each other by text. Other columns are dropped; no
    rows give no rows; the next of a single document is itself.
    """
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    dealt = order_minhash(with_next(texts), "text", "own")
    turn = Window.partitionBy("turn").orderBy("at", F.asc_nulls_first("doc_id"), "text")
    told = dealt.withColumns({"next_text": F.lag("text").over(turn), "next": F.lag("own").over(turn)}).where("at = 1")
    told = told.withColumn("n_chars", F.length("text").cast("long"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.left("text", F.col("n_chars").cast("int") - third), F.left("next_text", third))
    told = told.withColumn("edited", edited)
    told = told.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    told = order_minhash(told.drop("text", "next_text"), "edited", "changed")
    return told.select(
        "doc_id", "n_chars", "edited_sha256",
        F.array_join("own", " ").alias("fingerprint"),
        F.array_join("changed", " ").alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"),
        likeness("own", "next").alias("near_next"),
    )
