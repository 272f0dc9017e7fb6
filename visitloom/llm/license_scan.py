"""Licence labels of texts: notice phrases, and licence expressions behind identifier tags."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitloom.llm.common import small_batches
from visitloom.llm.words import Words, folding, joined, words_of

#: Bytes of texts looked at together.
BATCH = 4 << 20

# The phrases and labels that are always looked for.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Further phrases; their words stand consecutively in the text, whatever lies between them.
PHRASES = {
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "apache license": "apache",
    "apache license version 2 0": "apache-2.0",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "general public license version 2": "gpl-2.0",
    "general public license version 3": "gpl-3.0",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "isc license": "isc",
    "creative commons attribution": "cc-by",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "cc0": "cc0",
    "public domain": "public-domain",
    "proprietary and confidential": "proprietary",
}
#: What stands before a licence expression.
TAGS = ("spdx license identifier", "license expression")

#: How much each family of licences restricts the use of a text, from 0 to 1. Identifiers belong to
#: the family with the longest name that they begin with, up to a hyphen or their end.
FAMILIES = {
    "cc0": 0.0, "public-domain": 0.0, "unlicense": 0.0, "wtfpl": 0.0, "0bsd": 0.0,
    "mit": 0.2, "bsd": 0.2, "isc": 0.2, "apache": 0.2, "bsl": 0.2, "zlib": 0.2, "python": 0.2, "psf": 0.2, "ncsa": 0.2,
    "x11": 0.2, "cc-by": 0.2, "postgresql": 0.2,
    "mpl": 0.4, "epl": 0.4, "lgpl": 0.4, "cddl": 0.4, "artistic": 0.4, "cc-by-sa": 0.4, "ofl": 0.4,
    "gpl": 0.6, "agpl": 0.6, "osl": 0.6, "eupl": 0.6, "gfdl": 0.6,
    "cc-by-nc": 0.8, "cc-by-nd": 0.8, "sspl": 0.8, "busl": 0.8, "licenseref": 0.8,
    "reserved": 1.0, "proprietary": 1.0,
}
#: An exception makes a licence at most as strict as this.
EXCEPTED = 0.4
OPERATORS = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(rb"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
LEAD = re.compile(rb"[\"'>\]]{0,2}[ \t]{0,8}[:=][ \t]{0,8}[\"']?")


def family(identifier: str) -> str | None:
    """The family that an identifier in lower case belongs to, if any."""
    name = identifier.rstrip("+")
    while name:
        if name in FAMILIES:
            return name
        name = name.rpartition("-")[0]
    return None


def strictness(label: str) -> float:
    found = family(label)
    return 0.0 if found is None else FAMILIES[found]


@dataclass(frozen=True)
class Terms:
    """What a licence expression comes to: its text, the licences it names, and how strict it is for
    a user who may choose."""

    text: str
    labels: tuple[str, ...]
    strict: float


def combined(operator: str, left: float, right: float) -> float:
    """Of licences joined by ``or`` the user takes the mildest, by ``and`` all hold; an exception
    behind ``with`` softens a licence."""
    if operator == "with":
        return min(left, EXCEPTED)
    return min(left, right) if operator == "or" else max(left, right)


def reduced(values: list[float], pending: list[str], least: int) -> None:
    """Apply the operators on top that bind at least so strongly, down to an open parenthesis."""
    while pending and pending[-1] != "(" and OPERATORS[pending[-1]] >= least:
        right = values.pop()
        values.append(combined(pending.pop(), values.pop(), right))


def evaluate(raw: bytes, at: int, end: int) -> Terms | None:
    """The longest licence expression that begins at byte ``at``, if any.

    Two stacks, operands and pending operators (shunting-yard): ``with`` binds before ``and``, that
    before ``or``; parentheses as usual, all in any case. The expression ends before the first token
    that cannot go on: an unknown identifier, an operator without operand, the end of the line. If
    something is still open there, the longest whole expression before it counts.
    """
    values, pending, labels = [], [], []
    begin, whole = at, None
    operand, simple, depth = True, False, 0
    while found := TOKEN.match(raw, at, end):
        token = found[1].decode().lower()
        if operand and token == "(" and pending[-1:] != ["with"]:
            pending.append(token)
            depth += 1
        elif operand:
            token = token.rstrip(".:")
            exception = pending[-1:] == ["with"]
            known = "-" in token if exception else token not in OPERATORS and family(token) is not None
            if not known:
                break
            values.append(0.0 if exception else strictness(token))
            if not exception:
                labels.append(token)
            operand, simple = False, not exception
        elif token == ")" and depth:
            reduced(values, pending, 0)
            pending.pop()
            depth -= 1
            simple = False
        elif token in OPERATORS and (token != "with" or simple):
            reduced(values, pending, OPERATORS[token])
            pending.append(token)
            operand = True
        else:
            break
        at = found.end()
        if not operand and not depth:
            # With nothing open, the stacks hold an operator of each strength at most.
            left, waiting = values.copy(), pending.copy()
            reduced(left, waiting, 0)
            whole = at, len(labels), left[0]
    if whole is None:
        return None
    return Terms(raw[begin : whole[0]].decode().strip().rstrip(".:"), tuple(labels[: whole[1]]), whole[2])


def automaton(phrases: list[str]) -> ahocorasick.Automaton:
    """Finds the phrases' words in words with one space before and after each."""
    built = ahocorasick.Automaton()
    for number, phrase in enumerate(phrases):
        built.add_word(f" {phrase} ", number)
    built.make_automaton()
    return built


def found_phrases(words: Words, phrases: list[str], built: ahocorasick.Automaton) -> tuple[np.ndarray, np.ndarray]:
    """Phrase number and first word (of all texts' words) of each place where a phrase stands."""
    text, starts = joined(words)
    # A byte is a character here; so places are places of bytes.
    found = list(built.iter(text.tobytes().decode("latin-1")))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    last, number = np.array(found, np.int64).T
    sizes = np.array([len(p) for p in phrases])
    return number, np.searchsorted(starts, last - sizes[number])


def tagged_terms(words: Words, places: np.ndarray, lengths: np.ndarray) -> list[tuple[int, Terms]]:
    """Text and terms of each licence expression behind the tags whose words begin at ``places``."""
    out, raw = [], words.data.tobytes() if len(places) else b""
    for place, length in zip(places.tolist(), lengths.tolist()):
        row = int(words.row[place])
        end = int(words.bounds[row + 1])
        lead = LEAD.match(raw, int(words.ends[place + length - 1]), end)
        terms = evaluate(raw, lead.end(), end) if lead else None
        if terms:
            out.append((row, terms))
    return out


class Scanner:
    """Scans whole text columns."""

    def __init__(self, base: dict[str, str], phrases: dict[str, str]) -> None:
        self.phrases = [*base, *phrases, *TAGS]
        self.labels = [*base.values(), *phrases.values()]
        self.n_base = len(base)
        self.lengths = np.array([len(p.split()) for p in self.phrases])
        self.folding, self.automaton = folding(), automaton(self.phrases)

    def __call__(self, column: pa.Array) -> list[pa.Array]:
        """n_words, n_base, first_word, last_word, base_labels, labels, expressions, score."""
        words, n = words_of(column, self.folding), len(column)
        number, place = found_phrases(words, self.phrases, self.automaton)
        is_base, is_tag = number < self.n_base, number >= len(self.labels)
        row, at = words.row[place], words.number[place]
        first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
        np.minimum.at(first, row[is_base], at[is_base])
        np.maximum.at(last, row[is_base], at[is_base])
        base: dict[int, set[str]] = {}
        every: dict[int, set[str]] = {}
        strict, expressions = np.zeros(n), {}
        found = np.unique(np.stack([row[~is_tag], number[~is_tag]], axis=1), axis=0)
        for r, p in found.tolist():
            label = self.labels[p]
            every.setdefault(r, set()).add(label)
            if p < self.n_base:
                base.setdefault(r, set()).add(label)
            strict[r] = max(strict[r], strictness(label))
        for r, terms in tagged_terms(words, place[is_tag], self.lengths[number[is_tag]]):
            every.setdefault(r, set()).update(terms.labels)
            expressions.setdefault(r, []).append(terms.text)
            strict[r] = max(strict[r], terms.strict)
        told = last >= 0
        lists = pa.list_(pa.string())
        return [
            pa.array(words.per_row, pa.int64()),
            pa.array(np.bincount(row[is_base], minlength=n), pa.int64()),
            pa.array(first, pa.int64(), mask=~told), pa.array(last, pa.int64(), mask=~told),
            pa.array([sorted(base.get(r, ())) for r in range(n)], lists),
            pa.array([sorted(every.get(r, ())) for r in range(n)], lists),
            pa.array([expressions.get(r, []) for r in range(n)], lists), pa.array(strict),
        ]


def scan_licenses(
    documents: DataFrame, base: dict[str, str] | None = None, phrases: dict[str, str] | None = None
) -> DataFrame:
    """Licence labels of every whole text: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, expressions, score.

    Words are runs of ASCII letters (lower-cased), digits and characters beyond ASCII. An Aho-Corasick
    automaton finds all places where the words of a phrase stand consecutively, overlapping ones too.
    ``base`` phrases are counted (n_base) and placed (first_word, last_word: least and largest number
    of a first word, from 0; null without one). Behind an identifier tag a licence expression is read
    (``evaluate``); its licences become labels. base_labels and labels (base ones among them): sorted,
    each once. score: how much the strictest finding restricts a user, from 0 (nothing found, or
    public domain) to 1 (all rights reserved); an expression counts as what it leaves a user to choose.

    A null or empty text has no words; each row has one row, also with a null or repeated doc_id;
    other columns are dropped; an empty table gives no rows. Ties cannot occur.
    """
    base, phrases = BASE if base is None else base, PHRASES if phrases is None else phrases
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner(base, phrases)
        names = [
            "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "expressions", "score",
        ]
        for batch in batches:
            for part in small_batches(batch, BATCH):
                yield pa.RecordBatch.from_arrays([part.column(0), *scan(part.column(1))], names)

    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(
        run,
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
        "labels array<string>, expressions array<string>, score double",
    )
