"""Words of text columns, a whole Arrow column at a time."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from visitloom.llm.common import text_buffer


def folding() -> np.ndarray:
    """By byte: the byte in lower case if it belongs to a word (0-9, A-Z, a-z, all beyond ASCII), else 0."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    keep = np.zeros(256, bool)
    for low, high in (("0", "9"), ("A", "Z"), ("a", "z")):
        keep[ord(low) : ord(high) + 1] = True
    keep[128:] = True
    return np.where(keep, table, 0).astype(np.uint8)


@dataclass
class Words:
    """The words of some texts, in order.

    ``letters``: their bytes, lower-cased, one word after the other; word ``i`` is
    ``letters[cuts[i]:cuts[i + 1]]``, lies in text ``row[i]`` and ends at ``ends[i]`` in ``data``, the
    bytes of all texts, of which text ``r`` has ``bounds[r]:bounds[r + 1]``.
    """

    rows: int
    row: np.ndarray
    cuts: np.ndarray
    letters: np.ndarray
    ends: np.ndarray
    data: np.ndarray
    bounds: np.ndarray

    @property
    def per_row(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows)

    @property
    def number(self) -> np.ndarray:
        """Each word's number in its text, from 0."""
        first = np.cumsum(self.per_row) - self.per_row
        return np.arange(len(self.row)) - first[self.row]


def words_of(column: pa.Array, table: np.ndarray) -> Words:
    """The words of a text column without nulls; ``table`` is ``folding()``."""
    data, offsets = text_buffer(column)
    folded = table[data]
    word = folded != 0
    head = np.zeros(len(data) + 1, bool)
    head[offsets] = True
    before = np.zeros(len(data) + 1, bool)
    before[1:] = word
    # A word begins after another byte or where its text begins, and ends likewise.
    starts = np.flatnonzero(word & (~before[:-1] | head[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | head[1:])) + 1
    row = np.searchsorted(offsets, starts, side="right") - 1
    return Words(len(column), row, np.r_[0, np.cumsum(ends - starts)], folded[word], ends, data, offsets)


def joined(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """All words with one space before and after each, where the texts are parted by more than
    a space; and where each word begins there."""
    breaks = np.cumsum(np.r_[False, words.row[1:] != words.row[:-1]]) if len(words.row) else np.zeros(0, np.int64)
    shift = 1 + np.arange(len(words.row)) + 2 * breaks
    starts = words.cuts[:-1] + shift
    sizes = np.diff(words.cuts)
    text = np.full(int(starts[-1] + sizes[-1]) + 1 if len(starts) else 0, 32, np.uint8)
    text[np.arange(len(words.letters)) + np.repeat(shift, sizes)] = words.letters
    # Two texts are parted by space, line feed, space.
    text[starts[1:][breaks[1:] != breaks[:-1]] - 2] = 10
    return text, starts
