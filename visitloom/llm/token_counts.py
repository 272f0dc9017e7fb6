"""Token counts by byte-pair merging, without making the tokens."""

from __future__ import annotations

import heapq
import json
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitloom.llm.common import id_and_text, small_batches

# Fixed value: what the split of the vocabulary file takes for a word.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Outside these characters, normal form, lower case or classes may differ between libraries.
PLAIN = regex.compile(r"[\t\n\r\x20-\x7e\xa1-įı-˿]*")
REMEMBERED = 400_000


def merged_length(symbols: list[int], merges: dict[int, tuple[int, int]]) -> int:
    """Symbols that are left when the lowest-ranked adjacent pair is merged until none is left.

    ``merges``: rank and new symbol by ``left << 32 | right``. The neighbours form a linked
    list, the pairs a heap by (rank, place); so equal pairs merge from the left.
    """
    n, symbols = len(symbols), list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        if found := merges.get(symbols[i] << 32 | symbols[i + 1]):
            heap.append(found[0] << 32 | i)
    heapq.heapify(heap)
    left = n
    while heap:
        top = heapq.heappop(heap)
        i, rank = top & 0xFFFFFFFF, top >> 32
        j = after[i]
        if symbols[i] < 0 or j >= n:
            continue
        found = merges.get(symbols[i] << 32 | symbols[j])
        if not found or found[0] != rank:
            continue
        symbols[i], symbols[j] = found[1], -1
        left -= 1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if found := merges.get(symbols[i] << 32 | symbols[k]):
                heapq.heappush(heap, found[0] << 32 | i)
        if (h := before[i]) >= 0 and (found := merges.get(symbols[h] << 32 | symbols[i])):
            heapq.heappush(heap, found[0] << 32 | h)
    return left


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if it prints, else one from U+0100 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(others)) for b in range(256)]


def text_counter(vocabulary: str) -> Callable[[str], int]:
    """A function that counts the tokens of a text, from a vocabulary file of ``tokenizers``."""
    from tokenizers import Tokenizer

    with open(vocabulary, encoding="utf-8") as file:
        told = json.load(file)
    ids, suffix = told["model"]["vocab"], told["model"]["end_of_word_suffix"] or ""
    merges = {
        ids[a] << 32 | ids[b]: (rank, ids[a + b]) for rank, (a, b) in enumerate(map(tuple, told["model"]["merges"]))
    }
    letters = byte_characters()
    inner, last = [ids[c] for c in letters], [ids[c + suffix] for c in letters]
    number = {c: b for b, c in enumerate(letters)}
    specials = sorted((t["content"] for t in told["added_tokens"]), key=len, reverse=True)
    special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
    split = [p["pattern"]["Regex"] for p in told["pre_tokenizer"].get("pretokenizers", []) if p["type"] == "Split"]
    quick = regex.compile(WORDS) if split == [WORDS] else None
    library = Tokenizer.from_file(vocabulary)
    known: dict[bytes | str, int] = {}

    def word(key: bytes | str, raw: bytes) -> int:
        if key not in known:
            if len(known) >= REMEMBERED:
                known.clear()
            symbols = [inner[b] for b in raw]
            symbols[-1] = last[raw[-1]]
            known[key] = merged_length(symbols, merges)
        return known[key]

    def plain(text: str) -> int:
        if quick and PLAIN.fullmatch(text):
            words = Counter(quick.findall(text.lower()))
            return sum(n * (known.get(w) or word(w, w.encode())) for w, n in words.items())
        normal = library.normalizer.normalize_str(text) if library.normalizer else text
        raws = (bytes(number[c] for c in w) for w, _ in library.pre_tokenizer.pre_tokenize_str(normal))
        return sum(word(raw, raw) for raw in raws if raw)

    def count(text: str) -> int:
        if not special or not any(s in text for s in specials):
            return plain(text)
        return sum(plain(part) for part in special.split(text)) + len(special.findall(text))

    return count


def count_tokens(documents: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """Tokens of every whole text: doc_id, n_bytes, n_tokens, over_limit (more than ``limit``).

    Initial symbols minus merges, word by word; words that come again are remembered in the
    task. A special string of the vocabulary counts as one token. A null text is empty and has
    no tokens; a null id stays; repeated rows are counted each; other columns are dropped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = text_counter(vocabulary)
        for batch in batches:
            for part in small_batches(batch):
                tokens = pa.array([count(t) for t in part.column(2).to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), tokens], ["doc_id", "n_bytes", "n_tokens"]
                )

    texts = id_and_text(documents)
    texts = texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    kind = texts.schema["doc_id"].dataType.simpleString()
    counted = texts.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
