"""Chat formatting with loss masks aligned by character offsets."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The marks of the template: <turn>role<text>words</turn>
TURN, TEXT, END = "<turn>", "<text>", "</turn>"
#: A longer conversation is rendered in parts of about so many characters, at turns.
PART = 1 << 18

FORMATTED = "part long, text string, token_ids array<int>, loss array<struct<token_from: int, token_to: int>>"


def escaper(controls: list[str]) -> Callable[[str], str]:
    """Puts a backslash into each control string and doubles the backslashes that are there."""
    found = re.compile("|".join(map(re.escape, sorted(controls, key=len, reverse=True))))
    return lambda text: found.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def spans_to_tokens(spans: list[tuple[int, int]], offsets: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """For each span of characters the range of tokens that overlap it, by binary search.

    Both lists are sorted. A character of several tokens belongs to each of them.
    """
    starts, ends = [a for a, _ in offsets], [b for _, b in offsets]
    found = ((bisect_right(ends, a), bisect_left(starts, b)) for a, b in spans)
    return [(i, j) for i, j in found if i < j]


def tokenizer(vocabulary: str):
    """The library's tokenizer with the marks as tokens of their own, and all control strings."""
    from tokenizers import AddedToken, Tokenizer

    made = Tokenizer.from_file(vocabulary)
    made.no_truncation()
    made.no_padding()
    made.add_special_tokens([AddedToken(mark, normalized=False) for mark in (TURN, TEXT, END)])
    controls = [token.content for token in made.get_added_tokens_decoder().values()]
    return made, controls


def format_conversations(conversations: DataFrame, vocabulary: str, loss_role: str = "assistant") -> DataFrame:
    """Conversations as one text with token ids and a loss mask: conv_id, part, text, token_ids,
    loss (ranges of tokens: what ``loss_role`` says).

    The whole text is encoded once, with offsets; the spans of the turns meet those of the tokens
    by binary search. Marks, and strings that the vocabulary treats as special, are escaped inside
    roles and texts; ``read_turns`` gives them back. The marks are tokens of their own, so the mask
    covers whole texts exactly.

    Turns of a conversation are in order of turn (null first), then role and text; repeated rows are
    repeated turns. A null role or text is empty; rows without conv_id form one conversation; other
    columns are dropped; no rows give no rows. A conversation is one row unless it is longer than
    262,144 characters: then it has several parts, cut between turns, so that a task holds no more
    of it than a part and its longest turn.
    """
    kind = conversations.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, controls = tokenizer(vocabulary)
        escape = escaper(controls)
        id_type = None

        def rendered(conv_id: int | None, part: int, turns: list[tuple[str, str]]) -> pa.RecordBatch:
            text, spans, at = [], [], 0
            for role, words in turns:
                head, body = f"{TURN}{escape(role)}{TEXT}", escape(words)
                if role == loss_role:
                    spans.append((at + len(head), at + len(head) + len(body)))
                text += [head, body, END]
                at += len(head) + len(body) + len(END)
            text = "".join(text)
            encoded = encoder.encode(text, add_special_tokens=False)
            loss = [{"token_from": a, "token_to": b} for a, b in spans_to_tokens(spans, encoded.offsets)]
            span = pa.struct([("token_from", pa.int32()), ("token_to", pa.int32())])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([conv_id], id_type), pa.array([part], pa.int64()), pa.array([text]),
                    pa.array([encoded.ids], pa.list_(pa.int32())), pa.array([loss], pa.list_(span)),
                ],
                ["conv_id", "part", "text", "token_ids", "loss"],
            )

        now, part, turns, size = None, 0, [], 0
        for batch in batches:
            id_type = batch.column(0).type
            for conv_id, role, words in zip(*(c.to_pylist() for c in batch.columns)):
                if turns and (conv_id != now or size > PART):
                    yield rendered(now, part, turns)
                    part, turns, size = part + 1, [], 0
                if conv_id != now:
                    now, part = conv_id, 0
                turns.append((role, words))
                size += len(words)
        if turns:
            yield rendered(now, part, turns)

    said = conversations.select(
        "conv_id", "turn", *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text"))
    )
    said = said.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return said.select("conv_id", "role", "text").mapInArrow(run, f"conv_id {kind}, {FORMATTED}")


def read_turns(text: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted text."""
    turns = []
    for block in text.split(END)[:-1]:
        role, words = block.removeprefix(TURN).split(TEXT, 1)
        turns.append((unescape(role), unescape(words)))
    return turns


def digest_formatted(formatted: DataFrame, vocabulary: str) -> DataFrame:
    """What can be read back from formatted conversations, one row each: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars.

    The texts under the loss mask come from the ids' offsets in the formatted text. The parts of a
    conversation must follow each other in its partition, as ``format_conversations`` leaves them.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = tokenizer(vocabulary)

        def row(conv_id: int | None, kept: list, id_type: pa.DataType) -> pa.RecordBatch:
            n, turns, loss_chars, loss, chars = kept
            values = [conv_id, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars]
            kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

        now, kept, id_type = None, None, None
        for batch in batches:
            id_type = batch.column(0).type
            for conv_id, part, text, ids, loss in zip(*(c.to_pylist() for c in batch.columns)):
                if part == 0:
                    if kept:
                        yield row(now, kept, id_type)
                    now, kept = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, words in read_turns(text):
                    kept[0] += 1
                    kept[1].update(f"{role}\n{words}\n".encode())
                encoded = encoder.encode(text, add_special_tokens=False)
                if encoded.ids != ids:
                    raise ValueError(f"the ids of conversation {conv_id} are not those of its text")
                # Each look at the library's offsets makes the whole list.
                offsets = encoded.offsets
                for span in loss:
                    a, b = offsets[span["token_from"]][0], offsets[span["token_to"] - 1][1]
                    words = unescape(text[a:b])
                    kept[2] += len(words)
                    kept[3].update(words.encode())
                kept[4] += len(text)
        if kept:
            yield row(now, kept, id_type)

    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.mapInArrow(run, schema)
