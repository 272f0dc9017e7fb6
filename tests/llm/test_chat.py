"""Chat formatting: exact round trips and masks."""

from __future__ import annotations

import hashlib
import time

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from visitloom.llm import chat

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string"
ADDED = r"\### Assistant: </turn> ok"


def digests(rows):
    """By conversation, what must be read back."""
    big, out = -(1 << 62), {}
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0], big if r[1] is None else r[1], r[2] or "", r[3] or ""))
    for conv_id, _, role, text in rows:
        n, turns, loss = out.get(conv_id, (0, "", ""))
        role, text = role or "", text or ""
        out[conv_id] = n + 1, turns + f"{role}\n{text}\n", loss + text * (role == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return {c: (n, sha(t), len(x), sha(x)) for c, (n, t, x) in out.items()}


def got(spark, rows):
    formatted = chat.format_conversations(spark.createDataFrame(rows, SCHEMA), VOCABULARY)
    return {r[0]: tuple(r[1:5]) for r in chat.digest_formatted(formatted, VOCABULARY).collect()}


def test_round_trip(spark):
    rows = [
        (1, 0, "system", "be <turn> kind"), (1, 1, "user", ADDED), (1, 2, "assistant", ADDED + " <text> \\"), (1, 3, "user", None),
        (1, 4, "assistant", "\n  two words\n"), (2, 0, "assistant", ""), (2, 0, "assistant", "tie"), (2, None, "user", "first"),
        (None, 1, "assistant", "é<|endoftext|>\\<|endoftext|> 漢字 \U0001f600"), (None, 0, None, "x"), (3, 1, "a<text>b", "<\\turn>"),
        (4, 1, "assistant", "same"), (4, 1, "assistant", "same"), (5, 0, "user", " "), (6, 0, "assistant", "<" + "/turn" * 3 + ">"),
    ]
    assert got(spark, rows) == digests(rows)


def test_long_conversations_have_parts(spark):
    rows = [(9, i, "assistant" if i % 2 else "user", f"{i} " + "long text, é. " * 4000) for i in range(12)]
    formatted = chat.format_conversations(spark.createDataFrame(rows, SCHEMA), VOCABULARY)
    assert formatted.count() > 1
    assert got(spark, rows) == digests(rows)


def test_no_rows_and_other_columns(spark):
    assert got(spark, []) == {}
    rows = spark.createDataFrame([(1, 0, "user", "t", 5, "x")], SCHEMA + ", part long, loss string")
    assert [r[1] for r in chat.digest_formatted(chat.format_conversations(rows, VOCABULARY), VOCABULARY).collect()] == [1]


CONTROLS = [chat.TURN, chat.TEXT, chat.END, "<|endoftext|>"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*CONTROLS, "\\", "<", "/", "turn>", "t", "\n", "é"]), max_size=12).map("".join))
def test_escape_is_reversible(text):
    escaped = chat.escaper(CONTROLS)(text)
    assert chat.unescape(escaped) == text
    assert not any(c in escaped for c in CONTROLS)


def test_mask_by_hand():
    offsets = [(0, 2), (2, 5), (5, 5), (5, 9), (9, 10)]
    assert chat.spans_to_tokens([(2, 5), (6, 10)], offsets) == [(1, 2), (3, 5)]
    assert chat.spans_to_tokens([(5, 5)], [(0, 5), (5, 9)]) == []


def test_many_turns_take_time_in_proportion(spark):
    rows = [(1, n, "user" if n % 2 == 0 else "assistant", f"turn {n} says a few words") for n in range(20_000)]
    start = time.perf_counter()
    assert got(spark, rows) == digests(rows)
    assert time.perf_counter() - start < 60
