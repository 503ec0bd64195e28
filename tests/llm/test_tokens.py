"""Byte-level BPE, token counts and chat formatting against the libraries."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strandline.llm import bpe, chat, token_counts

PATH = public_tokenizers.path(bpe.RANKS)
CODECS = [bpe.Codec(PATH, public_tokenizers.PATTERN, piece, window) for piece, window in ((1, 1), (5, 2), (40, 8))]


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


PARTS = ["the", " the", "'s", "'", "re", "'ll", " ", "  ", "\n", "\t", "\r\n", "a", "Ä", "ß", "日本", "é", "1", "23",
         "!", "?!", " ", "\u0085", " ", "\x1c", "\x00", "😀", "é", "_", "\\"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=60))
def test_tree_equals_library(library, parts):
    text = "".join(parts)
    want = library.encode_ordinary(text)
    for codec in CODECS:
        ids = codec.encode(text)
        assert ids.tolist() == want
        assert codec.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["z" * 5000, " " * 3000 + "x", "日本語" * 900, "a b" * 4000, "'re" * 2000])
def test_long_runs(library, text):
    for codec in CODECS[1:]:
        assert codec.encode(text).tolist() == library.encode_ordinary(text)


def test_round_trip_query(spark, odd, odd_rows, folder, library):
    got = sorted(tuple(r) for r in bpe.op5(spark, folder(documents=odd)).collect() if r.doc_id is not None)
    want = []
    for doc_id, text, *_ in odd_rows:
        if doc_id is None:
            continue
        ids = library.encode_ordinary(text or "")
        packed = np.array(ids, "<u4").tobytes()
        want.append(
            (doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        )
    assert got == sorted(want)


def test_ids_and_texts(spark, odd, odd_rows):
    got = bpe.encoded(odd).collect()
    assert len(got) == len(odd_rows)
    assert sorted(bytes(r.decoded) for r in got) == sorted((r[1] or "").encode() for r in odd_rows)


def test_token_counts(spark, odd, odd_rows, folder):
    library = Tokenizer.from_file(public_tokenizers.path(token_counts.VOCABULARY))
    got = sorted(tuple(r) for r in token_counts.op6(spark, folder(documents=odd)).collect() if r.doc_id is not None)
    want = []
    for doc_id, text, *_ in odd_rows:
        if doc_id is not None:
            n = len(library.encode(text or "", add_special_tokens=False).ids)
            want.append((doc_id, len((text or "").encode()), n, n > 2048))
    assert got == sorted(want)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from([*PARTS, "<|endoftext|>", "<|startoftext|>", "́", "İ", "Σ", "Ａ"]), max_size=30))
def test_counts_equal_library(parts):
    path = public_tokenizers.path(token_counts.VOCABULARY)
    text = "".join(parts)
    want = len(token_counts.tokenizer(path).encode(text, add_special_tokens=False).ids)
    assert token_counts.counter(path).counts([text.encode()]) == [want]


def test_calls_are_balanced_by_bytes():
    parts = [b"x" * n for n in (3, 4, 5, 100, 1, 1)]
    assert [sum(map(len, p)) for p in token_counts.by_bytes(parts, 8)] == [7, 5, 100, 2]


def test_empty(spark, empty, folder):
    where = folder(documents=empty)
    assert bpe.op5(spark, where).collect() == [] and token_counts.op6(spark, where).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["\\", "<turn>", "</turn>", "<says>", "<", ">", "turn>", "/", "\n", "é", "<\\turn>"]), max_size=9))
def test_escape_is_reversible_and_leaves_no_mark(parts):
    text = "".join(parts)
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(mark in escaped for mark in chat.MARKS)


def test_chat(spark, folder):
    rng = random.Random(1)
    pieces = ["hello", "</turn>", "\\", "<turn>", "<says>", "\n", "Ä", "### Assistant:", ""]
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), "".join(rng.choices(pieces, k=5)))
            for c in range(12) for t in range(rng.randint(1, 6))]
    rows += [(20, 0, "assistant", None), (21, None, "user", "x"), (21, 1, "a</turn>", "y"), (None, 0, "user", "no id")]
    rows += [(30, 0, "assistant", "same"), (30, 0, "assistant", "same"), (31, 0, "assistant", "w " * 30_000)]
    rng.shuffle(rows)
    given_rows = [(*r, "clash", b"i") for r in rows]
    df = spark.createDataFrame(given_rows, "conv_id long, turn long, role string, text string, ids string, loss binary")
    got = {r.conv_id: r for r in chat.op8(spark, folder(conversations=df)).collect()}
    rows += [(-7, 0, "user", chat.TRAP), (-7, 1, "assistant", chat.TRAP)]
    groups = {}
    for c, t, role, text in rows:
        groups.setdefault(c, []).append((t if t is not None else -1, role or "", text or ""))
    assert set(got) == set(groups)
    for c, turns in groups.items():
        turns.sort(key=lambda x: x[:2])
        said = "".join(x for _, role, x in turns if role == "assistant")
        r = got[c]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in turns).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        whole = "".join(f"<turn>{chat.escape(a)}<says>{chat.escape(b)}</turn>" for _, a, b in turns)
        assert r.formatted_chars == len(whole)


def test_chat_without_rows(spark, folder):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert [r.conv_id for r in chat.op8(spark, folder(conversations=df)).collect()] == [-7]
