"""BPE by shared chunks against the tokenizers library."""

import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strandline.llm import chunk_bpe

PATH = public_tokenizers.path(chunk_bpe.VOCABULARY)
PARTS = ["the", " the", "'s", "'", "re", "'ll", " ", "  ", "\n", "\t", "\r\n", "a", "Ä", "ß", "日本", "é", "1", "23", "!",
         "?!", " ", "\u0085", "\x1c", "\x00", "😀", "_", "\\", "<|endoftext|>", "<|endof", "text|>", "Ġ", "word " * 9]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return chunk_bpe.Vocabulary(PATH, window=2)


def want(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), max_size=6), st.booleans())
def test_joined_parts_equal_the_whole(library, own, texts, ahead):
    parts = [t.encode() for t in texts if t]
    known = {chunk_bpe.name(p): own.pack(own.leaf(p.decode())) for p in parts[::2]} if ahead else {}
    ids = own.encode(parts, known)
    assert ids == want(library, "".join(texts))
    assert own.decode(ids) == "".join(texts).encode()


def test_wrong_ids_are_noticed(library, own):
    parts = [b"one passage", b" and another"]
    assert own.encode(parts, {chunk_bpe.name(parts[0]): own.pack([5, 6, 7])}) == want(library, "one passage and another")


@pytest.mark.parametrize("text", ["z" * 9000, " " * 4000 + "x", "日本語" * 900, "a b" * 4000, "'re" * 2000, "é\n" * 800])
def test_long_runs(library, own, text):
    data = text.encode()
    cuts = [0, *(i for i in range(100, len(data), 100) if data[i] & 0xC0 != 0x80), len(data)]
    assert own.encode([data[a:b] for a, b in zip(cuts, cuts[1:])], {}) == want(library, text)


def test_cuts_follow_the_content(odd_rows):
    passage = max((r[1] for r in odd_rows if r[1] and " " in r[1]), key=len).encode()
    alone, behind, empty = chunk_bpe.chunks([passage, b"something else entirely " * 40 + passage, b""])
    assert empty == [] and b"".join(alone) == passage
    assert len(alone) > 50 and len(set(alone) & set(behind)) >= len(set(alone)) - 2
    sizes = [len(c) for c in alone[:-1]]
    assert min(sizes) >= chunk_bpe.LEAST


def test_query(spark, odd, odd_rows, folder, library):
    got = sorted(tuple(r) for r in chunk_bpe.op11(spark, folder(documents=odd)).collect() if r.doc_id is not None)
    rows = []
    for doc_id, text, *_ in odd_rows:
        ids = want(library, text)
        back = library.decode(ids, skip_special_tokens=False)
        hashes = (hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), back))
        rows.append((doc_id, len(ids), *hashes))
    assert got == sorted(r for r in rows if r[0] is not None)


def test_without_broadcasts_and_with_clashing_columns(spark, clashing, odd_rows, library, monkeypatch):
    from strandline.llm import common

    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    got = chunk_bpe.encoded(spark, clashing).collect()
    expected = sorted((want(library, r[1]), (r[1] or "").encode()) for r in odd_rows)
    assert sorted((r.ids, bytes(r.decoded)) for r in got) == expected


def test_shared_chunks_are_encoded_once(spark, odd):
    path, pattern = PATH, public_tokenizers.PATTERN
    known = chunk_bpe.with_known_ids(spark, odd, path, pattern).filter("known IS NOT NULL").collect()
    assert known
    by_name = {}
    for r in known:
        names = {chunk_bpe.name(c) for c in chunk_bpe.chunks([r.text.encode()])[0]}
        assert {bytes(x.chunk) for x in r.known} <= names
        for x in r.known:
            by_name.setdefault(bytes(x.chunk), set()).add(bytes(x.ids))
    assert all(len(v) == 1 for v in by_name.values())


def test_empty(spark, empty, folder):
    assert chunk_bpe.op11(spark, folder(documents=empty)).collect() == []
