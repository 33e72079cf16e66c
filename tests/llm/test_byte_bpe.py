"""Byte-level tokens against the tiktoken library and against merging whole matches at once."""

import random

import pytest
import tiktoken

from headway.llm import byte_bpe
from headway.llm.queries import vocabulary

PATH = vocabulary("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=byte_bpe.PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={}
    )


def test_pattern_is_the_vocabulary_s_own():
    import public_tokenizers

    assert byte_bpe.PATTERN == public_tokenizers.PATTERN


def test_whole_table(docs, library):
    coded = {r.doc_id: (r.ids, bytes(r.decoded)) for r in byte_bpe.encode_decode(docs, PATH).collect()}
    for row in docs.select("doc_id", "text").collect():
        ids, decoded = coded[row.doc_id]
        assert ids == library.encode_ordinary(row.text or "") and decoded == (row.text or "").encode("utf-8")


def test_random_texts(library):
    r, bpe = random.Random(7), byte_bpe.ByteBPE(byte_bpe.read_ranks(PATH))
    letters = ["ab", "=-", " \n\t\r", "zaq", "漢字かな", "eE é", "0123456789abcdef", "thein gors", "'sdlmtre ", "😀é "]
    texts = ["".join(r.choice(a) for _ in range(r.randrange(300))) for a in letters for _ in range(60)]
    ids, offsets = bpe.encode(texts)
    for text, a, b in zip(texts, offsets, offsets[1:]):
        assert ids[a:b].tolist() == library.encode_ordinary(text)
        assert bpe.decode(ids[a:b].tolist()) == text.encode("utf-8")


def toy(r):
    """A vocabulary of random strings over three letters, with random ranks: also tokens that nothing merges to."""
    words = {"".join(r.choice("abc") for _ in range(r.randrange(2, 7))).encode() for _ in range(40)}
    tokens = [bytes([b]) for b in range(256)] + r.sample(sorted(words), len(words))
    return byte_bpe.ByteBPE({t: k for k, t in enumerate(tokens)})


def test_joining_is_associative_and_equals_merging_at_once():
    r = random.Random(3)
    for _ in range(60):
        bpe = toy(r)
        for _ in range(40):
            data = "".join(r.choice("abc") for _ in range(r.randrange(1, 90))).encode()
            at_once = bpe.merge(data)
            assert bpe.encode_bytes(data) == at_once
            if len(data) > 1:
                cut = r.randrange(1, len(data))
                assert bpe.join(bpe.encode_bytes(data[:cut]), bpe.merge(data[cut:])) == at_once
                assert bpe.decode(at_once) == data


def test_both_ways_of_merging_agree():
    """Windows under and from 64 bytes are merged by different loops."""
    r = random.Random(5)
    for _ in range(100):
        bpe = toy(r)
        data = "".join(r.choice("abc") for _ in range(200)).encode()
        parts = [data[i : i + 1] for i in range(len(data))]
        while True:
            found = [bpe.ranks.get(a + b, 1 << 30) for a, b in zip(parts, parts[1:])]
            if not found or min(found) == 1 << 30:
                break
            i = found.index(min(found))
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert bpe.merge(data) == [bpe.ranks[p] for p in parts]
        assert bpe.merge(data[:63]) == bpe.encode_bytes(data[:63])


def test_small_caches_and_blocks_change_nothing(monkeypatch, library):
    for name, value in {"CACHE_WORDS": 50, "CACHE_PARTS": 30, "BLOCK": 7, "LONG": 4}.items():
        monkeypatch.setattr(byte_bpe, name, value)
    r, bpe = random.Random(2), byte_bpe.ByteBPE(byte_bpe.read_ranks(PATH))
    texts = ["", " ".join("".join(r.choice("retain") for _ in range(r.randrange(1, 9))) for _ in range(200)), "", "a b", "x" * 40]
    ids, offsets = bpe.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [library.encode_ordinary(t) for t in texts]


def test_odd_rows(odd, library):
    coded = byte_bpe.encode_decode(odd, PATH).collect()
    assert len(coded) == 13
    assert sorted((r.doc_id or 0, len(r.ids), bytes(r.decoded)) for r in coded if len(r.decoded) < 400) == sorted(
        (r.doc_id or 0, len(library.encode_ordinary(r.text or "")), (r.text or "").encode())
        for r in odd.collect()
        if len(r.text or "") < 400
    )
    assert {len(r.ids) for r in coded if r.doc_id == 9} == {150_000}  # "zz" is the longest token of z alone
    assert byte_bpe.encode_decode(odd.limit(0), PATH).count() == 0
