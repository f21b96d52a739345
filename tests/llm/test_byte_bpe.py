import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tiersmith.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def codec(ranks):
    return byte_bpe.Codec(ranks, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(ranks):
    known = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})


def ids(encoded):
    return np.frombuffer(encoded, "<u4").tolist()


ALPHABETS = ["ab", "aA=-", "  a\n", "abcde   \n", "eéöß中文 1'sS#$%", " \t\n\r\x0b\x0c\x1c\x85\xa0 ab1", " '\"st\n", "😀é̈a "]


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_ids_equal_the_library(codec, reference, alphabet):
    draw = random.Random(alphabet)
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randrange(60))) for _ in range(1500)]
    for text, encoded in zip(texts, codec.encode(texts), strict=True):
        assert ids(encoded) == reference.encode_ordinary(text), text
        assert codec.decode_bytes(encoded) == text.encode()


def test_long_runs_and_words(codec, reference):
    texts = [c * n for c in "a=- \n" for n in (1, 2, 3, 50, 1000)] + [" ".join(f"w{i}" for i in range(20_000))]
    for text, encoded in zip(texts, codec.encode(texts), strict=True):
        assert ids(encoded) == reference.encode_ordinary(text)


def test_what_is_remembered_makes_no_difference(ranks, monkeypatch):
    texts = [f"word{i} again {i % 7} and\n again" for i in range(500)]
    full = byte_bpe.Codec(ranks, public_tokenizers.PATTERN).encode(texts)
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    small = byte_bpe.Codec(ranks, public_tokenizers.PATTERN)
    assert small.encode(texts) == full and len(small.known) <= 3


def test_split_characters_have_offsets_and_decode(codec):
    text = "Größe 😀x"
    encoded = ids(codec.encode([text])[0])
    spans = codec.offsets(text)
    assert len(spans) == len(encoded)
    assert [text[a:b] for a, b in spans if b - a > 1 or text[a] != "😀"] == ["Gr", "ö", "ße", " 😀", "x"]
    assert "".join(codec.decode(encoded)) == text
    # A character cut off at the end is replaced, not lost silently.
    assert codec.decode(ids(codec.encode(["😀"])[0])[:1]) == ["�"]


def test_round_trip_of_odd_rows(make, odd_rows, ranks, reference):
    docs = make(odd_rows)
    rows = byte_bpe.round_trip(docs, ranks, public_tokenizers.PATTERN).collect()
    want = []
    for doc_id, text, _ in odd_rows:
        own = reference.encode_ordinary(text or "")
        want.append((doc_id, len(own), hashlib.sha256(np.array(own, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)


def test_documents_encode_and_decode(make, odd_rows, ranks):
    docs = make(odd_rows)
    encoded = byte_bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode_documents(encoded, ranks, public_tokenizers.PATTERN).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, decoded), key=key) == sorted([(i, t or "") for i, t, _ in odd_rows], key=key)
    tokens = byte_bpe.token_offsets(docs.where("doc_id = 7"), ranks, public_tokenizers.PATTERN).collect()
    assert [(t.position, t.begin, t.end) for t in tokens] == [(0, 0, 4), (1, 4, 9)]


def test_empty_table(make, ranks):
    assert byte_bpe.round_trip(make([]), ranks, public_tokenizers.PATTERN, with_ids=True).count() == 0
