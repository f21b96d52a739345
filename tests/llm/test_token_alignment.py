import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tiersmith.llm import token_alignment
from tiersmith.llm.byte_bpe import byte_characters
from tiersmith.llm.token_alignment import Aligned, aligned_groups, diagonal_splits, groups_of, link_counts, read_file

A_PATH, B_PATH = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def files(spark):
    return read_file(spark, A_PATH), read_file(spark, B_PATH)


def brute_groups(text):
    """``[([a ids], [b ids])]`` of a text by walking both token lists, with plain lists."""
    if not text:
        return []
    a_library = Tokenizer.from_file(A_PATH)
    a_library.encode_special_tokens = True
    b_library = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    in_a = a_library.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(byte_of[c] for c in token)) for i, token in zip(in_a.ids, in_a.tokens, strict=True)]
    b = []
    for i in b_library.encode(text):
        piece = b_library.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if b_library.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = b" " + text.encode()
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return []
    groups, at_a, at_b, own = [], 0, 0, ([], [])
    a.reverse(), b.reverse()
    while a or b:
        if at_a <= at_b:
            i, x = a.pop()
            own[0].append(i)
            at_a += len(x)
        else:
            i, x = b.pop()
            own[1].append(i)
            at_b += len(x)
        if at_a == at_b:
            groups.append(own)
            own = ([], [])
    return groups


def brute(texts):
    every = [brute_groups(text) for text in texts]
    links = [Counter((a, b) for in_a, in_b in groups for a in in_a for b in in_b) for groups in every]
    docs = Counter(pair for own in links for pair in own)
    highest = {}
    for (a, _), n in docs.items():
        highest[a] = max(highest.get(a, 0), n)
    out = []
    for groups, own in zip(every, links, strict=True):
        spelled = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append(
            (
                sum(len(a) for a, _ in groups),
                sum(len(b) for _, b in groups),
                len(groups),
                sum(own.values()),
                sum(n for (a, b), n in own.items() if docs[a, b] == highest[a]),
                sum(n * docs[pair] for pair, n in own.items()),
                hashlib.sha256(spelled.encode()).hexdigest() if groups else "",
            )
        )
    return out


ODD = [
    None,
    "",
    " ",
    "  \n\t ",
    "plain words, and 1234 numbers",
    "Größe naïve 中文字 😀😀 é",
    "a▁b",  # the piece vocabulary's own space
    "<s> </s> <unk> <|endoftext|> <0x41>",
    "\x00\x01 control",
    "x" * 5000,
    " " * 3001,
    "= " * 700,
    "é combining ​ zero width ﻿",
    "plain words, and 1234 numbers",
]


def found(docs, files, **options):
    rows = link_counts(docs, *files, **options).orderBy("doc_id").collect()
    return [tuple(r)[1:] for r in rows]


@pytest.mark.parametrize("small", [False, True])
def test_odd_texts_equal_brute_force(make, files, monkeypatch, small):
    if small:
        for name, value in (("PIECE", 7), ("SLICE_BYTES", 100), ("RANGE_PAIRS", 50), ("LISTED", 3)):
            monkeypatch.setattr(token_alignment, name, value)
    texts = [*ODD, *(" ".join(ODD[4:8]) * 3 for _ in range(3))]
    docs = make([(n, t) for n, t in enumerate(texts)])
    assert found(docs, files, **({"block_bytes": 200} if small else {})) == brute(texts)


def test_given_texts_equal_brute_force(spark, files):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id")
    texts = [r.text for r in docs.select("text").collect()]
    assert found(docs, files, block_bytes=50_000) == brute(texts)


def test_random_ends_give_the_same_groups_whatever_the_pieces():
    draw = random.Random(3)
    for _ in range(300):
        total = draw.randint(1, 60)
        a, b = (sorted({total, *(draw.randint(1, total) for _ in range(draw.randint(0, 30)))}) for _ in range(2))
        cuts = sorted(set(a) & set(b))
        want = [[sum(c < x for c in cuts) for x in side] for side in (a, b)]
        for piece in (1, 2, 3, 5, 100):
            got = groups_of(np.array(a), np.array(b), piece)
            assert [x.tolist() for x in got] == want


def test_diagonals_cut_the_merge_into_equal_pieces():
    a, b = np.array([2, 4, 6, 8, 9]), np.array([1, 4, 5, 9])
    at_a, at_b = diagonal_splits(a, b, np.arange(10))
    merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
    for steps in range(10):
        assert at_a[steps] == sum(side == 0 for _, side in merged[:steps])
        assert at_a[steps] + at_b[steps] == steps
    one, other = diagonal_splits(np.array([1, 2, 3]), np.array([], np.int64), np.arange(4))
    assert one.tolist() == [0, 1, 2, 3] and other.tolist() == [0, 0, 0, 0]


def test_groups_are_stretches_of_the_text(make, files):
    rows = aligned_groups(make([(n, t) for n, t in enumerate(ODD)]), *files, keep=("doc_id", "score")).collect()
    known = token_alignment.Vocabularies(*files)
    for r in rows:
        want = brute_groups(ODD[r.doc_id])
        assert [(g.a, g.b) for g in r.groups] == want and r.score == "y"
        raw = b" " + (ODD[r.doc_id] or "").encode()
        for g in r.groups:
            assert raw[g.begin : g.end] == b"".join(known.a_bytes[i] for i in g.a) == b"".join(known.b_bytes[i] for i in g.b)


def test_large_groups_are_counted_by_id(files, monkeypatch):
    known = token_alignment.Vocabularies(*files)
    encoded = known.encode([ODD[10], ODD[9], ODD[4]])
    whole = Aligned.of(encoded, known).links(len(known.b_lengths))
    monkeypatch.setattr(token_alignment, "LISTED", 0)
    assert all((x == y).all() for x, y in zip(whole, Aligned.of(encoded, known).links(len(known.b_lengths)), strict=True))


def test_odd_rows_and_empty_tables(make, files, odd_rows):
    rows = link_counts(make(odd_rows), *files, keep=("doc_id", "score", "n")).collect()
    assert len(rows) == len(odd_rows) and {r.score for r in rows} == {"y"}
    assert all(r.n_a == r.n_links == r.count_sum == 0 and r.groups_sha256 == "" for r in rows if r.doc_id in (3, 4))
    assert link_counts(make([]), *files).collect() == []
    assert [tuple(r)[1:] for r in link_counts(make([(1, None)]), *files).collect()] == [(0, 0, 0, 0, 0, 0, "")]


def test_spelling_of_many_texts_at_a_time(monkeypatch):
    from tiersmith.llm import token_alignment as module

    tokens = [b"a", b"", b"bc", b"\xc3", b"\xa9", b"abc"]
    spelling = module._Spelling(tokens, np.array([len(x) for x in tokens]))
    cases = [([0, 2], b"abc"), ([5], b"abc"), ([], b""), ([0, 2], b"abd"), ([1, 3, 4], "é".encode()), ([1], b""), ([0], b""), ([0, 0], b"a"), ([2, 0], b"abc"), ([0], b"a")]
    for spelled in (1, 2, 1 << 18):
        monkeypatch.setattr(module, "SPELLED", spelled)
        ids, wholes = [np.array(x, np.int64) for x, _ in cases], [whole for _, whole in cases]
        expected = [b"".join(tokens[n] for n in x) == whole for x, whole in cases]
        assert spelling.equals(ids, wholes).tolist() == expected
    assert spelling.equals([], []).tolist() == []
