"""Byte-level BPE encoding and decoding of whole texts with the ``tokenizers`` library.

The vocabulary is a rank file (one base64 token and its rank per line). The
library works on strings, so every byte stands for one printable character, as
byte-level vocabularies do; the ids come back as they would for the bytes.

A text is cut where a space follows and precedes something else than white
space: there every match of the pattern ends, so the pieces can be encoded one
by one, and a piece seen before in the task is not encoded again.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import itertools
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from tiersmith.llm.textcodes import text_of_batch

#: Pieces a task remembers, and the longest one it does: some 20 MB at most.
REMEMBERED = 80_000
REMEMBERED_CHARS = 64
#: Pieces encoded in one call.
JOINED = 1000

_CUT = re.compile(r"(?<=\S) (?=\S)")
_TWO_WHITE = re.compile(r"\s\s")


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if it prints, else one from 256 on."""
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printing else chr(next(spare)) for b in range(256)]


def read_ranks(spark: SparkSession, path: str) -> bytes:
    """The rank file at a path of any store Spark reads, or of the driver."""
    if "://" in path:
        row = spark.read.format("binaryFile").load(path).select("content").first()
        return bytes(row[0])
    with open(path, "rb") as file:
        return file.read()


class Pieces:
    """Encodes texts piece by piece with a byte-level tokenizer, and remembers pieces."""

    def __init__(self, tokenizer: Tokenizer, lengths: np.ndarray) -> None:
        self.tokenizer = tokenizer
        self.lengths = lengths  # bytes of each id
        self.known: dict[str, bytes] = {}

    @staticmethod
    def pieces(text: str) -> list[str]:
        """The text cut before every lone space; the pieces make up the text."""
        if _TWO_WHITE.search(text):
            found = _CUT.split(text)
        else:
            found = text.split(" ")
        return found[:1] + [" " + piece for piece in found[1:]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self.pieces(text) for text in texts]
        every = list(itertools.chain.from_iterable(cut))
        found = list(map(self.known.get, every))
        new = {piece for piece, ids in zip(every, found, strict=True) if ids is None}
        if new:
            encoded = self._encode_pieces(list(new))
            found = [encoded[piece] if ids is None else ids for piece, ids in zip(every, found, strict=True)]
            # Frequent pieces come early, so what is known stays when the room is used up.
            for piece, ids in itertools.islice(encoded.items(), max(0, REMEMBERED - len(self.known))):
                if len(piece) <= REMEMBERED_CHARS:
                    self.known[piece] = ids
        ends = np.cumsum([0, *map(len, cut)]).tolist()
        return [b"".join(found[a:b]) for a, b in itertools.pairwise(ends)]

    def _encode_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of each piece. Pieces with a lone space in front are encoded many at a time."""
        lone, others = [], []
        for piece in pieces:
            safe = len(piece) > 1 and piece[0] == " " and not piece[1].isspace() and not piece[-1].isspace()
            (lone if safe else others).append(piece)
        groups = [lone[at : at + JOINED] for at in range(0, len(lone), JOINED)] + [[piece] for piece in others]
        out = {}
        for at in range(0, len(groups), 100):
            some = groups[at : at + 100]
            encodings = self.tokenizer.encode_batch_fast(["".join(g) for g in some], add_special_tokens=False)
            for group, encoding in zip(some, encodings, strict=True):
                ids = np.array(encoding.ids, "<u4")
                raw = ids.tobytes()
                if len(group) == 1:
                    out[group[0]] = raw
                    continue
                # The bytes that ids stand for tell which piece they belong to.
                reached = np.cumsum(self.lengths[ids])
                ends = np.cumsum([len(piece.encode()) for piece in group])
                cuts = [0, *(4 * (np.searchsorted(reached, ends) + 1)).tolist()]
                out.update((piece, raw[a:b]) for piece, a, b in zip(group, cuts, cuts[1:], strict=False))
        return out


class Codec(Pieces):
    """A byte-level BPE vocabulary: ids of texts, and bytes of ids."""

    def __init__(self, rank_file: bytes, pattern: str) -> None:
        self.bytes_of: list[bytes] = []
        ranks: dict[bytes, int] = {}
        for line in rank_file.splitlines():
            if line:
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        characters = byte_characters()
        spell = lambda token: "".join([characters[b] for b in token])
        vocabulary = {spell(token): rank for token, rank in ranks.items()}
        merges = []
        for token in sorted(ranks, key=ranks.__getitem__):
            # Any two tokens that make up a token may merge, at its rank.
            splits = [(token[:i], token[i:]) for i in range(1, len(token))]
            splits = [s for s in splits if s[0] in ranks and s[1] in ranks]
            splits.sort(key=lambda s: (ranks[s[0]], ranks[s[1]]))
            merges += [(spell(left), spell(right)) for left, right in splits]
        # No cache in the library: pieces are remembered here.
        model = models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True, cache_capacity=0)
        tokenizer = Tokenizer(model)
        tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        super().__init__(tokenizer, np.array([len(token) for token in self.bytes_of]))

    def offsets(self, text: str) -> list[tuple[int, int]]:
        """Each id's span of characters; a character split between ids belongs to all of them."""
        out, at = [], 0
        for piece in self.pieces(text):
            out += [(at + a, at + b) for a, b in self.tokenizer.encode(piece, add_special_tokens=False).offsets]
            at += len(piece)
        return out

    def decode_bytes(self, ids: bytes) -> bytes:
        """The bytes the ids stand for."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode(self, ids: list[int]) -> list[str]:
        """The text of each id in turn; a split character appears with its last id."""
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        last = len(ids) - 1
        return [decoder.decode(self.bytes_of[i], final=n == last) for n, i in enumerate(ids)]


def _groups(texts: pa.Array, limit: int = 1_000_000) -> Iterator[list[str]]:
    """The texts in lists of about ``limit`` characters."""
    held, size = [], 0
    for text in texts:
        held.append(text.as_py() or "")
        size += len(held[-1])
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def _lists(encoded: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(x) // 4 for x in encoded)])
    ids = np.frombuffer(b"".join(encoded), "<u4").astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))


def encode_documents(docs: DataFrame, rank_file: bytes, pattern: str) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every whole text; NULL is empty, without ids."""
    shared = docs.sparkSession.sparkContext.broadcast(rank_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value, pattern)
        for batch in batches:
            at = 0
            for texts in _groups(text_of_batch(batch)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(texts)), _lists(codec.encode(texts))],
                    names=["doc_id", "ids"],
                )
                at += len(texts)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def token_offsets(docs: DataFrame, rank_file: bytes, pattern: str) -> DataFrame:
    """One row per token: ``doc_id``, ``position``, ``begin`` and ``end`` in characters."""
    shared = docs.sparkSession.sparkContext.broadcast(rank_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value, pattern)
        for batch in batches:
            for i, text in enumerate(text_of_batch(batch)):
                spans = codec.offsets(text.as_py() or "")
                if spans:
                    begin, end = zip(*spans, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").take(pa.array([i] * len(spans))),
                            pa.array(range(len(spans)), pa.int64()),
                            pa.array(begin, pa.int64()),
                            pa.array(end, pa.int64()),
                        ],
                        names=["doc_id", "position", "begin", "end"],
                    )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, position long, begin long, end long")


def decode_documents(encoded: DataFrame, rank_file: bytes, pattern: str) -> DataFrame:
    """``doc_id`` and ``text`` of rows with ``ids``; bytes that are not UTF-8 become U+FFFD."""
    shared = encoded.sparkSession.sparkContext.broadcast(rank_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value, pattern)
        for batch in batches:
            texts = [
                None if x is None else codec.decode_bytes(np.array(x, "<u4").tobytes()).decode("utf-8", "replace")
                for x in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(
    docs: DataFrame, rank_file: bytes, pattern: str, keep: Sequence[str] = ("doc_id",), with_ids: bool = False
) -> DataFrame:
    """Digests of every text's ids and of the bytes they decode to.

    Returns per row ``keep``, ``n_tokens``, ``ids_sha256`` (of the ids as
    little-endian unsigned 32-bit integers), ``decoded_sha256`` and, if asked
    for, the ``ids``. NULL and empty texts have no tokens. Other columns are
    ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(rank_file)
    names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]
    out = docs.select(*keep).schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    if with_ids:
        out = out.add("ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value, pattern)
        for batch in batches:
            at = 0
            for texts in _groups(text_of_batch(batch)):
                encoded = codec.encode(texts)
                columns = [batch.column(c).slice(at, len(texts)) for c in keep]
                columns += [
                    pa.array([len(x) // 4 for x in encoded], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in encoded], pa.string()),
                    pa.array([hashlib.sha256(codec.decode_bytes(x)).hexdigest() for x in encoded], pa.string()),
                ]
                if with_ids:
                    columns.append(_lists(encoded))
                yield pa.RecordBatch.from_arrays(columns, names=names)
                at += len(texts)

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, out)
