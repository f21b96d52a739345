"""Cross-tokenizer alignment by merge-path partitioning of token ends.

Two tokenizers, A and B, cut the same bytes in different places. Where a token
of A and one of B end at the same byte both have a cut, and the tokens between
two such cuts make up a group: the least stretches that both can spell.

The ends of both tokenizations are two rising lists, and their merged order is
cut into pieces of equally many steps, whatever document they belong to: a
binary search along each diagonal finds how many ends of A and of B come
before it. Each piece is merged by itself and gives the overlaps of an A and a
B token in it, and which of them end a group; a group that goes on over the end
of a piece is stitched by the number of groups that ended before it.

Two ids are linked where their tokens share a group. How many documents hold an
id pair linked is counted over the whole corpus: blocks of documents send their
distinct pairs to the tasks that own a range of pairs, which add up all blocks
and answer each. The number of ranges follows the number of pairs sent.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tiersmith.llm.byte_bpe import Pieces, byte_characters
from tiersmith.llm.packing import pack, repeats, unpack
from tiersmith.llm.textcodes import mix, sorted_distinct
from tiersmith.session import stage

#: Bytes of text in a block, and in what is aligned at a time; a longer text is both by itself.
BLOCK_BYTES = 6_000_000
SLICE_BYTES = 1_000_000
#: Steps of the merge in a piece.
PIECE = 1 << 16
#: Tokens that are spelled at a time.
SPELLED = 1 << 18
#: Links of a group that are listed one by one; those of a larger group are counted by id.
LISTED = 4096
#: Pairs that the owner of a range should have to add up.
RANGE_PAIRS = 1_000_000

_NO_INTS = np.zeros(0, np.int64)


class Vocabularies:
    """The two tokenizers, and the bytes of each of their tokens."""

    def __init__(self, a_file: bytes, b_file: bytes) -> None:
        self.a = Tokenizer.from_str(a_file.decode())
        # Their strings in a text are then ordinary text.
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        byte_of = {char: byte for byte, char in enumerate(byte_characters())}
        spelled = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(spelled.values()) + 1)
        for token, number in spelled.items():
            # Special tokens need not be spelled in byte characters; they do not come up.
            self.a_bytes[number] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.b_bytes = [self._piece(n) for n in range(self.b.get_piece_size())]
        self.a_lengths = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_lengths = np.array([len(x) for x in self.b_bytes], np.int64)
        self._pieces = Pieces(self.a, self.a_lengths)
        self._a_spelling = _Spelling(self.a_bytes, self.a_lengths)
        self._b_spelling = _Spelling(self.b_bytes, self.b_lengths)

    def _piece(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        if self.b.is_byte(number):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The ids of both for each text behind a space; none where either does not spell it."""
        asked = [text or "" for text in texts]
        in_a = [np.frombuffer(ids, "<u4").astype(np.int64) for ids in self._pieces.encode([" " + x for x in asked])]
        in_b = [np.array(ids, np.int64) for ids in self.b.encode(asked, num_threads=1)]
        wholes = [b" " + text.encode() if text else b"" for text in asked]
        same = self._a_spelling.equals(in_a, wholes) & self._b_spelling.equals(in_b, wholes)
        return [(a, b) if whole and equal else (_NO_INTS, _NO_INTS) for a, b, whole, equal in zip(in_a, in_b, wholes, same.tolist(), strict=True)]


class _Spelling:
    """The bytes of a vocabulary's tokens, to spell many tokens at a time."""

    def __init__(self, tokens: list[bytes], lengths: np.ndarray) -> None:
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.lengths = lengths
        self.begins = np.cumsum(lengths) - lengths

    def equals(self, ids: list[np.ndarray], wholes: list[bytes]) -> np.ndarray:
        """Whether the tokens of each text spell it."""
        every = np.concatenate([_NO_INTS, *ids])
        ends = np.append(0, np.cumsum(self.lengths[every]))[np.cumsum([0, *map(len, ids)])]
        equal = np.diff(ends) == np.array([len(whole) for whole in wholes], np.int64)
        # Texts of other lengths are left out, so the bytes of the rest stand side by side.
        every = np.concatenate([_NO_INTS, *(x for x, same in zip(ids, equal.tolist(), strict=True) if same)])
        meant = np.frombuffer(b"".join(w for w, same in zip(wholes, equal.tolist(), strict=True) if same), np.uint8)
        left = np.flatnonzero(equal)
        text_ends, done = np.cumsum([len(wholes[n]) for n in left.tolist()], dtype=np.int64), 0
        for at in range(0, len(every), SPELLED):
            some = every[at : at + SPELLED]
            size = self.lengths[some]
            total = int(size.sum())
            place = np.repeat(self.begins[some] - np.cumsum(size) + size, size) + np.arange(total)
            other = np.flatnonzero(self.flat[place] != meant[done : done + total])
            equal[left[np.searchsorted(text_ends, done + other, "right")]] = False
            done += total
        return equal


def diagonal_splits(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many of ``a`` and of ``b`` are among the first steps of their merge, for each number of steps.

    Both rise strictly; of equal values that of ``a`` comes first.
    """
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while (searching := np.flatnonzero(low < high)).size:
        middle = (low[searching] + high[searching]) // 2
        early = a[middle] <= b[diagonals[searching] - middle - 1]
        low[searching[early]] = middle[early] + 1
        high[searching[~early]] = middle[~early]
    return low, diagonals - low


def merge_piece(
    a: np.ndarray, b: np.ndarray, own_a: slice, own_b: slice
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The overlaps of a piece in order: token of A, token of B, and whether both end there."""
    i = np.arange(own_a.start, own_a.stop)
    j = np.arange(own_b.start, own_b.stop)
    # The token of the other side that holds the last byte before each end.
    b_at = own_b.start + np.searchsorted(b[own_b], a[own_a], "left")
    a_at = own_a.start + np.searchsorted(a[own_a], b[own_b], "right")
    closes = np.zeros(len(i) + len(j), bool)
    overlap_a, overlap_b = np.empty(len(closes), np.int64), np.empty(len(closes), np.int64)
    place = (i - own_a.start) + (b_at - own_b.start)
    overlap_a[place], overlap_b[place] = i, b_at
    closes[place] = b[np.minimum(b_at, len(b) - 1)] == a[own_a]
    place = (j - own_b.start) + (a_at - own_a.start)
    overlap_a[place], overlap_b[place] = a_at, j
    # An end of both is one step of A already, which may be in the piece before.
    again = np.zeros(len(closes), bool)
    again[place] = (a_at > 0) & (a[np.maximum(a_at, 1) - 1] == b[own_b])
    return overlap_a[~again], overlap_b[~again], closes[~again]


def groups_of(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """The number of the group of each token, from the rising ends of both; the last ends are equal."""
    in_a, in_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    steps = len(a) + len(b)
    diagonals = np.append(np.arange(0, steps, piece), steps)
    at_a, at_b = diagonal_splits(a, b, diagonals)
    ended = 0
    for k in range(len(diagonals) - 1):
        of_a, of_b, closes = merge_piece(a, b, slice(at_a[k], at_a[k + 1]), slice(at_b[k], at_b[k + 1]))
        # Stitched: what is open at the end of a piece goes on under the same number.
        group = ended + np.cumsum(closes) - closes
        in_a[of_a], in_b[of_b] = group, group
        ended += int(closes.sum())
    return in_a, in_b


def _written(most: int) -> np.ndarray:
    """Each number up to ``most`` in decimal characters with a comma, zero bytes for leading zeros."""
    numbers, digits = np.arange(most + 1), len(str(most))
    rows = np.zeros((most + 1, digits + 1), np.uint8)
    rows[:, digits] = ord(",")
    for k in range(digits):
        rest = numbers // 10 ** (digits - 1 - k)
        rows[:, k] = np.where((rest > 0) | (k == digits - 1), 48 + rest % 10, 0)
    return rows


@dataclass
class Aligned:
    """Texts in a row with their tokens and groups."""

    a: np.ndarray  # ids of all texts
    b: np.ndarray
    n_a: np.ndarray  # of each text
    n_b: np.ndarray
    group_a: np.ndarray  # of each token
    group_b: np.ndarray
    group_doc: np.ndarray  # of each group

    @classmethod
    def of(cls, encoded: list[tuple[np.ndarray, np.ndarray]], known: Vocabularies, piece: int = PIECE) -> Aligned:
        a, b = (np.concatenate([_NO_INTS, *(pair[side] for pair in encoded)]) for side in (0, 1))
        n_a, n_b = (np.array([len(pair[side]) for pair in encoded], np.int64) for side in (0, 1))
        # One text after the other: every text ends with an end of both.
        group_a, group_b = groups_of(np.cumsum(known.a_lengths[a]), np.cumsum(known.b_lengths[b]), piece)
        docs = np.repeat(np.arange(len(encoded)), n_a)
        return cls(a, b, n_a, n_b, group_a, group_b, docs[repeats(group_a)[0]])

    def __post_init__(self) -> None:
        n = len(self.group_doc)
        self.size_a, self.size_b = np.bincount(self.group_a, minlength=n), np.bincount(self.group_b, minlength=n)
        self.first_a = np.cumsum(self.size_a) - self.size_a
        self.first_b = np.cumsum(self.size_b) - self.size_b

    def by_doc(self, values: np.ndarray) -> np.ndarray:
        """Sums over the groups of each text."""
        out = np.zeros(len(self.n_a), np.int64)
        np.add.at(out, self.group_doc, values)
        return out

    def links(self, b_size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, id pair (``a * b_size + b``) and times linked, of each pair in each text, in order."""
        large = np.flatnonzero(self.size_a * self.size_b > LISTED)
        listed = np.ones(len(self.group_doc), bool)
        listed[large] = False
        i = np.flatnonzero(listed[self.group_a])
        group = self.group_a[i]
        times = self.size_b[group]
        j = np.repeat(self.first_b[group] - np.cumsum(times) + times, times) + np.arange(times.sum())
        wide = int(self.a.max(initial=0) + 1) * b_size
        keys = np.repeat(self.group_doc[group] * wide + self.a[i] * b_size, times) + self.b[j]
        keys.sort()
        at, counts = repeats(keys)
        keys = keys[at]
        if len(large):
            more = [(keys, counts)]
            for g in large.tolist():
                a, in_a = np.unique(self.a[self.first_a[g] :][: self.size_a[g]], return_counts=True)
                b, in_b = np.unique(self.b[self.first_b[g] :][: self.size_b[g]], return_counts=True)
                pairs = (self.group_doc[g] * wide + a[:, None] * b_size + b).ravel()
                more.append((pairs, (in_a[:, None] * in_b).ravel()))
            keys, which = np.unique(np.concatenate([x for x, _ in more]), return_inverse=True)
            counts = np.zeros(len(keys), np.int64)
            np.add.at(counts, which, np.concatenate([x for _, x in more]))
        return keys // wide, keys % wide, counts

    def spellings(self) -> list[bytes]:
        """The groups of each text as ``a1,a2|b1;a3|b2,b3``."""
        at_a = np.arange(len(self.a)) + self.first_b[self.group_a]
        at_b = np.arange(len(self.b)) + (self.first_a + self.size_a)[self.group_b]
        written = _written(max(int(x.max(initial=0)) for x in (self.a, self.b)))
        rows = np.empty((len(self.a) + len(self.b), written.shape[1]), np.uint8)
        rows[at_a], rows[at_b] = written[self.a], written[self.b]
        rows[at_a[self.first_a + self.size_a - 1], -1] = ord("|")
        rows[at_b[self.first_b + self.size_b - 1], -1] = ord(";")
        # Counted for each number once and not for each token.
        width = (written != 0).sum(axis=1)
        size = np.empty(len(rows), np.int64)
        size[at_a], size[at_b] = width[self.a], width[self.b]
        tokens = np.cumsum(self.n_a + self.n_b)
        ends = np.append(0, np.cumsum(size))[tokens]
        flat = rows.ravel()
        flat = flat[flat != 0].tobytes()
        begins = np.append(0, ends[:-1])
        return [flat[a : max(a, b - 1)] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]


def _texts(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[int, list[str | None]]]:
    """The texts of a batch in lists of about ``limit`` bytes, with the number of the first."""
    texts = batch.column("__text")
    sizes = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        done = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + limit, "right")))
        yield at, texts.slice(at, to - at).to_pylist()
        at = to


def _vocabularies(files: tuple[bytes, bytes]) -> Vocabularies:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Vocabularies(*files)


def read_file(spark: SparkSession, path: str) -> bytes:
    """A vocabulary file at a path of any store Spark reads, or of the driver."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    with open(path, "rb") as file:
        return file.read()


def _named(names: list[str], docs: DataFrame) -> DataFrame:
    return docs.select(*names, F.col("text").alias("__text"))


def aligned_groups(docs: DataFrame, a_file: bytes, b_file: bytes, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The groups of each whole text: per row ``keep`` and ``groups``.

    A group has ``begin`` and ``end`` (bytes of the text behind one space) and the
    ids ``a`` and ``b``. Texts that are NULL, empty, or not spelled alike by both
    tokenizers have none. Every row gives one row; other columns are ignored.
    """
    names = list(dict.fromkeys(keep))
    ids = T.ArrayType(T.IntegerType())
    group = T.StructType().add("begin", "long").add("end", "long").add("a", ids).add("b", ids)
    schema = T.StructType([*docs.select(*names).schema.fields, T.StructField("groups", T.ArrayType(group))])
    shared = docs.sparkSession.sparkContext.broadcast((a_file, b_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _vocabularies(shared.value)
        for batch in batches:
            for at, texts in _texts(batch, SLICE_BYTES):
                found = Aligned.of(known.encode(texts), known)
                n_groups = found.by_doc(np.ones(len(found.group_doc), np.int64))
                ends = np.cumsum(known.a_lengths[found.a])[found.first_a + found.size_a - 1]
                begins = np.append(0, ends)[:-1]
                base = np.append(0, np.cumsum(np.bincount(found.group_doc, ends - begins, len(texts))))[found.group_doc]
                lists = [
                    pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(x, pa.int32()))
                    for size, x in ((found.size_a, found.a), (found.size_b, found.b))
                ]
                base = base.astype(np.int64)
                each = pa.StructArray.from_arrays([pa.array(begins - base), pa.array(ends - base), *lists], names=group.names)
                groups = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n_groups)), pa.int32()), each)
                kept = [batch.column(k).slice(at, len(texts)) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays([*kept, groups], names=schema.names)

    return _named(names, docs).mapInArrow(run, schema)


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _blocks(shared, names: list[str], block_bytes: int):
    """Rows ``(block, rows, pairs, links, n_pairs)``: some texts with their distinct pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _vocabularies(shared.value)
        b_size = len(known.b_lengths)
        number, size, held = TaskContext.get().partitionId() << 32, 0, []

        def flush() -> pa.RecordBatch:
            rows = pa.Table.from_batches([x for x, _ in held]).combine_chunks()
            pairs = np.concatenate([links[1] for _, links in held])
            known_pairs = sorted_distinct(pairs)
            place = np.searchsorted(known_pairs, pairs)
            n_pairs = np.concatenate([np.bincount(links[0], minlength=len(x)) for x, links in held])
            # Places rise within a text, so their steps are small.
            steps = np.diff(place, prepend=0)
            first = np.cumsum(n_pairs) - n_pairs
            steps[first[n_pairs > 0]] = place[first[n_pairs > 0]]
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(rows)
            times = np.concatenate([links[2] for _, links in held])
            docs = np.bincount(place, minlength=len(known_pairs))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number]),
                    pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                    pa.array([pack({"steps": np.diff(known_pairs, prepend=0), "docs": docs})], pa.binary()),
                    pa.array([pack({"n_pairs": n_pairs, "steps": steps, "times": times})], pa.binary()),
                    pa.array([len(known_pairs)], pa.int64()),
                ],
                names=["block", "rows", "pairs", "links", "n_pairs"],
            )

        for batch in batches:
            for at, texts in _texts(batch, SLICE_BYTES):
                found = Aligned.of(known.encode(texts), known)
                digests = [hashlib.sha256(x).hexdigest() if x else "" for x in found.spellings()]
                counts = [
                    found.n_a,
                    found.n_b,
                    found.by_doc(np.ones(len(found.group_doc), np.int64)),
                    found.by_doc(found.size_a * found.size_b),
                ]
                kept = [batch.column(k).slice(at, len(texts)) for k in range(len(names))]
                columns = [*kept, *map(pa.array, counts), pa.array(digests, pa.string())]
                rows = pa.RecordBatch.from_arrays(columns, names=[*names, *_COUNTS, "groups_sha256"])
                held.append((rows, found.links(b_size)))
                size += sum(len(text or "") for text in texts)
                if size >= block_bytes:
                    yield flush()
                    number, size, held = number + 1, 0, []
        if held:
            yield flush()

    return run


def _pairs(packed: pa.Scalar, n_ranges: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A block's pairs range by range, the documents of each, their order, and each range's end."""
    lists = unpack(packed)
    pairs = np.cumsum(lists["steps"].to_numpy().astype(np.int64))
    owner = (mix(pairs.view(np.uint64)) % np.uint64(n_ranges)).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    ends = np.cumsum(np.bincount(owner, minlength=n_ranges))
    return pairs[order], lists["docs"].to_numpy()[order], order, ends


def _requests(n_ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("pairs"), strict=True):
                pairs, docs, _, ends = _pairs(packed, n_ranges)
                begins = np.append(0, ends[:-1])
                some = np.flatnonzero(ends > begins)
                sent = [
                    pack({"steps": np.diff(pairs[a:b], prepend=0), "docs": docs[a:b]})
                    for a, b in zip(begins[some].tolist(), ends[some].tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int32()), pa.array([block] * len(some), pa.int64()), pa.array(sent, pa.binary())],
                    names=["range", "block", "pairs"],
                )

    return run


def _answers(b_size: int):
    """Corpus-wide counts of the pairs of a range, for every block that asked; block -1 has the highest of each A id."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        number = table.column("range")[0].as_py()
        asked = [unpack(packed) for packed in table.column("pairs")]
        pairs = [np.cumsum(lists["steps"].to_numpy().astype(np.int64)) for lists in asked]
        known = sorted_distinct(np.concatenate(pairs))
        places = [np.searchsorted(known, x) for x in pairs]
        counts = np.zeros(len(known), np.int64)
        for place, lists in zip(places, asked, strict=True):
            counts[place] += lists["docs"].to_numpy()
        a = known // b_size
        first, _ = repeats(a)
        highest = pack({"a": a[first], "highest": np.maximum.reduceat(counts, first)})
        answers = [pack({"counts": counts[place]}) for place in places]
        return pa.table(
            {
                "block": pa.array([*table.column("block").to_pylist(), -1], pa.int64()),
                "range": pa.array([number] * (len(answers) + 1), pa.int32()),
                "counts": pa.array([*answers, highest], pa.binary()),
            }
        )

    return run


def _highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for packed in batch.column("counts"):
            lists = unpack(packed)
            columns = [lists[name].cast(pa.int64()) for name in ("a", "highest")]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "highest"])


def _finish(n_ranges: int, b_size: int, shared, schema: T.StructType):
    def run(answers: pa.Table, block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        rows = pa.ipc.open_stream(block.column("rows")[0].as_buffer()).read_all()
        pairs, _, order, _ = _pairs(block.column("pairs")[0], n_ranges)
        answers = answers.sort_by("range").combine_chunks()
        counts = np.zeros(len(pairs), np.int64)
        if len(pairs):
            found = np.concatenate([unpack(x)["counts"].to_numpy() for x in answers.column("counts")])
            counts[order] = found
        pairs[order] = pairs.copy()
        best = counts == shared.value[pairs // b_size]
        links = unpack(block.column("links")[0])
        n_pairs = links["n_pairs"].to_numpy().astype(np.int64)
        steps = links["steps"].to_numpy().astype(np.int64)
        ends = np.cumsum(n_pairs)
        # The running sum of steps begins anew with each text.
        place = np.cumsum(steps)
        before = np.append(0, place)[ends - n_pairs]
        place -= np.repeat(before, n_pairs)
        times = links["times"].to_numpy().astype(np.int64)
        sums = [np.append(0, np.cumsum(x)) for x in (times * best[place], times * counts[place])]
        n_best, count_sum = (x[ends] - x[ends - n_pairs] for x in sums)
        rows = rows.append_column("n_best", pa.array(n_best)).append_column("count_sum", pa.array(count_sum))
        return rows.select(schema.names)

    return run


def link_counts(
    docs: DataFrame, a_file: bytes, b_file: bytes, keep: Sequence[str] = ("doc_id",), block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """How each whole text's groups link ids of A and B, and how common these links are.

    Returns per row ``keep``, ``n_a``, ``n_b``, ``n_groups``, ``n_links`` (pairs of
    an A and a B token in one group), ``n_best`` (links whose id pair is in as
    many documents as any pair of its A id), ``count_sum`` (documents that hold the
    pair, summed over links) and ``groups_sha256`` (of the ids by group). Texts that
    are NULL, empty, or not spelled alike by both tokenizers have no tokens: zeros
    and an empty digest. Repeated rows are documents of their own. Names in
    ``keep`` must differ from these; other columns are ignored.
    """
    spark = docs.sparkSession
    names = list(dict.fromkeys(keep))
    shared = spark.sparkContext.broadcast((a_file, b_file))
    schema = T.StructType(docs.select(*names).schema.fields)
    for name in (*_COUNTS, "n_best", "count_sum"):
        schema = schema.add(name, "long")
    schema = schema.add("groups_sha256", "string")
    known = Vocabularies(a_file, b_file)
    a_size, b_size = len(known.a_lengths), len(known.b_lengths)
    blocks = stage(
        _named(names, docs).mapInArrow(
            _blocks(shared, names, block_bytes), "block long, rows binary, pairs binary, links binary, n_pairs long"
        ),
        "aligned",
    )
    sent = blocks.agg(F.coalesce(F.sum("n_pairs"), F.lit(0))).first()[0]
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_ranges = max(1, sent // RANGE_PAIRS, min(few, sent // (RANGE_PAIRS // 10)))
    requests = blocks.select("block", "pairs").mapInArrow(_requests(n_ranges), "range int, block long, pairs binary")
    answers = stage(requests.groupBy("range").applyInArrow(_answers(b_size), "block long, range int, counts binary"), "answers")
    # One number for each id of A: as many as its vocabulary has, at any size of the corpus.
    found = answers.where("block = -1").select("counts").mapInArrow(_highest, "a long, highest long")
    highest = np.zeros(a_size, np.int64)
    for row in found.groupBy("a").agg(F.max("highest").alias("highest")).collect():
        highest[row["a"]] = row["highest"]
    finish = _finish(n_ranges, b_size, spark.sparkContext.broadcast(highest), schema)
    return answers.where("block >= 0").groupBy("block").cogroup(blocks.drop("n_pairs").groupBy("block")).applyInArrow(finish, schema)
