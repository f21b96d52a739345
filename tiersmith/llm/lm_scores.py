"""Language-model scores by deleted interpolation of bigram and unigram estimates.

The model is never in one place. Texts are packed into blocks of some
megabytes, staged once, so that every later pass sees the same blocks. A block
sends its distinct words and word pairs to the tasks that own their range of
codes, with its own counts; an owner adds the counts of all blocks up and
answers each block in the order it asked. What a task holds grows with its
block or its range, and the counts gathered grow with the corpus.

The probability of word ``w`` after ``v`` is

    weight(f) * count(v, w) / count(v) + (1 - weight(f)) * base(w)

with ``f`` the frequency bucket of the context (powers of two of ``count(v)``)
and ``base`` the additively smoothed unigram estimate. The weights of the
buckets are found by expectation-maximisation on a held-out part of the
training documents, against counts from which that part is deleted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiersmith.llm.textcodes import code, follow, slices, sorted_distinct
from tiersmith.session import stage

#: Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 14_000_000
#: Blocks whose requests the owner of a range should have to add up, were they all of its size.
BLOCKS_A_RANGE = 16
#: Added to each count by the unigram estimate.
ADDED = 0.1
#: Bins per doubling of the ratio of the two estimates, for the mixture weights.
BINS = 64
ROUNDS = 60

_START = np.array([0x53544152543A3A31], np.uint64)  # before a text; never a word's code but by chance
_END = np.array([0x454E443A3A3A3A32], np.uint64)
_WORDS, _PAIRS = 0, 1
#: Bits of the codes of words and of pairs.
_BITS = {_WORDS: 64, _PAIRS: 54}
#: Texts are staged and moved once, so they are compressed well; counts gain nothing by it.
_TEXT_LEVEL = 6
_PIECE = 500_000  # tokens handled at a time where a step needs several arrays


def _pack(counts: np.ndarray) -> bytes:
    """Counts as compressed byte planes; most planes are zeros."""
    counts = np.ascontiguousarray(counts, np.uint64)
    if not len(counts) or not counts.any():
        return b""
    width = (int(counts.max()).bit_length() + 7) // 8
    planes = counts.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return bytes([width]) + pa.compress(planes, codec="zstd", asbytes=True)


def _unpack(packed: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    if packed:
        width = packed[0]
        planes = pa.decompress(packed[1:], decompressed_size=n * width, codec="zstd", asbytes=True)
        out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return out.reshape(-1).view(np.uint64)


def _pack_blocks(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def flush():
            sink = pa.BufferOutputStream()
            options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", _TEXT_LEVEL))
            with pa.ipc.new_stream(sink, held[0].schema, options=options) as writer:
                for piece in held:
                    writer.write_batch(piece)
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                names=["block", "payload"],
            )

        for batch in batches:
            lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0))
            at = 0
            while at < batch.num_rows:
                running = np.cumsum(lengths[at:])
                taken = max(1, int(np.searchsorted(running, limit - size, "right")))
                if held and running[0] > limit - size:
                    taken = 0
                if taken:
                    held.append(batch.slice(at, taken))
                    size += int(running[taken - 1])
                    at += taken
                if at < batch.num_rows or size >= limit:
                    yield flush()
                    number, held, size = number + 1, [], 0
        if held:
            yield flush()

    return run


class _Block:
    """The tokens of a block, and the codes it asks for."""

    def __init__(self, payload: bytes) -> None:
        docs = pa.ipc.open_stream(payload).read_all().combine_chunks()
        self.doc_id = docs.column("doc_id")
        train = np.asarray(docs.column("train"), bool)
        tune = np.asarray(docs.column("tune"), bool) & train
        pieces, lengths = [], []
        for part in slices(docs.column("text")):
            starts, ends, first = part.words()
            own = code(part.prefix_sums(), starts, ends)
            pieces.append(np.insert(own, first[1:], _END[0]))
            lengths.append(np.diff(first) + 1)
        self.tokens = np.concatenate(pieces)
        self.lengths = np.concatenate(lengths)
        self.ends = np.cumsum(self.lengths)
        self.begins = self.ends - self.lengths
        self.pairs = np.empty_like(self.tokens)
        self.pairs[1:] = self.tokens[:-1]
        self.pairs[self.begins] = _START[0]
        for some in self.pieces():
            self.pairs[some] = follow(self.pairs[some], self.tokens[some]) >> np.uint64(64 - _BITS[_PAIRS])
        # 0: not learned from, 1: counted, 2: counted and used for the weights.
        self.role = np.where(tune, 2, np.where(train, 1, 0)).astype(np.uint8)
        self.asked = {
            _WORDS: sorted_distinct(np.concatenate([self.tokens, _START])),
            _PAIRS: sorted_distinct(self.pairs),
        }

    def pieces(self) -> Iterator[slice]:
        return (slice(at, at + _PIECE) for at in range(0, len(self.tokens), _PIECE))

    def codes(self, kind: int) -> np.ndarray:
        return self.tokens if kind == _WORDS else self.pairs

    def counts(self, kind: int, role: int) -> np.ndarray:
        asked = self.asked[kind]
        counts = np.zeros(len(asked), np.int64)
        mine = np.repeat(self.role == role, self.lengths)
        for some in self.pieces():
            place = np.searchsorted(asked, np.sort(self.codes(kind)[some][mine[some]]))
            cuts = np.flatnonzero(np.diff(place, prepend=-1))
            counts[place[cuts]] += np.diff(np.append(cuts, len(place)))
        if kind == _WORDS:
            counts[np.searchsorted(asked, _START)[0]] = np.count_nonzero(self.role == role)
        return counts

    def cuts(self, kind: int, ranges: int) -> np.ndarray:
        """Where each range begins in the codes asked for, and the end."""
        owner = ((self.asked[kind] >> np.uint64(_BITS[kind] - 24)) * np.uint64(ranges)) >> np.uint64(24)
        return np.searchsorted(owner, np.arange(ranges + 1, dtype=np.uint64))


def _requests(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, payload in zip(batch.column("block").to_pylist(), batch.column("payload"), strict=True):
                block = _Block(payload.as_buffer())
                for kind, codes in block.asked.items():
                    counted, tuned = block.counts(kind, 1), block.counts(kind, 2)
                    cuts = block.cuts(kind, ranges)
                    full = np.flatnonzero(np.diff(cuts))
                    for some in np.array_split(full, max(1, len(full) // 64)):
                        spans = [slice(cuts[r], cuts[r + 1]) for r in some]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(some, pa.int32()),
                                pa.array([kind] * len(some), pa.int32()),
                                pa.array([number] * len(some), pa.int64()),
                                pa.array([s.stop - s.start for s in spans], pa.int32()),
                                # In order, codes are sent as the gaps between them.
                                pa.array([_pack(np.diff(codes[s], prepend=np.uint64(0))) for s in spans], pa.binary()),
                                pa.array([_pack(counted[s]) for s in spans], pa.binary()),
                                pa.array([_pack(tuned[s]) for s in spans], pa.binary()),
                            ],
                            names=["range", "kind", "block", "n", "gaps", "counted", "tuned"],
                        )
                del block
                # Arrow would keep what it has freed, beside numpy's arrays.
                pa.default_memory_pool().release_unused()

    return run


def _answers(table: pa.Table) -> pa.Table:
    """The totals over all blocks of the codes of one range, for each block that asked."""
    table = table.combine_chunks()
    kind, owner = table.column("kind")[0].as_py(), table.column("range")[0].as_py()
    sizes = table.column("n").to_pylist()
    gaps = table.column("gaps")
    codes = np.concatenate([np.cumsum(_unpack(x.as_py(), n), dtype=np.uint64) for x, n in zip(gaps, sizes, strict=True)])
    order = np.argsort(codes)
    ranked = codes[order]
    fresh = np.ones(len(codes), bool)
    np.not_equal(ranked[1:], ranked[:-1], out=fresh[1:])
    starts = np.flatnonzero(fresh)
    group = np.empty(len(codes), np.int64)
    group[order] = np.cumsum(fresh) - 1
    totals = []
    for column in ("counted", "tuned"):
        own = np.concatenate([_unpack(x.as_py(), n) for x, n in zip(table.column(column), sizes, strict=True)])
        totals.append(np.add.reduceat(own[order], starts))
    cuts = np.cumsum(sizes)[:-1]
    both = [np.split(t[group], cuts) for t in totals]
    out = {
        "block": table.column("block").to_pylist(),
        "kind": [kind] * len(sizes),
        "range": [owner] * len(sizes),
        "n": sizes,
        "counted": [_pack(x) for x in both[0]],
        "tuned": [_pack(x) for x in both[1]],
    }
    if kind == _WORDS:
        # A row for no block carries the sizes of the vocabulary and of the training text.
        whole = totals[0] + totals[1]
        whole = whole[ranked[starts] != _START[0]]
        sums = np.array([np.count_nonzero(whole), whole.sum(), totals[1][ranked[starts] != _START[0]].sum()])
        for name, value in zip(out, [-1, -1, owner, 3, _pack(sums), b""], strict=True):
            out[name].append(value)
    return pa.table(out, schema=_ANSWER)


_ANSWER = pa.schema(
    [("block", pa.int64()), ("kind", pa.int32()), ("range", pa.int32()), ("n", pa.int32())]
    + [("counted", pa.binary()), ("tuned", pa.binary())]
)
_FOUND = pa.schema(
    [("block", pa.int64()), ("n_docs", pa.int32()), ("n_tokens", pa.int64()), ("docs", pa.binary())]
    + [(c, pa.binary()) for c in ("word", "pair", "start", "tuned_word", "tuned_pair", "tuned_start")]
)


def _found(answers: pa.Table, blocks: pa.Table) -> pa.Table:
    """For each token of a block the counts of the word and of the pair it ends."""
    answers = answers.combine_chunks()
    if not blocks.num_rows:
        sums = sum(_unpack(x.as_py(), 3) for x in answers.column("counted"))
        return pa.table([[-1], [0], [0], [None], [_pack(sums)]] + [[b""]] * 5, schema=_FOUND)
    payload = blocks.column("payload").combine_chunks()[0]
    block = _Block(payload.as_buffer())
    kinds, ranges = np.asarray(answers.column("kind")), np.asarray(answers.column("range"))
    columns: dict[str, bytes] = {}
    tune = np.repeat(block.role == 2, block.lengths)
    for kind, name in ((_WORDS, "word"), (_PAIRS, "pair")):
        rows = np.flatnonzero(kinds == kind)
        rows = rows[np.argsort(ranges[rows])]
        sizes = np.asarray(answers.column("n"))[rows]
        asked = block.asked[kind]
        if sizes.sum() != len(asked):
            raise RuntimeError(f"{len(asked)} codes were asked for and {sizes.sum()} answered")
        codes = block.codes(kind)
        place = np.empty(len(codes), np.int32)
        for some in block.pieces():
            by = np.argsort(codes[some])
            place[some][by] = np.searchsorted(asked, codes[some][by])
        for column in ("counted", "tuned"):
            cells = answers.column(column).combine_chunks()
            totals = np.concatenate([_unpack(cells[int(r)].as_py(), int(n)) for r, n in zip(rows, sizes, strict=True)])
            prefix = "" if column == "counted" else "tuned_"
            chosen = totals[place]
            # Counts of the tuning part matter for its own tokens only.
            columns[prefix + name] = _pack(chosen if column == "counted" else chosen[tune])
            if column == "counted":
                held = chosen
            else:
                columns[name] = _pack(held + chosen)
            if kind == _WORDS:
                columns[prefix + "start"] = _pack(totals[np.searchsorted(asked, _START)])
    docs = pa.RecordBatch.from_arrays(
        [block.doc_id.combine_chunks(), pa.array(block.lengths), pa.array(block.role)],
        names=["doc_id", "length", "role"],
    )
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(docs)
    row = {
        "block": blocks.column("block")[0].as_py(),
        "n_docs": len(block.lengths),
        "n_tokens": len(block.tokens),
        "docs": sink.getvalue().to_pybytes(),
    }
    return pa.table({k: [v] for k, v in (row | columns).items()}, schema=_FOUND)


class _Counts:
    """The counts of a block's tokens, read back."""

    def __init__(self, row: dict) -> None:
        docs = pa.ipc.open_stream(row["docs"]).read_all().combine_chunks()
        self.doc_id = docs.column("doc_id").combine_chunks()
        self.lengths = np.asarray(docs.column("length"), np.int64)
        self.role = np.asarray(docs.column("role"))
        self.begins = np.cumsum(self.lengths) - self.lengths
        n = row["n_tokens"]
        self.word, self.pair = (_unpack(row[c], n).astype(np.int64) for c in ("word", "pair"))
        start, tuned_start = (int(_unpack(row[c], 1)[0]) for c in ("start", "tuned_start"))
        self.context = self._shift(self.word, self.begins, start + tuned_start)
        self.tune = np.repeat(self.role == 2, self.lengths)
        m = int(self.tune.sum())
        self.tuned_word, self.tuned_pair = (
            _unpack(row[c], m).astype(np.int64) for c in ("tuned_word", "tuned_pair")
        )
        lengths = self.lengths[self.role == 2]
        self.tuned_context = self._shift(self.tuned_word, np.cumsum(lengths) - lengths, tuned_start)

    @staticmethod
    def _shift(counts: np.ndarray, begins: np.ndarray, start: int) -> np.ndarray:
        out = np.empty_like(counts)
        out[1:] = counts[:-1]
        out[begins] = start
        return out


def _base(word: np.ndarray, train_tokens: int, vocabulary: int) -> np.ndarray:
    return (word + ADDED) / (train_tokens + ADDED * (vocabulary + 1))


def _bucket(context: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else one more than the power of two below its count."""
    return np.frexp(context.astype(np.float64))[1]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[_Counts]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield _Counts(batch.slice(i, 1).to_pylist()[0])
            pa.default_memory_pool().release_unused()


def _ratios(train_tokens: int, tuned_tokens: int, vocabulary: int):
    """Held-out tokens by context bucket and by the ratio of the two estimates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _rows(batches):
            context = found.context[found.tune] - found.tuned_context
            pair = found.pair[found.tune] - found.tuned_pair
            base = _base(found.word[found.tune] - found.tuned_word, train_tokens - tuned_tokens, vocabulary)
            seen = context > 0
            with np.errstate(divide="ignore"):
                ratio = np.log2(pair[seen] / context[seen] / base[seen])
            none = np.isneginf(ratio)
            binned = np.where(none, -(1 << 20), np.round(np.where(none, 0, ratio) * BINS)).astype(np.int64)
            keys = (_bucket(context[seen]).astype(np.int64) << 32) + (binned + (1 << 21))
            ordered = np.sort(keys)
            if len(ordered):
                distinct = sorted_distinct(ordered)
                counts = np.diff(np.append(np.searchsorted(ordered, distinct), len(ordered)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(distinct >> 32), pa.array((distinct & 0xFFFFFFFF) - (1 << 21)), pa.array(counts)],
                    names=["bucket", "bin", "n"],
                )

    return run


def mixture_weights(held_out: dict[int, list[tuple[int, int]]], rounds: int = ROUNDS) -> list[float]:
    """Expectation-maximisation of the bigram's weight in each context bucket.

    ``held_out`` has for each bucket the bins of the ratio of bigram to base
    estimate and how many held-out tokens fell in each. A bucket without any
    takes the weight of the bucket below; bucket 0, contexts never seen, is 0.
    """
    weights = [0.0]
    for bucket in range(1, 65):
        cells = held_out.get(bucket)
        if not cells:
            weights.append(weights[-1])
            continue
        bins, counts = np.array(cells, np.float64).T
        ratio = np.where(bins == -(1 << 20), 0.0, np.exp2(bins / BINS))
        weight = 0.5
        for _ in range(rounds):
            weight = float((counts * (weight * ratio / (weight * ratio + 1 - weight))).sum() / counts.sum())
            weight = min(max(weight, 1e-9), 1 - 1e-9)
        weights.append(weight)
    return weights


def _scores(train_tokens: int, vocabulary: int, weights: list[float]):
    table = np.array(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _rows(batches):
            base = _base(found.word, train_tokens, vocabulary)
            weight = table[_bucket(found.context)]
            mixed = weight * found.pair / np.maximum(found.context, 1) + (1 - weight) * base
            add = lambda x: pa.array(np.add.reduceat(x, found.begins))
            yield pa.RecordBatch.from_arrays(
                [
                    found.doc_id,
                    pa.array(found.role == 0),
                    pa.array(found.lengths),
                    add((found.word > 0).astype(np.int64)),
                    pa.array(np.full(len(found.lengths), train_tokens, np.int64)),
                    add(np.log10(base)),
                    add(np.log10(mixed)),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return run


def score_documents(docs: DataFrame, train: Column, tune: Column, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Score all texts with a model learned from the rows for which ``train`` holds.

    ``tune`` marks the training rows on which the mixture weights are found
    (their tokens count in the final model like all others). Words are runs
    outside ASCII white space with A-Z lowered; a text ends with one end token,
    so NULL, empty and blank texts have one token. Returns one row per row:
    ``doc_id``, ``held_out`` (not learned from), ``n_tokens``, ``n_known``
    (seen in training), ``train_tokens``, ``base_score`` (unigram) and
    ``score``, sums of log10 probabilities. Where nothing can be learned, every
    token has the probability of an empty vocabulary. A condition that is NULL
    counts as false. Other columns are ignored.
    """
    spark = docs.sparkSession
    flag = lambda c: F.coalesce(c, F.lit(False))
    packed = stage(
        docs.select("doc_id", "text", flag(train).alias("train"), flag(tune).alias("tune")).mapInArrow(
            _pack_blocks(block_bytes), "block long, payload binary"
        ),
        "blocks",
    )
    # More blocks, more ranges: what the owner of one holds does not grow with the corpus.
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), packed.count() // BLOCKS_A_RANGE)
    answers = (
        packed.mapInArrow(
            _requests(ranges),
            "range int, kind int, block long, n int, gaps binary, counted binary, tuned binary",
        )
        .groupBy("range", "kind")
        .applyInArrow(_answers, "block long, kind int, range int, n int, counted binary, tuned binary")
    )
    schema = "block long, n_docs int, n_tokens long, docs binary, word binary, pair binary, start binary, "
    found = stage(
        answers.groupBy("block")
        .cogroup(packed.groupBy("block"))
        .applyInArrow(_found, schema + "tuned_word binary, tuned_pair binary, tuned_start binary"),
        "counts",
    )
    sizes = found.where("block < 0").select("word").first()
    vocabulary, train_tokens, tuned_tokens = _unpack(bytes(sizes[0]), 3).tolist() if sizes else (0, 0, 0)
    found = found.where("block >= 0")
    held_out: dict[int, list[tuple[int, int]]] = {}
    cells = found.mapInArrow(_ratios(train_tokens, tuned_tokens, vocabulary), "bucket long, bin long, n long")
    # Buckets and bins are powers of two of counts: some thousands of rows at any size.
    for row in cells.groupBy("bucket", "bin").agg(F.sum("n").alias("n")).collect():
        held_out.setdefault(row["bucket"], []).append((row["bin"], row["n"]))
    return found.mapInArrow(
        _scores(train_tokens, vocabulary, mixture_weights(held_out)),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
