"""Document quality by supervised subword embeddings.

A document is the average of the vectors of its hashed words and character
n-grams; a softmax layer over the average gives the class. Vectors and layer
are learned together by stochastic gradient descent in numpy, on a bounded
sample of labelled documents. As softmax over an average is linear in the
features, scoring needs one number for each hashed feature: the vector's
projection on the difference of the two output vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiersmith.llm.textcodes import WHITE, Slice, code, slices, sorted_distinct, text_of_batch

#: Labelled documents learned from, at most; of more, those whose id hashes lowest.
SAMPLE_DOCUMENTS = 6000
#: Hashed features are ``2 ** BITS`` vectors of ``DIMENSIONS`` numbers.
BITS = 17
DIMENSIONS = 16
#: Lengths in bytes of the character n-grams.
NGRAMS = (3, 4)
EPOCHS = 6
RATE = 0.5
#: Vectors are updated by an average's small share each; this makes up for it.
VECTOR_RATE = 10.0

_SPACES = np.arange(256, dtype=np.uint8)
_SPACES[WHITE] = 32
_SAME = 0  # the feature of any word that follows itself


def features(part: Slice) -> list[tuple[np.ndarray, np.ndarray]]:
    """Groups of features: the features of all texts in order, and where each text's begin.

    The groups are words with their case; words that repeat the word before,
    all as one feature; and n-grams of a word's bytes with at most one byte of
    white space on either side.
    """
    n = len(part.data)
    starts, ends, first = part.words()
    own = code(part.prefix_sums(None), starts, ends)
    groups = [((own >> np.uint64(64 - BITS)).astype(np.int64), first)]
    same = np.flatnonzero(own[1:] == own[:-1]) + 1
    same = same[~np.isin(same, first)]
    groups.append((np.full(len(same), _SAME, np.int64), np.searchsorted(same, first)))
    white = WHITE[part.data]
    begins = np.zeros(n + 1, bool)
    begins[part.offsets] = True
    data = _SPACES[part.data].astype(np.uint32)
    for size in NGRAMS:
        windows = max(0, n - size + 1)
        broken = np.zeros(windows, bool)
        gram = data[:windows] + np.uint32(size)
        for k in range(1, size):
            broken |= begins[k : k + windows]
            if k < size - 1:
                broken |= white[k : k + windows]
            gram = gram * np.uint32(0x01000193) + data[k : k + windows]
        at = np.flatnonzero(~broken)
        gram = gram[at] * np.uint32(0x9E3779B1)
        gram ^= gram >> np.uint32(15)
        gram *= np.uint32(0x85EBCA6B)
        groups.append(((gram >> np.uint32(32 - BITS)).astype(np.int64), np.searchsorted(at, part.offsets)))
    return groups


@dataclass
class Model:
    """What scoring needs of the learned vectors and output layer."""

    projection: np.ndarray  # of each feature's vector, towards class 1
    bias: float

    def scores(self, part: Slice) -> np.ndarray:
        """The probability of class 1 of each text; a text without features has the bias alone."""
        total, count = np.zeros(len(part)), np.zeros(len(part))
        for found, first in features(part):
            running = np.zeros(len(found) + 1)
            np.cumsum(self.projection[found], out=running[1:])
            total += running[first[1:]] - running[first[:-1]]
            count += np.diff(first)
        return 1 / (1 + np.exp(-(total / np.maximum(count, 1) + self.bias)))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct features of each text and how often it has them."""
    for batch in batches:
        for part in slices(text_of_batch(batch)):
            groups = features(part)
            sizes, bags = [], []
            for d in range(len(part)):
                bag = np.sort(np.concatenate([found[first[d] : first[d + 1]] for found, first in groups]))
                distinct = sorted_distinct(bag)
                counts = np.diff(np.append(np.searchsorted(bag, distinct), len(bag)))
                sizes.append(len(distinct))
                bags.append(pack_bag(distinct, counts))
            rows = batch.slice(part.first, len(part))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("label"), pa.array(sizes, pa.int32()), pa.array(bags, pa.binary())],
                names=["doc_id", "label", "n", "bag"],
            )


def pack_bag(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted feature ids and their counts in a few kilobytes: the driver holds the whole sample."""
    both = np.concatenate([np.diff(ids, prepend=0), counts]).astype("<i4")
    return pa.compress(both.tobytes(), codec="zstd", asbytes=True)


def _unpack_bag(bag: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(pa.decompress(bag, decompressed_size=8 * n, codec="zstd", asbytes=True), "<i4")
    return np.cumsum(both[:n]), both[n:]


def train(bags: list[tuple[int, int, bytes]], seed: int = 1) -> Model:
    """Learn from ``(label, number of features, packed bag)`` of each document, in the order given."""
    draw = np.random.default_rng(seed)
    vectors = (draw.random((1 << BITS, DIMENSIONS), np.float32) - np.float32(0.5)) / DIMENSIONS
    output, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    bags = [bag for bag in bags if bag[1]]
    steps = EPOCHS * len(bags)
    for step, which in enumerate(np.concatenate([draw.permutation(len(bags)) for _ in range(EPOCHS)]) if bags else []):
        label, n, packed = bags[which]
        ids, counts = _unpack_bag(packed, n)
        rate = np.float32(RATE * (1 - step / steps))
        share = (counts / counts.sum()).astype(np.float32)
        average = share @ vectors[ids]
        logits = average @ output + bias
        wrong = np.exp(logits - logits.max())
        wrong /= wrong.sum()
        wrong[label] -= 1
        back = output @ wrong
        output -= rate * np.outer(average, wrong)
        bias -= rate * np.float32(0.1) * wrong
        vectors[ids] -= (rate * np.float32(VECTOR_RATE) * share)[:, None] * back
    towards = (output[:, 1] - output[:, 0]).astype(np.float64)
    return Model(vectors.astype(np.float64) @ towards, float(bias[1] - bias[0]))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> Model:
    """A model from the whole texts of at most ``sample`` labelled documents.

    ``labels`` has ``doc_id`` and ``label`` (0 or 1; others are left out).
    """
    chosen = (
        labels.where("label IN (0, 1) AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("label").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    # Bounded by the sample's size, so the texts need not move.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = texts.mapInArrow(_bags, "doc_id long, label int, n int, bag binary").collect()
    bags = sorted((r["doc_id"], r["label"], r["n"], bytes(r["bag"])) for r in rows)
    return train([bag[1:] for bag in bags])


def score_documents(docs: DataFrame, model: Model, threshold: float, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``score`` (probability of class 1), ``predicted`` of every row, over whole texts.

    NULL and empty texts are scored too, by the layer's bias. The input's other
    columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    schema = docs.select(*keep).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        for batch in batches:
            scores = [model.scores(part) for part in slices(text_of_batch(batch))]
            score = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=[*keep, "score", "predicted"],
            )

    out = schema.add("score", "double").add("predicted", "integer")
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, out)


def held_out(column: str = "doc_id") -> Column:
    """Whether no label may be learned from a row: the id's CRC-32 is divisible by 5; false without an id."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(False))
