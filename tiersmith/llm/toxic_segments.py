"""Toxicity by significant passages: maximum-scoring segments of token log-odds.

A token's score is the log-odds of the numbers of toxic and of clean documents
that have it, each with a Dirichlet prior. The prior of a word is what its
prefix says, that of a prefix what a shorter prefix says, so a word never seen
is not unknown. A constant drift is taken off, so scores are negative in clean
text.

The segments of a text whose sums cannot be made larger by adding or dropping
tokens at either end, none of which overlap, are found in one scan. Sums of
clean text follow an extreme-value distribution with the text's length; its two
parameters, fitted on clean documents that the counts have not seen, turn sums
into expected numbers of chance segments, and the best few of a text into one
statistic, which a logistic curve maps to a probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiersmith.llm.textcodes import LOWER, NOT_LETTER, Slice, code, slices, sorted_distinct, text_of_batch

#: Labelled documents learned from, at most; of more, those whose id hashes lowest.
SAMPLE_DOCUMENTS = 15_000
#: Lengths in bytes of the prefixes; the last level is the whole word.
LEVELS = (3, 5, 7, 1 << 30)
#: Each level's features are hashed to ``2 ** BITS`` places.
BITS = 18
#: Weight of a prior, in toxic documents.
PRIOR = 2.0
DRIFT = 1.2
#: A passage is significant when fewer of its kind are expected by chance.
EXPECTED = 0.05
#: The statistic of a text without any segment.
LEAST = -8.0

_PART = 1 << BITS


def places(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of all tokens (level x token), their starts and ends, and each text's first."""
    starts, ends, first = part.words(NOT_LETTER)
    sums = part.prefix_sums(LOWER)
    shift = np.uint64(64 - BITS)
    rows = [code(sums, starts, np.minimum(ends, starts + min(size, len(part.data)))) >> shift for size in LEVELS]
    return np.array(rows, np.uint64).astype(np.int64).reshape(len(LEVELS), -1), starts, ends, first


@dataclass
class Scorer:
    """Counts as log-odds, and the calibration of segment sums."""

    toxic: np.ndarray  # documents, level x place
    expected: np.ndarray  # clean documents, brought to the number of the toxic ones
    rate: float = 1.0  # of the extreme-value distribution
    scale: float = 1.0
    slope: float = 1.0
    offset: float = 0.0

    def tokens(self, found: np.ndarray) -> np.ndarray:
        """The score of each token: a word's ratio shrunk to its prefix's, and so on."""
        ratio = np.ones(found.shape[1])
        for level in range(len(LEVELS)):
            ratio = (self.toxic[level][found[level]] + PRIOR * ratio) / (self.expected[level][found[level]] + PRIOR)
        return np.log(ratio) - DRIFT

    def statistic(self, sums: list[float], n: int) -> float:
        """What the segments of a text of ``n`` tokens amount to; 0 where one is expected by chance."""
        if not sums:
            return LEAST
        base = math.log(max(self.scale * n, 1e-300))
        orders = [self.rate * s - base for s in sums]
        beyond = sum(x for x in orders if x > 0)
        return math.log1p(beyond) if beyond > 0 else max(LEAST, max(orders))

    def probability(self, statistic: float) -> float:
        x = self.slope * statistic + self.offset
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as ``(begin, end, sum)``, in one pass over the runs of a sign."""
    if not len(scores):
        return []
    cuts = np.flatnonzero(np.diff(scores > 0)) + 1
    begins = np.concatenate([[0], cuts])
    ends = np.append(cuts, len(scores))
    sums = np.add.reduceat(scores, begins)
    reached = np.cumsum(sums)
    segments: list[tuple[int, int, float, float]] = []  # begin, end, total before, total after
    for begin, end, total, after in zip(begins.tolist(), ends.tolist(), sums.tolist(), reached.tolist(), strict=True):
        if total <= 0:
            continue
        left = after - total
        while True:
            # The nearest segment on the left that begins lower than this one.
            at = len(segments) - 1
            while at >= 0 and segments[at][2] >= left:
                at -= 1
            if at < 0 or segments[at][3] >= after:
                break
            begin, left = segments[at][0], segments[at][2]
            del segments[at:]
        segments.append((begin, end, left, after))
    return [(b, e, high - low) for b, e, low, high in segments]


def _largest(scores: np.ndarray) -> float:
    reached = np.concatenate([[0.0], np.cumsum(scores)])
    return float((reached - np.minimum.accumulate(reached)).max())


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many of a task's labelled texts have each feature, by label."""
    totals = np.zeros((2, len(LEVELS) << BITS), np.int64)
    base = (np.arange(len(LEVELS)) << BITS)[:, None]
    for batch in batches:
        toxic = np.asarray(batch.column("label"))
        for part in slices(text_of_batch(batch)):
            found, _, _, first = places(part)
            of = toxic[part.first : part.first + len(part)]
            # Each feature counts once in a text.
            seen = (np.repeat(np.arange(len(part)), np.diff(first)) * totals.shape[1] + found + base).ravel()
            seen = sorted_distinct(seen)
            for label in (0, 1):
                mine = seen[of[seen // totals.shape[1]] == label] % totals.shape[1]
                totals[label] += np.bincount(mine, minlength=totals.shape[1])
    held = np.flatnonzero(totals.any(axis=0))
    for some in np.array_split(held, max(1, len(held) // 50_000)):
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(totals[1][some]), pa.array(totals[0][some])], names=["place", "toxic", "clean"]
        )


def fit_extremes(sums: np.ndarray, lengths: np.ndarray) -> tuple[float, float]:
    """Maximum-likelihood ``rate`` and ``scale`` of ``P(sum < x) = exp(-scale * n * exp(-rate * x))``."""
    keep = (lengths > 0) & (sums > 0)
    sums, lengths = sums[keep], lengths[keep].astype(np.float64)
    if len(sums) < 10:
        return 1.0, 1.0
    low, high = 1e-3, 50.0
    for _ in range(80):
        rate = (low + high) / 2
        weight = lengths * np.exp(-rate * (sums - sums.min()))
        slack = sums.mean() - (weight * sums).sum() / weight.sum() - 1 / rate
        low, high = (low, rate) if slack > 0 else (rate, high)
    return rate, len(sums) / (lengths * np.exp(-rate * sums)).sum()


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic curve by Newton's method, slightly shrunk."""
    a, b = 0.1, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p) + 1e-6
        gradient = np.array([((y - p) * x).sum() - 1e-2 * a, (y - p).sum() - 1e-2 * b])
        hessian = np.array([[(w * x * x).sum() + 1e-2, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-2]])
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        a, b = a + step[0], b + step[1]
    return float(a), float(b)


def _segments_of(scorer_of):
    """The sums of each labelled text's segments, and its number of tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of()
        for batch in batches:
            sums, lengths = [], []
            for part in slices(text_of_batch(batch)):
                found, _, _, first = places(part)
                scores = scorer.tokens(found)
                for d in range(len(part)):
                    own = scores[first[d] : first[d + 1]]
                    lengths.append(len(own))
                    sums.append([s for _, _, s in maximal_segments(own)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(lengths, pa.int64()), pa.array(sums, pa.list_(pa.float64()))],
                names=["label", "n", "sums"],
            )

    return run


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> Scorer:
    """A scorer from the whole texts of at most ``sample`` labelled documents.

    ``labels`` has ``doc_id`` and ``label`` (1 toxic, 0 clean; others are left
    out). Two thirds of them are counted, the rest calibrates.
    """
    chosen = (
        labels.where("label IN (0, 1) AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("label").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
        .withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)))
    )
    # Bounded by the sample's size, so the texts need not move.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    counts = (
        texts.where("part > 0")
        .select("label", "text")
        .mapInArrow(_counts, "place long, toxic long, clean long")
        .groupBy("place")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .toArrow()
    )
    totals = np.zeros((2, len(LEVELS) << BITS))
    at = np.asarray(counts["place"])
    totals[0][at], totals[1][at] = np.asarray(counts["toxic"]), np.asarray(counts["clean"])
    toxic, clean = (t.reshape(len(LEVELS), -1).astype(np.float32) for t in totals)
    documents = {r["label"]: r["n"] for r in chosen.where("part > 0").groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    size = documents.get(1, 0) / max(1, documents.get(0, 0))
    scorer = Scorer(toxic, clean * np.float32(size))
    shared = docs.sparkSession.sparkContext.broadcast(vars(scorer))
    rows = (
        texts.where("part = 0")
        .select("label", "text")
        .mapInArrow(_segments_of(lambda: Scorer(**shared.value)), "label int, n long, sums array<double>")
        .collect()
    )
    label = np.array([r["label"] for r in rows])
    best = np.array([max(r["sums"], default=0.0) for r in rows])
    n = np.array([r["n"] for r in rows])
    if len(rows):
        scorer.rate, scorer.scale = fit_extremes(best[label == 0], n[label == 0])
    statistic = np.array([scorer.statistic(r["sums"], r["n"]) for r in rows])
    if 0 < label.sum() < len(label):
        scorer.slope, scorer.offset = fit_logistic(statistic, label)
    else:
        scorer.offset = -5.0
    return scorer


def _scan(scorer: Scorer, part: Slice):
    """``(text, tokens, statistic, significant segments, starts, ends)`` of each text of a slice."""
    found, starts, ends, first = places(part)
    scores = scorer.tokens(found)
    for d in range(len(part)):
        begin, end = int(first[d]), int(first[d + 1])
        n, own = end - begin, scores[begin:end]
        largest = _largest(own) if n else 0.0
        if largest <= 0:
            yield d, n, LEAST, [], begin
            continue
        expected = scorer.scale * n * math.exp(-scorer.rate * largest)
        if expected > 1:
            # No segment stands out, so the largest alone settles the statistic.
            yield d, n, scorer.statistic([largest], n), [], begin
            continue
        segments = maximal_segments(own)
        significant = [
            (b, e, s) for b, e, s in segments if scorer.scale * n * math.exp(-scorer.rate * s) < EXPECTED
        ]
        yield d, n, scorer.statistic([s for _, _, s in segments], n), significant, begin


def score_documents(docs: DataFrame, scorer: Scorer, threshold: float = 0.5) -> DataFrame:
    """``doc_id``, ``score`` (probability of toxic), ``predicted``, ``n_passages`` of every whole text.

    NULL, empty and letterless texts have no segment and the least score. The
    input's other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(scorer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(**shared.value)
        for batch in batches:
            score, passages = [], []
            for part in slices(text_of_batch(batch)):
                for _, _, statistic, significant, _ in _scan(scorer, part):
                    score.append(scorer.probability(statistic))
                    passages.append(len(significant))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(score, pa.float64()),
                    pa.array([int(x >= threshold) for x in score], pa.int32()),
                    pa.array(passages, pa.int64()),
                ],
                names=["doc_id", "score", "predicted", "n_passages"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int, n_passages long")


def toxic_passages(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """One row per significant passage: ``doc_id``, ``passage`` (text), ``score``, ``expected`` by chance."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(scorer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(**shared.value)
        for batch in batches:
            out: list[tuple] = []
            for part in slices(text_of_batch(batch)):
                _, starts, ends, _ = places(part)
                for d, n, _, significant, begin in _scan(scorer, part):
                    for b, e, s in significant:
                        passage = bytes(part.data[starts[begin + b] : ends[begin + e - 1]]).decode()
                        out.append((part.first + d, passage, s, scorer.scale * n * math.exp(-scorer.rate * s)))
            if out:
                rows, *values = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(rows)), *map(pa.array, values)],
                    names=["doc_id", "passage", "score", "expected"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, passage string, score double, expected double")
