import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tiersmith.llm import lm_scores

SF_DIR = "/root/testdata/sf0.001"


def tokens(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered) + ["\0end"]


def brute_force(rows, train, tune):
    """doc_id -> (n_tokens, n_known, N, base score, model score)."""
    words, pairs, contexts = Counter(), Counter(), Counter()
    for doc_id, text in rows:
        if train(doc_id):
            own = tokens(text)
            words.update(own)
            pairs.update(zip(["\0start", *own], own))
            contexts.update(["\0start", *own[:-1]])
    held = [tokens(text) for doc_id, text in rows if tune(doc_id)]
    held_words = Counter(w for own in held for w in own)
    held_pairs = Counter(p for own in held for p in zip(["\0start", *own], own))
    held_contexts = Counter(w for own in held for w in ["\0start", *own[:-1]])
    total, vocabulary = sum(words.values()), len(words)

    def base(w, counts, n):
        return (counts[w] + 0.1) / (n + 0.1 * (vocabulary + 1))

    cells = {}
    for own in held:
        for v, w in zip(["\0start", *own], own):
            context = contexts[v] - held_contexts[v]
            if context:
                prior = (words[w] - held_words[w] + 0.1) / (total - sum(held_words.values()) + 0.1 * (vocabulary + 1))
                ratio = (pairs[v, w] - held_pairs[v, w]) / context / prior
                cells.setdefault(math.frexp(context)[1], []).append(ratio)
    weights = [0.0]
    for bucket in range(1, 65):
        weight = weights[-1]
        if bucket in cells:
            weight = 0.5
            for _ in range(60):
                weight = sum(weight * r / (weight * r + 1 - weight) for r in cells[bucket]) / len(cells[bucket])
                weight = min(max(weight, 1e-9), 1 - 1e-9)
        weights.append(weight)
    out = {}
    for doc_id, text in rows:
        own = tokens(text)
        plain = mixed = 0.0
        for v, w in zip(["\0start", *own], own):
            weight = weights[math.frexp(contexts[v])[1]]
            ml = pairs[v, w] / contexts[v] if contexts[v] else 0.0
            plain += math.log10(base(w, words, total))
            mixed += math.log10(weight * ml + (1 - weight) * base(w, words, total))
        out[doc_id] = (len(own), sum(words[w] > 0 for w in own), total, plain, mixed)
    return out


@pytest.mark.parametrize("block_bytes", [20_000, 16_000_000])
def test_scores_equal_brute_force(spark, block_bytes):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10
    got = lm_scores.score_documents(docs, crc != 0, crc == 1, block_bytes).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    remainder = lambda d: zlib.crc32(str(d).encode()) % 10
    want = brute_force(rows, lambda d: remainder(d) != 0, lambda d: remainder(d) == 1)
    assert len(got) == len(want)
    for r in got:
        n_tokens, n_known, total, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n_tokens, n_known, total, remainder(r.doc_id) == 0)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        # The ratios that fit the weights are binned, so weights differ a little.
        assert math.isclose(r.score, score, rel_tol=1e-3)


def test_odd_rows(make, odd_rows):
    docs = make(odd_rows)
    rows = lm_scores.score_documents(docs, F.col("doc_id") != 7, F.col("doc_id") == 2, 50_000).collect()
    assert len(rows) == len(odd_rows)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[3].n_tokens == by_id[4].n_tokens == by_id[5].n_tokens == 1
    assert by_id[8].n_tokens == 60_001
    assert by_id[7].held_out and not by_id[6].held_out
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)


def test_empty_table_and_nothing_to_learn(make):
    assert lm_scores.score_documents(make([]), F.lit(True), F.lit(False)).count() == 0
    rows = lm_scores.score_documents(make([(1, "a b")]), F.lit(False), F.lit(False)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.score) for r in rows] == [(3, 0, 0, 0.0)]


def test_weights_favour_the_better_estimate():
    bins = lm_scores.BINS
    weights = lm_scores.mixture_weights({3: [(4 * bins, 100)], 5: [(-(1 << 20), 100)]})
    assert weights[0] == weights[1] == 0.0
    assert weights[3] > 0.99 and weights[4] == weights[3] and weights[5] < 0.01


def test_counts_survive_packing():
    import numpy as np

    for values in ([], [0, 0], [1, 255, 256, 2**40], list(range(1000))):
        packed = lm_scores._pack(np.array(values, np.uint64))
        assert lm_scores._unpack(packed, len(values)).tolist() == values
