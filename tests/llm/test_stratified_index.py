import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tiersmith.llm import stratified_index
from tiersmith.llm.packing import pack, unpack
from tiersmith.llm.stratified_index import build_index, search, segment
from tiersmith.llm.textcodes import slices

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, k):
    """``(item_id, rank, doc_id, score)`` of every item, by scoring all documents."""
    known = [(doc_id, Counter(terms_of(text))) for doc_id, text in docs]
    known = [(doc_id, terms, sum(terms.values())) for doc_id, terms in known if terms]
    n_docs, n_terms = len(known), sum(n for _, _, n in known)
    df = Counter(t for _, terms, _ in known for t in terms)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, terms, n in known:
            m, score = 75 + 25 * n * n_docs // n_terms, 0
            for t in terms_of(text):
                if tf := terms[t]:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (
                        10**9 * tf // (1000 * tf + 12 * m)
                    )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, no_id, doc_id) in enumerate(sorted(scored)[:k], 1):
            out.append((item_id, rank, None if no_id else doc_id, -score))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def items_of(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")


def found(docs, items, k, segment_bytes=stratified_index.SEGMENT_BYTES, **options):
    rows = search(build_index(docs, segment_bytes), items, k, **options).collect()
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in rows), key=str)


@pytest.mark.parametrize(("seed", "letters", "k"), [(1, 4, 3), (2, 30, 5), (3, 12, 1), (4, 200, 20)])
@pytest.mark.parametrize("sizes", [{}, {"segment_bytes": 300, "query_bytes": 80}])
def test_random_texts_equal_brute_force(make, items_of, seed, letters, k, sizes):
    draw = random.Random(seed)
    text = lambda most: " ".join(f"T{int(draw.expovariate(3 / letters))}" for _ in range(draw.randint(0, most)))
    docs = [(n, text(draw.choice([3, 30, 120]))) for n in range(150)]
    items = [(draw.choice([n, None, 3]), text(12)) for n in range(12)]
    assert found(make(docs), items_of(items), k, **sizes) == brute(docs, items, k)


def test_odd_rows(make, items_of, odd_rows):
    items = [(1, "ONE two, three"), (1, "ONE two, three"), (None, "w5 w59999"), (3, None), (4, ""), (5, " ?!"), (6, "word"), (7, "größe 中文 é")]
    docs = [row[:2] for row in odd_rows]
    assert found(make(odd_rows), items_of(items), 4) == brute(docs, items, 4)
    # Repeated documents are all found; without an id they come last among equals.
    first = [r for r in found(make(odd_rows), items_of(items[:1]), 4)]
    assert [r[2] for r in first] == [1, 1, 2, None] and len({r[3] for r in first}) == 1


def test_empty_tables(make, items_of):
    docs, none = make([(1, "a b")]), make([])
    assert found(none, items_of([(1, "a")]), 5) == []
    assert found(docs, items_of([]), 5) == []
    assert found(make([(1, None), (2, " ")]), items_of([(1, "a")]), 5) == []


def test_ties_go_by_id_across_segments(make, items_of):
    docs = [(n, "same words here") for n in random.Random(5).sample(range(500), 200)] + [(n, "other") for n in range(600, 900)]
    got = found(make(docs), items_of([(1, "same words")]), 20, segment_bytes=200)
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == sorted(n for n, _ in docs if n < 500)[:20]


def test_a_segment_lists_documents_by_stratum_and_falling_tf():
    texts = ["b a a a", "a b c d", "a a", "", None, "a b a b", "a " * 9]
    part = next(iter(slices(pa.array(texts))))
    docs, lists = segment(part, n_docs=5, n_terms=23)
    assert docs.tolist() == [2, 0, 1, 5, 6]
    assert lists["strata"].tolist() == [75 + 25 * n * 5 // 23 for n in (2, 4, 9)]
    a = [t for t in range(len(lists["terms"])) if lists["term_runs"][t + 1] - lists["term_runs"][t] == 5]
    runs = slice(lists["term_runs"][a[0]], lists["term_runs"][a[0] + 1])
    assert lists["run_stratum"][runs].tolist() == [0, 1, 1, 1, 2]
    impacts = lists["impacts"][lists["run_impact"][runs]].tolist()
    m = lists["strata"].tolist()
    assert impacts == [10**9 * tf // (1000 * tf + 12 * m[s]) for s, tf in ((0, 2), (1, 3), (1, 2), (1, 1), (2, 9))]
    # Each stratum and tf has its impact once, whatever terms share it.
    assert len(lists["impacts"]) == len({(s, tf) for s, tf in ((0, 2), (1, 3), (1, 2), (1, 1), (2, 9))})


def test_strata_out_of_reach_are_not_visited(monkeypatch):
    texts = [f"needle {'hay ' * n}" for n in range(1, 200)]
    part = next(iter(slices(pa.array(texts))))
    n_terms = sum(n + 1 for n in range(1, 200))
    docs, lists = segment(part, len(texts), n_terms)
    lists = unpack(pa.scalar(pack({"doc_ids": pa.array(docs), **lists})))
    visited = []
    visit = stratified_index.Segment._visit
    monkeypatch.setattr(stratified_index.Segment, "_visit", lambda self, some, *a: (visited.append(len(some)), visit(self, some, *a))[1])
    best = stratified_index._Best(3)
    codes = next(iter(slices(pa.array(["needle"]))))
    starts, ends, _ = codes.words(stratified_index.SEPARATORS)
    sought = stratified_index.code(codes.prefix_sums(), starts, ends)
    stratified_index.Segment(lists).search(sought, np.array([7]), best)
    assert best.ids.tolist() == [0, 1, 2] and sum(visited) <= stratified_index.FIRST_STRATA
