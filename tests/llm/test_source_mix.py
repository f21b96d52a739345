import re
from collections import defaultdict

import pytest

from tiersmith.llm import source_mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights=(1, 2, 3), most=3):
    """Resharing by weight until no target is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = {s: (total - sum(capped.values())) * weight[s] / sum(weight[t] for t in order if t not in capped) for s in order if s not in capped}
        over = {s: most * sizes[s] for s in rest if rest[s] > most * sizes[s]}
        if not over:
            return capped | rest
        capped |= over


def check(docs, rows):
    found = source_mix.mix(docs, keep=("doc_id", "source")).collect()
    sizes, docs_of = defaultdict(int), defaultdict(list)
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    want = targets(dict(sizes)) if rows else {}
    assert len(found) == len(rows)
    taken = defaultdict(int)
    largest = defaultdict(int)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        docs_of[r.source].append(r)
    for source, words in taken.items():
        assert abs(words - want[source]) <= 3 * largest[source]
    return found


def test_targets_are_met(make):
    rows = [(i, " ".join(["w"] * (1 + i * 37 % 90)), f"s{min(i % 7, 4)}") for i in range(700)]
    docs = make(rows)
    found = check(docs, rows)
    assert sorted(map(tuple, found)) == sorted(map(tuple, source_mix.mix(docs, keep=("doc_id", "source")).collect()))


def test_one_source_with_nearly_everything(make):
    rows = [(i, "a b c d", "big") for i in range(500)] + [(1000 + i, "x y", s) for i, s in enumerate(["a", "c", None])]
    found = check(make(rows), rows)
    assert all(r.copies == 3 for r in found if r.source in ("a", "c") or r.source is None)


def test_odd_rows(make, odd_rows):
    check(make(odd_rows), odd_rows)


def test_mixed_rows_are_repeated_with_all_columns(make):
    rows = [(i, "a b c", "s" if i else "t") for i in range(10)]
    docs = make(rows)
    copies = {r.doc_id: r.copies for r in source_mix.mix(docs).collect()}
    out = source_mix.mixed(docs)
    assert out.columns == docs.columns
    counted = defaultdict(int)
    for r in out.collect():
        counted[r.doc_id] += 1
    assert dict(counted) == {k: v for k, v in copies.items() if v}


def test_no_words_and_empty_table(make):
    assert all(r.copies == 0 and r.target == 0 for r in source_mix.mix(make([(1, None, "a"), (2, " ", "b")])).collect())
    assert source_mix.mix(make([])).count() == 0
