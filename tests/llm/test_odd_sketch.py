import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tiersmith.llm import odd_sketch
from tiersmith.llm.components import components


def brute_force(rows, words, percent):
    """doc_id -> (set size, least id reachable), by comparing all pairs."""
    sets = []
    for doc_id, text in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        if len(found) >= words:
            own = {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}
        else:
            own = {tuple(found)} if found else set()
        sets.append((doc_id, own))
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, x) in enumerate(sets):
        for j in range(i):
            y = sets[j][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(sets):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted((d, len(s), least[find(i)]) for i, (d, s) in enumerate(sets))


def family(seed, copies, length=120):
    """A text and copies of it with words exchanged, at all degrees of likeness."""
    draw = random.Random(seed)
    words = [f"{draw.choice('abcdefghij')}{draw.randrange(4000)}" for _ in range(length)]
    out = [" ".join(words)]
    for _ in range(copies):
        other = list(words)
        for _ in range(draw.randrange(0, 9)):
            other[draw.randrange(length)] = f"new{draw.randrange(10**6)}"
        out.append(" ".join(other))
    return out


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_components_equal_brute_force(make, words, percent):
    texts = [t for seed in range(6) for t in family(seed, 40)] + ["a b", "A  b", "a b c", "", "b a"]
    rows = list(enumerate(texts))
    found = odd_sketch.near_duplicates(make(rows), words, percent, block=16)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in found.collect())
    assert got == brute_force(rows, words, percent)


def test_a_chain_of_links_is_one_group(make):
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[:5 * i] and [f"n{k}" for k in range(5 * i)] + words[5 * i :] or words)) for i in range(30)]
    found = odd_sketch.near_duplicates(make(rows), 3, 85, block=8)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in found.collect())
    assert got == brute_force(rows, 3, 85)


def test_odd_rows(make, odd_rows):
    found = odd_sketch.near_duplicates(make(odd_rows))
    rows = found.collect()
    assert len(rows) == len(odd_rows)
    by_id = {(r.doc_id, r.n_shingles): r for r in rows}
    assert by_id[(2, 11)].component_id == 1 and not by_id[(2, 11)].kept
    assert by_id[(None, 11)].component_id == 1 and not by_id[(None, 11)].kept
    assert by_id[(1, 11)].kept
    for empty in (3, 4, 5):
        assert by_id[(empty, 0)].component_id == empty and by_id[(empty, 0)].kept
    assert by_id[(6, 1)].component_id == 6 and by_id[(7, 1)].component_id == 7
    assert by_id[(8, 59_996)].kept


def test_empty_table(make):
    assert odd_sketch.near_duplicates(make([])).count() == 0
    assert odd_sketch.without_near_duplicates(make([])).count() == 0


def test_one_row_of_each_group_stays(make):
    texts = family(1, 20)
    rows = [(i, t) for i, t in enumerate(texts)]
    kept = odd_sketch.without_near_duplicates(make(rows), words=3, percent=85)
    groups = {least for _, _, least in brute_force(rows, 3, 85)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(groups)
    assert "key" in kept.columns


def test_sketches_estimate_similarity():
    draw = np.random.default_rng(3)
    sign = odd_sketch._signer(24, 5, 256)
    base = draw.integers(0, 2**63, 800, dtype=np.int64).astype(np.uint64)
    for share in (0.95, 0.85):
        apart = []
        for _ in range(30):
            keep = int(800 * 2 * share / (1 + share))
            x = np.sort(base)
            y = np.sort(np.concatenate([draw.permutation(base)[:keep], draw.integers(0, 2**63, 800 - keep, dtype=np.int64).astype(np.uint64)]))
            _, sketches = sign([x, y])
            apart.append(np.bitwise_count(sketches[0].view(np.uint64) ^ sketches[1].view(np.uint64)).sum())
        expected = odd_sketch.most_differing_bits(share, 120, 256)
        assert abs(np.mean(apart) - expected) < 6


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(300, 300)]
    frame = spark.createDataFrame(edges, "a long, b long")
    roots = {r.node: r.root for r in components(frame).collect()}
    assert {roots[i] for i in range(41)} == {0}
    assert {roots[i] for i in range(100, 160)} == {100}
    assert 300 not in roots


def test_short_texts_are_one_shingle():
    sets = dict(odd_sketch.shingle_sets(pa.array(["a b", "a c", None, "a b"]), 3))
    assert [len(sets[i]) for i in range(4)] == [1, 1, 0, 1]
    assert sets[0] == sets[3] and sets[0] != sets[1]
