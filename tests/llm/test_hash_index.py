import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tiersmith.llm import hash_index


def check(docs, rows, capacity=4096):
    found = hash_index.exact_duplicates(docs, capacity).collect()
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    assert len(found) == len(rows)
    by_digest = defaultdict(list)
    for r in found:
        by_digest[r.text_sha256].append(r)
    for text, ids in groups.items():
        own = by_digest[hashlib.sha256(text.encode()).hexdigest()]
        largest = max((i for i in ids if i is not None), default=None)
        assert sorted(str(r.doc_id) for r in own) == sorted(map(str, ids))
        assert {(r.keep_id, r.group_size) for r in own} == {(largest, len(ids))}
        kept = [r for r in own if r.kept]
        assert len(kept) == 1 and kept[0].doc_id == largest
    return found


def test_odd_rows(make, odd_rows):
    check(make(odd_rows), [r[:2] for r in odd_rows])


@pytest.mark.parametrize("capacity", [4, 16, 64])
def test_buckets_split_until_they_fit(make, capacity):
    rows = [(i, f"text {i % 300}") for i in range(500)]
    found = check(make(rows), rows, capacity)
    sizes = defaultdict(set)
    for r in found:
        sizes[r.bucket_depth, r.bucket].add(r.text_sha256)
    assert max(map(len, sizes.values())) <= capacity
    # Buckets are different prefixes: none begins another.
    for depth, bucket in sizes:
        for up in range(depth):
            assert (up, bucket >> (depth - up)) not in sizes


def test_directory_covers_every_slot_once(spark):
    entries = spark.range(1000).select(F.xxhash64("id").alias("key"))
    slots, depth = hash_index.directory(entries, 16)
    got = sorted(r.slot for r in slots.collect())
    assert got == list(range(2**depth)) and 6 <= depth <= 12


def test_equal_keys_are_told_apart_by_bytes(make, monkeypatch):
    # All texts of a length get one key, so buckets can only chain them.
    monkeypatch.setattr(hash_index.F, "xxhash64", lambda *c: F.length(F.col("text")).cast("long"))
    rows = [(i, f"t{i % 40:03d}") for i in range(100)]
    found = hash_index.exact_duplicates(make(rows), 8).collect()
    assert {r.group_size for r in found} == {2, 3}
    assert len({r.chain for r in found}) == 40
    assert sum(r.kept for r in found) == 40


def test_survivors_keep_their_columns(make, odd_rows):
    docs = make(odd_rows)
    kept = hash_index.without_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({r[1] or "" for r in odd_rows})


def test_rows_that_are_no_files(spark):
    docs = spark.range(20).selectExpr("id AS doc_id", "concat('t', id % 4) AS text")
    assert hash_index.without_duplicates(docs).count() == 4


def test_empty_table(make):
    assert hash_index.exact_duplicates(make([])).count() == 0
    assert hash_index.without_duplicates(make([])).count() == 0


def test_the_owners_of_slots_decide(make, monkeypatch):
    """Without the directory's slots texts do not meet, and rows do not find them."""
    rows = [(i, f"text {i % 30}") for i in range(90)]
    docs = make(rows)
    check(docs, rows, 4)
    with monkeypatch.context() as patched:
        patched.setattr(hash_index, "directory", lambda entries, capacity: (entries.limit(0).selectExpr("key AS slot", "0 AS bucket", "0 AS bucket_depth"), 0))
        assert hash_index.exact_duplicates(docs, 4).count() == 0


def test_a_text_of_most_rows_reaches_its_owner_merged(make, spark):
    rows = [(i, "hot" if i % 3 else f"t{i}") for i in range(3000)]
    found = check(make(rows), rows)
    assert max(r.group_size for r in found) == 2000


def test_long_texts_of_one_key_are_chained_by_bytes(make, monkeypatch):
    real = F.xxhash64
    monkeypatch.setattr(hash_index.F, "xxhash64", lambda *c: F.lit(5).cast("long") if c == ("text",) else real(*c))
    long = "x" * 200_000
    rows = [(1, long + "a"), (2, long + "b"), (3, long + "a"), (4, None), (5, ""), (6, long + "c")]
    found = hash_index.exact_duplicates(make(rows), 2).collect()
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.chain) for r in found}
    assert got == {
        1: (3, 2, False, 2), 3: (3, 2, True, 2), 2: (2, 1, True, 3), 6: (6, 1, True, 4), 4: (5, 2, False, 1), 5: (5, 2, True, 1),
    }
