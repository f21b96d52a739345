import hashlib
from collections import Counter

import pytest

from tiersmith.llm import shard_table

SHARDS = [f"n{i}" for i in range(7)]


def by_hand(shards, slots):
    """Whole permutations, and shards that look through theirs from the start at every turn."""
    number = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:15], 16)
    orders = []
    for name in shards:
        offset, step = number(f"{name}/offset") % slots, number(f"{name}/step") % (slots - 1) + 1
        orders.append([(offset + step * j) % slots for j in range(slots)])
        assert sorted(orders[-1]) == list(range(slots))
    holder = {}
    while len(holder) < slots:
        for shard, order in enumerate(orders):
            free = next((slot for slot in order if slot not in holder), None)
            if free is not None:
                holder[free] = shard
    return [holder[slot] for slot in range(slots)]


def test_table_equals_one_by_hand():
    assert shard_table.filled_slots(SHARDS, 701) == by_hand(SHARDS, 701)


def test_shares_differ_by_one_slot():
    shares = Counter(shard_table.filled_slots(SHARDS, 1009)).values()
    assert max(shares) - min(shares) <= 1 and len(shares) == 7


def test_a_shard_that_leaves_disturbs_little():
    before, after = shard_table.filled_slots(SHARDS, 5003), shard_table.filled_slots(SHARDS[:-1], 5003)
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != 6)
    assert moved < 0.1 * 5003


def test_bad_tables_are_errors():
    for shards, slots in (([], 7), (["a", "a"], 7), (["a", "b"], 9), (SHARDS, 5)):
        with pytest.raises(ValueError):
            shard_table.filled_slots(shards, slots)


def test_rows_get_the_slot_of_their_key(make, odd_rows):
    placed = shard_table.with_shard(make(odd_rows), SHARDS, slots=701)
    rows = placed.collect()
    assert len(rows) == len(odd_rows) and "size" in placed.columns
    table = by_hand(SHARDS, 701)
    for r in rows:
        key = "" if r.doc_id is None else str(r.doc_id)
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 701
        assert (r.slot, r.shard) == (slot, SHARDS[table[slot]])


def test_no_shuffle_and_columns_of_the_same_names(make):
    docs = make([(1, "a")]).selectExpr("*", "'old' AS shard", "'old' AS slot")
    placed = shard_table.with_shard(docs, SHARDS, slots=701)
    assert placed.first().shard in SHARDS
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    assert shard_table.with_shard(make([]), SHARDS, slots=701).count() == 0


def test_shards_are_written(make, spark, tmp_path):
    docs = make([(i, f"t{i}") for i in range(200)])
    shard_table.write_shards(docs, SHARDS, str(tmp_path / "out"), pieces=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 200 and back.select("shard").distinct().count() == 7
