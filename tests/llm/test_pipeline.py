import hashlib
import re
from collections import Counter

import corpus_pipeline
import pyarrow as pa
import pytest

from tiersmith.llm import subword_quality
from tiersmith.llm.textcodes import slices

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF_DIR = "/root/testdata/sf0.001"


def test_each_stage_on_its_own_input(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}
    for number, (name, step) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(number))
        step(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        if number < 4:
            assert docs.columns == columns, name
            rows = docs.collect()
            assert rows and all(before[r.doc_id] == r.text for r in rows)
            if number < 3:
                assert len({r.doc_id for r in rows}) == len(rows)
            if name == "exact dedup":
                assert len({r.text for r in rows}) == len(rows) == len(set(before.values()))
            before = {r.doc_id: r.text for r in rows}
    for r in docs.collect():
        assert r.decoded_sha256 == hashlib.sha256(before[r.doc_id].encode()).hexdigest()
        assert len(r.ids) == r.n_tokens


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES if s[0] != "quality classifier"], ids=lambda s: s[0])
def test_odd_rows_and_empty_tables(spark, make, odd_rows, stage):
    _, step = stage
    for rows in (odd_rows, []):
        out = step(spark, make(rows), SF_DIR)
        assert out.count() <= 3 * len(rows)


def test_quality_of_odd_rows(spark, make, odd_rows):
    docs = make(odd_rows)
    assert corpus_pipeline.quality(spark, docs, SF_DIR).columns == docs.columns


def test_run(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 100


def stage_input(spark, tmp_path, last):
    """What the stage named ``last`` gets over the small documents."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for number, (name, step) in enumerate(corpus_pipeline.STAGES):
        if name == last:
            return docs
        step(spark, docs, SF_DIR).write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_near_dedup_equals_all_pairs(spark, tmp_path):
    docs = stage_input(spark, tmp_path, "near dedup")
    sets = {r.doc_id: shingles(r.text) for r in docs.collect()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    want = sorted(i for i in ids if find(i) == i)
    assert sorted(r.doc_id for r in corpus_pipeline.near(spark, docs, SF_DIR).collect()) == want
    assert len(want) < len(ids)


def test_the_mix_equals_a_plain_systematic_sample(spark, tmp_path):
    docs = stage_input(spark, tmp_path, "source mix")
    rows = [(r.doc_id, r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in docs.collect()]
    sources = sorted({s for _, s, _ in rows})
    size = {s: sum(n for _, t, n in rows if t == s) for s in sources}
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    target, left, open_ = {}, float(sum(size.values())), list(sources)
    while open_:
        level = left / sum(weight[s] for s in open_)
        capped = [s for s in open_ if level * weight[s] > 3 * size[s]]
        if not capped:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 3.0 * size[s] for s in capped}
        left -= sum(3 * size[s] for s in capped)
        open_ = [s for s in open_ if s not in capped]
    want = Counter()
    for s in sources:
        rate = min(int(target[s] * 2**24 / size[s]), 3 * 2**24) if size[s] else 0
        at = int(hashlib.md5(f"mix={s}".encode()).hexdigest()[:6], 16)
        for doc_id, _, _ in sorted((r for r in rows if r[1] == s), key=lambda r: (r[2], r[0])):
            want[doc_id] += (at + rate >> 24) - (at >> 24)
            at += rate
    got = Counter(r.doc_id for r in corpus_pipeline.mixed(spark, docs, SF_DIR).collect())
    assert got == +want


def test_quality_keeps_what_each_row_scores(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality(spark, docs, SF_DIR).collect()}
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").selectExpr("doc_id", "quality AS label")
    model = subword_quality.learn(docs, labels.where(~subword_quality.held_out()))
    scores = {}
    for r in docs.collect():
        (part,) = slices(pa.array([r.text]))
        scores[r.doc_id] = float(model.scores(part)[0])
    assert kept == {i for i, score in scores.items() if score >= corpus_pipeline.QUALITY}


def test_quality_of_an_empty_table(spark, make):
    assert corpus_pipeline.quality(spark, make([]), SF_DIR).count() == 0
