"""Near-duplicate documents by MinHash bands, odd sketches and exact confirmation.

1. Every text becomes its set of distinct word shingles. Texts with the same
   set are one class, whatever their number, so copies collapse in the first
   aggregation and never meet in a join.
2. A class has ``bands * rows`` MinHash samples. A band's samples are a bucket
   key; the samples folded into a parity bitmap are the odd sketch, and the
   bits in which two sketches differ estimate how many samples differ.
3. In a bucket every class is held against one centre, the class that shares
   most buckets. Pairs whose sizes or sketches rule out the threshold go; the
   rest is confirmed on the full sets.
4. Buckets whose members are then in one component are done. In the others all
   remaining pairs of different components are held against each other, in
   blocks of a bounded number of classes; a block returns a spanning forest of
   its confirmed links, never all of them.

At the threshold a pair shares no band with probability
``(1 - similarity ** rows) ** bands``. Unless given, the bands are as many as
bring this to one in a million: 24 at 85 % of the union, 35 at 80 %. A sketch is
five standard deviations from being ruled out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiersmith.llm.components import components
from tiersmith.llm.textcodes import code, follow, mix, slices, sorted_distinct, text_of_batch
from tiersmith.session import stage

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 80
ROWS = 5
#: How likely a pair at the threshold may share no band.
MISSED = 1e-6
SKETCH_BITS = 256
#: Classes, and shingles of all of them, on each side of a block of the exhaustive step.
BLOCK = 512
BLOCK_SHINGLES = 4_000_000
#: Parts in which the classes of a group are told its least row.
PARTS = 64


def bands_for(percent: int, rows: int = ROWS) -> int:
    """As many bands as a pair at the threshold needs to share one almost surely."""
    alike = (percent / 100) ** rows
    return 1 if alike == 1 else math.ceil(math.log(MISSED) / math.log(1 - alike))


def shingle_sets(texts: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(number, sorted distinct shingle codes)`` of each text; shorter texts are one shingle."""
    for part in slices(texts):
        starts, ends, first = part.words()
        own = code(part.prefix_sums(), starts, ends)
        grams = own
        for k in range(1, words):
            grams = follow(grams[:-1], own[k:]) if len(grams) > 1 else grams[:0]
        for d in range(len(part)):
            begin, end = int(first[d]), int(first[d + 1])
            if end - begin >= words:
                yield part.first + d, sorted_distinct(grams[begin : end - words + 1])
            elif end > begin:
                whole = own[begin : begin + 1]
                for k in range(begin + 1, end):
                    whole = follow(whole, own[k : k + 1])
                yield part.first + d, mix(whole + np.uint64(end - begin))
            else:
                yield part.first + d, own[:0]


def _signer(bands: int, rows: int, bits: int):
    samples = bands * rows
    draw = np.random.default_rng(7)
    multiply = draw.integers(1, 1 << 31, samples, dtype=np.int64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
    flip = draw.integers(0, 1 << 32, samples, dtype=np.uint64).astype(np.uint32)

    def sign(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Bucket keys (texts x bands) and sketches (texts x bits/64) of non-empty sets."""
        codes = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
        begins = np.cumsum([0, *map(len, sets[:-1])])
        keys = np.empty((len(sets), bands), np.uint64)
        parity = np.zeros((len(sets), bits), np.uint8)
        row = np.arange(len(sets))
        for j in range(samples):
            least = np.minimum.reduceat((codes ^ flip[j]) * multiply[j], begins).astype(np.uint64)
            band, place = divmod(j, rows)
            keys[:, band] = follow(np.full(len(sets), band, np.uint64) if place == 0 else keys[:, band], least)
            parity[row, mix(least + np.uint64(j << 32)) % np.uint64(bits)] ^= 1
        return keys.view(np.int64), np.packbits(parity, axis=1).view(np.int64)

    return sign


def _signatures(words: int, bands: int, rows: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = _signer(bands, rows, bits)
        lists = lambda x: pa.ListArray.from_arrays(
            pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel())
        )

        def flush(batch: pa.RecordBatch, held: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
            numbers = np.array([i for i, _ in held])
            sets = [s for _, s in held]
            keys = np.zeros((len(sets), bands), np.int64)
            sketch = np.zeros((len(sets), bits // 64), np.int64)
            full = [i for i, s in enumerate(sets) if len(s)]
            if full:
                keys[full], sketch[full] = sign([sets[i] for i in full])
            taken = batch.select(["doc_id", "text_key"]).take(pa.array(numbers))
            return pa.RecordBatch.from_arrays(
                [
                    *taken.columns,
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    lists(keys),
                    lists(sketch),
                ],
                names=["doc_id", "text_key", "n_shingles", "class", "bands", "sketch"],
            )

        for batch in batches:
            held, size = [], 0
            for item in shingle_sets(text_of_batch(batch), words):
                held.append(item)
                size += len(item[1])
                if size > 300_000:
                    yield flush(batch, held)
                    held, size = [], 0
            if held:
                yield flush(batch, held)

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held, size = [], [], 0

            def flush():
                return pa.RecordBatch.from_arrays(
                    [batch.column("class").take(pa.array(rows)), pa.array(held, pa.binary())],
                    names=["class", "shingles"],
                )

            for i, s in shingle_sets(text_of_batch(batch), words):
                rows.append(i)
                held.append(s.tobytes())
                size += len(held[-1])
                if size > 8_000_000:
                    yield flush()
                    rows, held, size = [], [], 0
            if rows:
                yield flush()

    return run


def _common(x: np.ndarray, y: np.ndarray) -> int:
    both = np.sort(np.concatenate([x, y]))
    return int(np.count_nonzero(both[1:] == both[:-1]))


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            left, right = batch.column("left"), batch.column("right")
            for i in range(batch.num_rows):
                x = np.frombuffer(left[i].as_buffer(), np.uint64)
                y = np.frombuffer(right[i].as_buffer(), np.uint64)
                common = _common(x, y)
                if 100 * common >= percent * (len(x) + len(y) - common):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return run


def _forest(percent: int, most_differing: int, band_count: int):
    """Links of a block between different components: a spanning forest of them."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        n = table.num_rows
        names = table.column("class").to_pylist()
        roots = table.column("root").to_pylist()
        band = int(table.column("band")[0].as_py())
        number: dict[bytes, int] = {}
        root = np.array([number.setdefault(r, len(number)) for r in roots])
        side = np.asarray(table.column("side"))
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("shingles")]
        length = np.array([len(s) for s in sets])
        keys = np.array(table.column("bands").to_pylist(), np.int64).reshape(n, band_count)
        sketch = np.array(table.column("sketch").to_pylist(), np.int64).view(np.uint64)
        parent = list(range(len(number)))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        rows = np.flatnonzero(side != 2)
        columns = np.flatnonzero(side != 1)
        out: list[tuple[int, int]] = []
        for i in rows:
            found = np.array([find(r) for r in range(len(number))])[root]
            others = columns if side[i] == 1 else columns[columns > i]
            others = others[found[others] != found[i]]
            least, most = np.minimum(length[others], length[i]), np.maximum(length[others], length[i])
            others = others[100 * least >= percent * most]
            if len(others):
                apart = np.bitwise_count(sketch[others] ^ sketch[i]).sum(axis=1)
                others = others[apart <= most_differing]
            if len(others) and band:
                # A pair is held together in the first band it shares only.
                others = others[~(keys[others, :band] == keys[i, :band]).any(axis=1)]
            for j in others:
                if find(root[i]) == find(root[j]):
                    continue
                common = _common(sets[i], sets[j])
                if 100 * common >= percent * (length[i] + length[j] - common):
                    parent[find(root[i])] = find(root[j])
                    out.append((i, j))
        return pa.table(
            {
                "a": pa.array([names[i] for i, _ in out], pa.binary()),
                "b": pa.array([names[j] for _, j in out], pa.binary()),
            }
        )

    return run


def most_differing_bits(floor: float, samples: int, bits: int) -> int:
    """Bits that sketches differ in, at most, if the similarity is ``floor`` or more (on average)."""
    toggles = 2 * samples * (1 - floor)
    return int(bits / 2 * (1 - (1 - 2 / bits) ** toggles))


def _plausible(a: str, b: str, percent: int, most: int, words: int) -> Column:
    sizes = 100 * F.least(f"{a}.n", f"{b}.n") >= percent * F.greatest(f"{a}.n", f"{b}.n")
    apart = sum(
        (F.bit_count(F.get(f"{a}.sketch", F.lit(i)).bitwiseXOR(F.get(f"{b}.sketch", F.lit(i)))) for i in range(words)),
        F.lit(0),
    )
    return sizes & (apart <= most)


def near_duplicates(
    docs: DataFrame,
    words: int = SHINGLE_WORDS,
    percent: int = SIMILARITY_PERCENT,
    bands: int | None = None,
    rows: int = ROWS,
    bits: int = SKETCH_BITS,
    block: int = BLOCK,
) -> DataFrame:
    """Each row's near-duplicate group: documents linked at ``percent`` of the union of their shingles.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. Returns
    ``doc_id``, ``text_key`` (hash of the text), ``n_shingles``,
    ``component_id`` (least ``doc_id`` reachable) and ``kept``.

    Words are runs outside ASCII white space, with A-Z lowered. A text with
    fewer than ``words`` words is one shingle; NULL, empty and blank texts have
    none and link with nothing. ``kept`` is true for the row of a group with
    the least (``doc_id``, ``text_key``), NULL ids last, so rows equal in both
    are kept together. Every row of the input gives one row.
    """
    bands = bands or bands_for(percent, rows)
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    signed = stage(
        keyed.mapInArrow(
            _signatures(words, bands, rows, bits),
            "doc_id long, text_key long, n_shingles long, class binary, bands array<long>, sketch array<long>",
        ),
        "signatures",
    )
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    classes = stage(
        signed.where("n_shingles > 0")
        .groupBy("class")
        .agg(
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"),
            F.min(F.struct("doc_id", "text_key")).alias("one"),
            F.min(order).alias("least"),
        ),
        "classes",
    )
    buckets = classes.select("class", "n", F.posexplode("bands").alias("band", "bucket"))
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"))
    shared = stage(buckets.drop("n").join(sizes.where("members > 1"), "bucket"), "shared-buckets")

    weight = shared.groupBy("class").agg(F.sum("members").alias("weight"))
    meeting = stage(classes.drop("least").join(weight, "class"), "meeting")
    members = shared.join(meeting.select("class", "weight", F.struct("class", "n", "sketch").alias("it")), "class")
    centre = members.groupBy("bucket").agg(F.max(F.struct("weight", "it")).getField("it").alias("centre"))
    floor = max(0.0, percent / 100 - 0.25)
    most = most_differing_bits(floor, bands * rows, bits)
    stars = (
        members.join(centre, "bucket")
        .where(F.col("it.class") != F.col("centre.class"))
        .where(_plausible("it", "centre", percent, most, bits // 64))
        .select(F.col("centre.class").alias("a"), F.col("it.class").alias("b"))
        .distinct()
    )

    # One row stands for each class that meets another; its set is read from the whole text.
    wanted = meeting.select("class", F.col("one.doc_id").alias("doc_id"), F.col("one.text_key").alias("text_key"))
    sets = stage(
        keyed.alias("d")
        .join(wanted.alias("w"), F.expr("d.text_key = w.text_key AND d.doc_id <=> w.doc_id"))
        .select("w.class", "d.text")
        .mapInArrow(_sets(words), "class binary, shingles binary")
        .dropDuplicates(["class"]),
        "sets",
    )
    star_links = stage(
        stars.join(sets.select(F.col("class").alias("a"), F.col("shingles").alias("left")), "a")
        .join(sets.select(F.col("class").alias("b"), F.col("shingles").alias("right")), "b")
        .mapInArrow(_confirm(percent), "a binary, b binary"),
        "links",
    )
    first = components(star_links)

    # Buckets that still hold several components: every pair between two of them.
    rooted = shared.where("members > 2").join(
        first.select(F.col("node").alias("class"), "root"), "class", "left"
    ).withColumn("root", F.coalesce("root", "class"))
    open_buckets = (
        rooted.groupBy("bucket")
        .agg(F.min("root").alias("least"), F.max("root").alias("greatest"))
        .where("least <> greatest")
        .select("bucket")
    )
    blocks = F.ceil(F.greatest(F.col("members") / block, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    home = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    pairs_of_blocks = F.explode(
        F.transform(
            F.sequence(F.lit(0), F.col("blocks") - 1),
            lambda other: F.struct(
                F.least(F.col("home"), other).alias("low"),
                F.greatest(F.col("home"), other).alias("high"),
                # 0: both sides are one block; 1 or 2: the lower or the higher of two.
                F.when(F.col("home") == other, 0).when(F.col("home") < other, 1).otherwise(2).alias("side"),
            ),
        )
    )
    rest = (
        rooted.join(open_buckets, "bucket")
        .withColumn("blocks", blocks)
        .withColumn("home", home)
        .select("bucket", "band", "class", "root", pairs_of_blocks.alias("p"))
        .select("bucket", "band", "class", "root", "p.low", "p.high", "p.side")
        .join(meeting.select("class", "bands", "sketch"), "class")
        .join(sets, "class")
        .groupBy("bucket", "low", "high")
        .applyInArrow(_forest(percent, most, bands), "a binary, b binary")
    )
    groups = components(star_links.unionByName(stage(rest, "links")))

    # The least row of each group, found among classes, of which a group may have very many:
    # what is told back to them goes in parts.
    part = F.pmod(F.xxhash64("class"), F.lit(PARTS)).cast("int").alias("part")
    linked = groups.select(F.col("node").alias("class"), "root").join(classes.select("class", "least"), "class")
    found = linked.groupBy("root").agg(F.min("least").alias("first"))
    told = found.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    first = linked.select("class", "root", part).join(told, ["root", "part"])
    leasts = classes.select("class", "least").join(first.select("class", "first"), "class", "left")
    leasts = leasts.select("class", F.coalesce("first", "least").alias("least"))
    placed = signed.select("doc_id", "text_key", "n_shingles", "class").join(leasts, "class", "left")
    return placed.select(
        "doc_id",
        "text_key",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("least.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        ((F.col("n_shingles") == 0) | order.eqNullSafe(F.col("least"))).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One row of each group of near duplicates, with all columns of ``docs``.

    The row with the least ``doc_id`` stays. Rows equal in ``doc_id`` and text
    stay together; exact dedup comes before.
    """
    dropped = near_duplicates(docs, **options).where(~F.col("kept")).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")
    )
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__key"))
    return docs.join(stage(dropped.distinct(), "dropped"), same, "left_anti")
