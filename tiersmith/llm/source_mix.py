"""Mixing sources to target weights by systematic sampling.

Every source has a target number of words. Within a source each document is
expected ``target / size`` times; with one random offset for the source, the
running sum of these expectations says how often a document is taken: once for
each whole number the sum passes at it. Documents stand in order of size, so
what is taken comes near the target whatever their sizes.

The running sum is an exact whole number of 2**-24 parts times a document's
place in its source. Places come from a range partitioning: each row knows its
place in its partition, and only the rows of each source in each partition are
counted together, so a source may hold any share of all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiersmith.llm.rows import ROW, with_row_name
from tiersmith.session import stage

WORD = r"[^\x20\x09-\x0D]+"
_PARTS = 24  # bits after the point of an expected number of copies


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from ``source`` and ``source_size``.

    Sources in the order of their code points, NULL last, weigh ``weights`` in
    turn and share ``share`` of all words. A target stops at ``most`` times its
    source's size; the rest is shared again by weight. One row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1)
    known = sizes.withColumn("weight", weight.cast("long")).withColumn("cap", F.lit(most) * F.col("source_size"))
    # Sources reach their caps in the order of cap by weight: at the first that
    # does not, the rest by the weights left is the level of all that do not.
    by_cap = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    ahead = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    level = (F.lit(float(share)) * total - F.coalesce(F.sum("cap").over(ahead), F.lit(0))) / F.sum("weight").over(onward).cast("double")
    levels = known.withColumn("place", F.row_number().over(by_cap)).withColumn("level", level)
    open_level = F.min_by("level", F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("place"))).over(Window.partitionBy())
    return levels.withColumn("open", open_level).select(
        "source",
        "source_size",
        F.when(F.col("open").isNull(), F.col("cap").cast("double"))
        .otherwise(F.least(F.col("cap").cast("double"), F.col("open") * F.col("weight")))
        .alias("target"),
    )


def _offset(source: Column, seed: str) -> Column:
    """A number of 24 bits drawn for the source, the same in every run."""
    name = F.concat(F.lit(seed), F.coalesce(F.concat(F.lit("="), source), F.lit("")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, _PARTS // 4), 16, 10).cast("long")


def mix(
    docs: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    weights: Sequence[int] = (1, 2, 3),
    share: float = 1.0,
    most: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """How often each document is taken: ``keep``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    ``docs`` has ``text`` and ``source``; a size is the number of words (runs
    outside ASCII white space), 0 for NULL. Documents without words, and those
    of a source without words, are taken 0 times or as their turn has it; their
    size adds nothing. Equal rows are told apart by nothing and share their
    copies in any order. Every row gives one row.
    """
    columns = list(dict.fromkeys(keep))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = stage(
        docs.select(
            *columns,
            F.col("source").alias("__source"),
            F.col("doc_id").alias("__id"),
            size.alias("size"),
            F.xxhash64("text").alias("__text"),
        ),
        "sizes",
    )
    totals = sized.groupBy(F.col("__source").alias("source")).agg(F.sum("size").alias("source_size"))
    targets = source_targets(totals, weights, share, most)

    order = [F.col("__source"), F.col("size"), F.col("__id"), F.col("__text")]
    placed = stage(
        sized.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()),
        "placed",
    ).withColumn("__part", F.shiftrightunsigned("__at", 33))
    # One row per source and partition that has any of it.
    held = placed.groupBy("__source", "__part").agg(F.count(F.lit(1)).alias("n"), F.min("__at").alias("first"))
    before = Window.partitionBy("__source").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select(
        "__source",
        "__part",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
    )
    joined = F.expr("s.__source <=> p.__source AND s.__part = p.__part")
    parts = F.expr(f"shiftleft(1L, {_PARTS})")
    rate = F.when(
        F.col("source_size") > 0,
        F.least(
            F.floor(F.col("target") * parts.cast("double") / F.col("source_size").cast("double")).cast("long"),
            F.lit(most) * parts,
        ),
    ).otherwise(F.lit(0).cast("long"))
    passed = lambda place: F.shiftright(F.col("offset") + F.col("rate") * place, _PARTS)
    place = F.col("__at") + F.col("shift")
    plan = targets.select("*", rate.alias("rate"), _offset(F.col("source"), seed).alias("offset"))
    return (
        placed.alias("p")
        .join(starts.alias("s"), joined)
        .drop(F.col("s.__source"), F.col("s.__part"))
        .join(plan.alias("t"), F.expr("t.source <=> __source"))
        .select(
            *[F.col(f"p.{c}") for c in columns],
            F.col("p.size").alias("size"),
            "t.source_size",
            "t.target",
            (passed(place + 1) - passed(place)).alias("copies"),
        )
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as it is taken, with all their columns."""
    rows = with_row_name(docs)
    taken = mix(rows, keep=(ROW,), **options).where("copies > 0").select(ROW, "copies")
    return (
        rows.join(stage(taken, "taken"), ROW)
        .withColumn("copies", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select(*[rows[c] for c in docs.columns])
    )
