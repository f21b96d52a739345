"""Document quality by rules that vote, weighed without labels.

Each rule votes for good text (1), for junk (-1) or abstains (0). How far a
rule can be trusted is not set but estimated: expectation-maximisation over the
counts of all vote patterns fits, for good and for junk documents, how often a
rule gives each vote, and how many documents are good. A document's posterior
probability of being good then takes the place of passing every rule.

Everything is DataFrame and SQL functions. The patterns are at most three to
the power of the number of rules, whatever the number of documents.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiersmith.session import stage

WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"

#: A document with fewer words, or with more words in repeated windows (per cent), fails at once.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

#: Each rule: a name, when it votes for junk, and when for good text ("false": never).
#: What makes text junk differs, and a text with one fault is like good text in all
#: else. So the rules that look for a fault abstain where they find none, and every
#: fault is looked for by two rules or more, whose agreement tells how far they can
#: be trusted. Good text is voted for by two rules that each take a whole side of a
#: text together, its marks and its flow: a lone weak fault on one side can then be
#: outvoted by the other, and a text with no vote at all is not taken for good.
RULES = (
    ("symbols_by_word", "100 * n_symbols > 10 * n_words", "false"),
    ("symbols_by_character", "100 * n_symbols > 3 * word_chars", "false"),
    ("capital_words", "100 * n_capital_words > 20 * n_words", "false"),
    ("capital_letters", "100 * n_capitals > 30 * word_chars", "false"),
    ("marks", "100 * n_marks > 10 * n_words", "false"),
    ("repeats", "100 * n_repeat_words > 30 * n_words", "false"),
    ("windows", "100 * n_windows < 75 * (n_words - 2)", "false"),
    ("echoes", "100 * n_echoes > 10 * n_words", "false"),
    ("lines", "100 * n_dup_lines > 40 * n_lines", "false"),
    ("form", "false", "100 * n_symbols <= 8 * n_words AND 100 * n_capitals <= 20 * word_chars AND n_marks = 0"),
    (
        "flow",
        "false",
        "100 * n_repeat_words <= 10 * n_words AND 100 * n_windows >= 90 * (n_words - 2) AND 100 * n_dup_lines <= 20 * n_lines",
    ),
)
ROUNDS = 30
#: At the start: the share of good documents, and how often a rule votes for the
#: right side, abstains, and votes for the wrong side.
PRIOR, RIGHT, ABSTAINS, WRONG = 0.85, 0.3, 0.68, 0.02
SMOOTHING = 0.01


def text_counts(docs: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Counts of each whole text, in one pass without a shuffle.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines`` (with a word),
    ``n_dup_lines``, ``n_repeat_words`` (words in three-word windows found
    twice or more), ``n_windows`` (different ones), ``n_capitals`` (letters),
    ``n_capital_words`` (runs of two capitals or more), ``n_marks`` (doubled
    exclamation marks) and ``n_echoes`` (words equal to the word before). NULL
    is empty. Windows are compared by 64-bit hashes.
    """
    text = F.coalesce("text", F.lit(""))
    cut = docs.select(*keep, text.alias("text")).select(
        *keep,
        F.array_remove(F.split("text", WHITE), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD)).alias("lines"),
        F.regexp_count("text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        F.regexp_count("text", F.lit(r"\p{Lu}{2,}")).cast("long").alias("n_capital_words"),
        F.regexp_count("text", F.lit("!!")).cast("long").alias("n_marks"),
    )
    words = F.col("words")
    hashed = cut.select(
        *keep,
        "n_symbols",
        "n_capitals",
        "n_capital_words",
        "n_marks",
        F.size("words").alias("n"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform(
            words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))
        ).alias("hashes"),
        F.size(F.filter(words, lambda w, i: w == F.get(words, i - 1))).cast("long").alias("n_echoes"),
    )
    # The place of a window takes as many low bits of its hash as places need;
    # sorting then brings equal windows together and still tells where they are.
    windows = F.greatest(F.col("n") - 2, F.lit(0))
    places = hashed.withColumn("hashes", F.slice("hashes", 1, windows)).withColumn(
        "mask",
        F.expr("shiftleft(1L, CAST(ceil(log2(greatest(n, 2))) AS INT)) - 1"),
    )
    packed = places.withColumn(
        "packed",
        F.sort_array(F.expr("transform(hashes, (h, i) -> (h & ~coalesce(mask, 0L)) | CAST(i AS LONG))")),
    )
    # Neighbours are compared by the whole hash once their high bits agree.
    repeated = F.expr(
        """filter(packed, (x, k) ->
            ((x ^ get(packed, k + 1)) & ~mask = 0
                AND get(hashes, CAST(x & mask AS INT)) = get(hashes, CAST(get(packed, k + 1) & mask AS INT)))
            OR ((x ^ get(packed, k - 1)) & ~mask = 0
                AND get(hashes, CAST(x & mask AS INT)) = get(hashes, CAST(get(packed, k - 1) & mask AS INT))))"""
    )
    found = packed.withColumn("repeated", repeated).withColumn(
        "repeated", F.sort_array(F.expr("transform(repeated, x -> x & mask)"))
    )
    covered = F.expr(
        """aggregate(transform(repeated, (x, k) -> least(3L, coalesce(get(repeated, k + 1) - x, 3L))),
                     0L, (a, x) -> a + x)"""
    )
    return found.select(
        *keep,
        F.col("n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        covered.alias("n_repeat_words"),
        F.size(F.array_distinct("hashes")).cast("long").alias("n_windows"),
        "n_capitals",
        "n_capital_words",
        "n_marks",
        "n_echoes",
    )


def votes(rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The votes of all rules as an array of -1, 0 and 1."""
    return F.array(
        *[F.when(F.expr(junk), -1).when(F.expr(good), 1).otherwise(0) for _, junk, good in rules]
    )


def posteriors(patterns: DataFrame, rules: int, rounds: int = ROUNDS) -> DataFrame:
    """``votes`` and ``posterior`` (good) of each pattern, from ``votes`` and ``n`` (documents).

    The parameters are one array: the share of good documents, then for each
    rule the logarithms of the probabilities of -1, 0 and 1 in junk, and of the
    same in good documents. A round replaces it by the estimate under the
    posteriors it gives; a hundredth of each vote is added so none is impossible.
    """
    start = [PRIOR, *[math.log(x) for x in (RIGHT, ABSTAINS, WRONG, WRONG, ABSTAINS, RIGHT)] * rules]
    initial = f"array({', '.join(f'{x!r}D' for x in start)})"

    def chance(side: int, prior: str) -> str:
        terms = f"aggregate(x.votes, struct(0D AS s, 0 AS r), (a, v) -> struct(a.s + p[1 + 6 * a.r + {3 * side} + v + 1] AS s, a.r + 1 AS r), a -> a.s)"
        return f"ln({prior}) + {terms}"

    good, junk = chance(1, "p[0]"), chance(0, "1 - p[0]")
    weighed = f"transform(patterns, x -> struct(x.votes AS votes, x.n AS n, 1 / (1 + exp(({junk}) - ({good}))) AS w))"
    # k numbers the entries of the parameters after the first: rule, side, vote.
    share = "CASE WHEN k % 6 >= 3 THEN y.w ELSE 1 - y.w END"
    mass = f"aggregate(e, 0D, (a, y) -> a + y.n * ({share}))"
    given = f"aggregate(e, 0D, (a, y) -> a + CASE WHEN y.votes[CAST(k / 6 AS INT)] = k % 3 - 1 THEN y.n * ({share}) ELSE 0D END)"
    total = "aggregate(e, 0D, (a, y) -> a + y.n)"
    everything = "aggregate(e, 0D, (a, y) -> a + y.n * y.w)"
    update = (
        f"concat(array(({everything} + 1) / ({total} + 2)), "
        f"transform(sequence(0, {6 * rules - 1}), k -> ln(({given} + {SMOOTHING}) / ({mass} + 3 * {SMOOTHING}))))"
    )
    # A one-element array binds what a round computes once to a name.
    step = f"transform(array({weighed}), e -> {update})[0]"
    fitted = f"aggregate(sequence(1, {rounds}), {initial}, (p, i) -> {step})"
    gathered = patterns.agg(
        F.array_sort(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n")))).alias("patterns")
    )
    return (
        gathered.where("size(patterns) > 0")
        .select("patterns", F.expr(fitted).alias("p"))
        .select(F.explode(F.expr(weighed)).alias("e"))
        .select("e.votes", F.col("e.w").alias("posterior"))
    )


def judge_documents(docs: DataFrame, keep: Sequence[str] = ("doc_id",), threshold: float = 0.5) -> DataFrame:
    """The counts, votes and posterior quality of every whole text, and whether it is kept.

    Returns ``keep``, the counts of ``text_counts``, ``base_failed`` (too short
    or too repetitive), ``votes``, ``posterior`` and ``kept`` (not failed, and
    the posterior reaches ``threshold``). Texts alike in all counts are judged
    alike; NULL, empty and blank texts fail. An empty table gives no rows.
    """
    counted = stage(text_counts(docs, keep).withColumn("votes", votes()), "votes")
    patterns = counted.groupBy("votes").agg(F.count(F.lit(1)).alias("n"))
    # At most one row for each pattern of votes.
    known = F.broadcast(posteriors(patterns, len(RULES)))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    return (
        counted.join(known, "votes", "left")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
    )
