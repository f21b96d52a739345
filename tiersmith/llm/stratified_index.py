"""Ranked lexical search over an index stratified by document length.

The score of a term in a document depends on how often the term occurs there
(``tf``) and on a whole number ``m`` that follows from the document's length.
Documents of equal ``m`` are a stratum. The index is made of segments, some
megabytes of text each; a segment lists for every term, stratum by stratum, the
documents by falling ``tf``, and the impact of each ``tf`` in a stratum is
computed once, when the segment is built.

A search visits the strata of a segment by falling bound, the score that a
document of the stratum would have with the highest ``tf`` of every query term
there, and stops where no bound reaches the least score that still counts.
Nothing is approximate: equal bounds are visited, so ties are settled by id.

Segments stay where their texts were read; what moves between tasks are the
document frequencies of query terms and the best few documents of each task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiersmith.llm.packing import pack, repeats, unpack
from tiersmith.llm.query_blocks import BLOCK, Blocks, dealt_into_blocks
from tiersmith.llm.rows import ROW
from tiersmith.llm.textcodes import Slice, code, slices, sorted_distinct
from tiersmith.session import stage

#: A term is a run of digits, ASCII letters and other characters beyond ASCII.
SEPARATORS = np.ones(256, bool)
SEPARATORS[48:58] = SEPARATORS[65:91] = SEPARATORS[97:123] = SEPARATORS[128:] = False

#: Bytes of text in a segment; a longer text is a segment of its own.
SEGMENT_BYTES = 2_000_000
#: Bytes of query text that a task holds at a time.
QUERY_BYTES = 1 << 20
#: Strata visited at first; each further step visits twice as many.
FIRST_STRATA = 8

# Fixed values of the score.
SCALE, TF_WEIGHT, M_WEIGHT = 1_000_000_000, 1000, 12
M_BASE, M_SLOPE = 75, 25


@dataclass(frozen=True)
class Index:
    """The staged segments, and what the scores need to know of all documents."""

    segments: DataFrame
    n_docs: int  # with a term
    n_terms: int  # in all documents, with repeats


#: The lists of a segment.
_LISTS = (
    "doc_ids",  # by stratum
    "strata",  # the value m of each stratum
    "impacts",  # of each stratum and tf that occur together
    "terms",  # codes, in order as unsigned numbers
    "term_runs",  # number of the first run of each term, and the end
    "run_stratum",
    "run_impact",  # place in impacts
    "run_size",  # documents of equal term, stratum and tf
    "postings",  # places in doc_ids, run by run
)


def segment(part: Slice, n_docs: int, n_terms: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The documents of a slice that have terms, by stratum, and their lists."""
    starts, ends, first = part.words(SEPARATORS)
    codes = code(part.prefix_sums(), starts, ends)
    lengths = np.diff(first)
    # Whole numbers of any size, once per length that occurs.
    sizes, which = np.unique(lengths, return_inverse=True)
    m = np.array([M_BASE + (M_SLOPE * int(n) * n_docs) // n_terms for n in sizes], np.int64)[which]
    docs = np.argsort(m, kind="stable")
    docs = docs[lengths[docs] > 0]
    place = np.zeros(len(part), np.int64)
    place[docs] = np.arange(len(docs))
    strata, stratum_of = np.unique(m[docs], return_inverse=True)

    terms = sorted_distinct(codes)
    both = np.searchsorted(terms, codes) * len(docs) + np.repeat(place, lengths)
    both.sort()
    at, tf = repeats(both)
    term, doc = np.divmod(both[at], max(1, len(docs)))
    # By term and stratum already; within them by falling tf, then by document.
    lists = term * len(strata) + stratum_of[doc]
    most = int(tf.max(initial=0)) + 1
    key = lists * most + (most - 1 - tf)
    order = np.argsort(key, kind="stable")
    key, tf, doc = key[order], tf[order], doc[order]
    run, run_size = repeats(key)
    run_list, run_tf = key[run] // most, tf[run]
    run_term, run_stratum = np.divmod(run_list, max(1, len(strata)))
    kinds = run_stratum * most + run_tf
    known = sorted_distinct(kinds)
    each_tf = known % most
    impacts = SCALE * each_tf // (TF_WEIGHT * each_tf + M_WEIGHT * strata[known // most])
    return docs, {
        "strata": strata,
        "impacts": impacts,
        "terms": terms,
        "term_runs": np.searchsorted(run_term, np.arange(len(terms) + 1)),
        "run_stratum": run_stratum,
        "run_impact": np.searchsorted(known, kinds),
        "run_size": run_size,
        "postings": doc,
    }


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with terms, and all their terms: one row a batch."""
    for batch in batches:
        n_docs = n_terms = 0
        for part in slices(batch.column("text")):
            lengths = np.diff(part.words(SEPARATORS)[2])
            n_docs, n_terms = n_docs + np.count_nonzero(lengths), n_terms + int(lengths.sum())
        yield pa.RecordBatch.from_arrays([pa.array([n_docs], pa.int64()), pa.array([n_terms], pa.int64())], names=["n_docs", "n_terms"])


def build_index(docs: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> Index:
    """The index of all rows of ``docs`` (``doc_id``, ``text``), staged in the shared folder.

    Texts without a term, NULL among them, are not in it and not counted.
    Repeated rows are documents of their own. Terms are compared by 64-bit codes.
    """
    counted = docs.select("text").mapInArrow(_totals, "n_docs long, n_terms long")
    n_docs, n_terms = counted.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_docs", "n_terms")]).first()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text"), segment_bytes):
                there, lists = segment(part, n_docs, n_terms) if n_terms else ([], {})
                if len(there):
                    ids = batch.column("doc_id").slice(part.first, len(part)).take(pa.array(there))
                    ends = np.append(0, np.cumsum(lists["run_size"]))[lists["term_runs"]]
                    lexicon = pack({"terms": lists["terms"], "df": np.diff(ends)})
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lexicon]), pa.array([pack({"doc_ids": ids, **lists})])], names=["lexicon", "lists"]
                    )

    read = docs.select(F.col("doc_id").cast("long"), "text")
    return Index(stage(read.mapInArrow(run, "lexicon binary, lists binary"), "segments"), n_docs, n_terms)


def _places(known: np.ndarray, sought: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the codes sought are known (sorted), and where."""
    at = np.minimum(np.searchsorted(known, sought), max(0, len(known) - 1))
    there = np.flatnonzero(known[at] == sought) if len(known) else np.zeros(0, np.int64)
    return there, at[there]


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each distinct term of each query, with its repeats."""
    for batch in batches:
        for part in slices(batch.column("text")):
            starts, ends, first = part.words(SEPARATORS)
            codes = code(part.prefix_sums(), starts, ends)
            for i in range(len(part)):
                own = np.sort(codes[first[i] : first[i + 1]])
                at, times = repeats(own)
                if len(at):
                    row = batch.slice(part.first + i, 1).take(pa.array(np.zeros(len(at), np.int64)))
                    columns = [row.column(name) for name in ("file", "place", "item_id", BLOCK)]
                    columns += [pa.array(own[at].view(np.int64)), pa.array(times, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["file", "place", "item_id", BLOCK, "term", "repeats"])


def _document_frequencies(queries: Blocks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in queries:
                sought = sorted_distinct(block.column("term").to_numpy().view(np.uint64))
                found = np.zeros(len(sought), np.int64)
                for packed in batch.column("lexicon"):
                    lexicon = unpack(packed)
                    there, at = _places(lexicon["terms"].to_numpy().view(np.uint64), sought)
                    found[there] += lexicon["df"].to_numpy()[at]
                some = np.flatnonzero(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sought[some].view(np.int64)), pa.array(found[some])], names=["term", "df"]
                )

    return run


class _Best:
    """The ``k`` best documents of a query so far, best first, ties by id with NULL last."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.scores = self.ids = np.zeros(0, np.int64)
        self.no_id = np.zeros(0, bool)

    @property
    def least(self) -> int:
        """No document below this score can enter."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        scores, ids = np.append(self.scores, scores), np.append(self.ids, ids)
        no_id = np.append(self.no_id, no_id)
        order = np.lexsort((ids, no_id, -scores))[: self.k]
        self.scores, self.ids, self.no_id = scores[order], ids[order], no_id[order]


class Segment:
    """One row of the index, ready to be searched."""

    def __init__(self, lists: dict[str, pa.Array]) -> None:
        ids = lists["doc_ids"]
        self.no_id = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy()
        whole = lambda name: lists[name].to_numpy().astype(np.int64)
        self.n_strata = len(lists["strata"])
        self.terms = lists["terms"].to_numpy().view(np.uint64)
        self.term_runs, self.stratum, self.size = whole("term_runs"), whole("run_stratum"), whole("run_size")
        self.impact = whole("impacts")[lists["run_impact"].to_numpy()]
        self.first = np.cumsum(self.size) - self.size
        self.postings = lists["postings"].to_numpy()
        # The first run of a term in a stratum has its highest tf there.
        self.leads = np.ones(len(self.stratum), bool)
        np.not_equal(self.stratum[1:], self.stratum[:-1], out=self.leads[1:])
        self.leads[self.term_runs[:-1]] = True
        self.scores = np.zeros(len(self.ids), np.int64)

    def search(self, sought: np.ndarray, weights: np.ndarray, best: _Best) -> None:
        """Add the documents that belong to the best for terms and what a full impact of each is worth."""
        there, at = _places(self.terms, sought)
        begin, count = self.term_runs[at], self.term_runs[at + 1] - self.term_runs[at]
        runs = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())
        worth = np.repeat(weights[there], count) * self.impact[runs]
        strata = self.stratum[runs]
        bounds = np.zeros(self.n_strata, np.int64)
        leads = self.leads[runs]
        np.add.at(bounds, strata[leads], worth[leads])
        order = np.argsort(-bounds, kind="stable")
        falling = -bounds[order]
        at, step = 0, FIRST_STRATA
        while at < len(order) and -falling[at] >= best.least:
            to = min(at + step, int(np.searchsorted(falling, -best.least, "right")))
            chosen = np.zeros(self.n_strata, bool)
            chosen[order[at:to]] = True
            self._visit(np.flatnonzero(chosen[strata]), runs, worth, best)
            at, step = to, step * 2

    def _visit(self, some: np.ndarray, runs: np.ndarray, worth: np.ndarray, best: _Best) -> None:
        size = self.size[runs[some]]
        begin = self.first[runs[some]]
        docs = self.postings[np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())]
        np.add.at(self.scores, docs, np.repeat(worth[some], size))
        docs = sorted_distinct(docs)
        scores = self.scores[docs]
        self.scores[docs] = 0
        enough = scores >= best.least
        if enough.any():
            docs = docs[enough]
            best.add(scores[enough], self.ids[docs], self.no_id[docs])


def _search(queries: Blocks, k: int):
    names = ["file", "place", "item_id", "doc_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in queries:
                block = block.sort_by([("file", "ascending"), ("place", "ascending")]).combine_chunks()
                rows = np.stack([block.column(name).to_numpy() for name in ("file", "place")])
                new = np.append(True, (rows[:, 1:] != rows[:, :-1]).any(axis=0))
                cuts = np.append(np.flatnonzero(new), block.num_rows)
                terms = block.column("term").to_numpy().view(np.uint64)
                weights = block.column("weight").to_numpy()
                best = [_Best(k) for _ in cuts[1:]]
                for packed in batch.column("lists"):
                    held = Segment(unpack(packed))
                    for n, found in enumerate(best):
                        held.search(terms[cuts[n] : cuts[n + 1]], weights[cuts[n] : cuts[n + 1]], found)
                query = np.repeat(cuts[:-1], [len(x.scores) for x in best])
                columns = [block.column(name).take(pa.array(query)).combine_chunks() for name in names[:3]]
                ids, no_id = np.concatenate([x.ids for x in best]), np.concatenate([x.no_id for x in best])
                columns += [pa.array(ids, mask=no_id), pa.array(np.concatenate([x.scores for x in best]))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def search(index: Index, items: DataFrame, k: int = 20, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """The ``k`` best documents of every row of ``items`` (``item_id``, ``text``) by all its terms.

    Returns ``item_id``, ``rank`` (from 1), ``doc_id`` and ``score``: the best
    score first, equal ones by rising ``doc_id``, NULL last. Only scores above 0
    count, so a query may have fewer rows or none; queries without a term have
    none. Repeated rows of ``items`` are queries of their own, and repeated
    documents are found as often as they are there. ``item_id`` is passed on,
    NULL too; other columns are ignored.
    """
    dealt = dealt_into_blocks(items.select("item_id", "text"), query_bytes)
    dealt = dealt.select(f"{ROW}.file", f"{ROW}.place", "item_id", BLOCK, "text")
    kind = dealt.schema["item_id"].dataType.simpleString()
    head = f"file long, place long, item_id {kind}"
    terms = stage(dealt.mapInArrow(_query_terms, f"{head}, {BLOCK} int, term long, repeats long"), "query-terms")
    # Each distinct term is asked for in one block only, so every document counts once.
    n_blocks = (terms.agg(F.max(BLOCK)).first()[0] or 0) + 1
    distinct = terms.select("term").distinct().withColumn(BLOCK, F.pmod(F.xxhash64("term"), F.lit(n_blocks)).cast("int"))
    counted = index.segments.select("lexicon").mapInArrow(
        _document_frequencies(Blocks.write(distinct, "query-blocks")), "term long, df long"
    )
    rarity = F.floor(1000 * F.log(F.lit(2.0 * index.n_docs + 2) / (2 * F.sum("df") + 1)))
    weights = counted.groupBy("term").agg(rarity.alias("rarity"))
    weighted = terms.join(weights, "term").select(
        "file", "place", "item_id", BLOCK, "term", (F.col("repeats") * F.col("rarity")).alias("weight")
    )
    queries = Blocks.write(weighted, "queries")
    found = index.segments.select("lists").mapInArrow(_search(queries, k), f"{head}, doc_id long, score long")
    order = Window.partitionBy("file", "place").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
