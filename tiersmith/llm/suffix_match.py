"""Benchmark decontamination with a generalised suffix automaton of the test items.

The words of all test items make up one automaton, whose states stand for the
runs of words that occur in items. Words of a document are streamed through
it: after each word the state and a length say what the longest run of words
is that ends here and occurs in an item. Where that length reaches the window,
the last words are a window of an item; an item shorter than the window counts
as a whole. The words of such windows are hit, and may be cut out.

Test items are dealt into blocks of bounded size; each block is an automaton of
its own in the shared folder, and a task holds one at a time. A match of two
words or more goes along pairs of words that items hold, so only stretches of
such pairs are streamed; elsewhere the length is known to be one or nothing.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiersmith.llm.query_blocks import BLOCK, Blocks, dealt_into_blocks
from tiersmith.llm.textcodes import Slice, code, slices, sorted_distinct

WINDOW = 10
#: Bytes of item text in one automaton.
BLOCK_BYTES = 1 << 18
#: Pairs of a document and an item handled at a time.
_PAIRS = 2_000_000

#: Words are runs of digits, ASCII letters and bytes of other alphabets.
SEPARATORS = np.ones(256, bool)
SEPARATORS[48:58] = SEPARATORS[65:91] = SEPARATORS[97:123] = SEPARATORS[128:] = False


class _Builder:
    """The states of a generalised suffix automaton, added word by word."""

    def __init__(self) -> None:
        self.go: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.longest = [0]

    def _state(self, longest: int, go: dict[int, int], link: int) -> int:
        self.go.append(go)
        self.longest.append(longest)
        self.link.append(link)
        return len(self.link) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """Part the shorter runs of ``target``, which follow ``state``, from its longer ones."""
        short = self._state(self.longest[state] + 1, dict(self.go[target]), self.link[target])
        self.link[target] = short
        while state != -1 and self.go[state].get(word) == target:
            self.go[state][word] = short
            state = self.link[state]
        return short

    def _step(self, state: int, word: int) -> int:
        """The state of the runs that ``word`` makes of those of ``state``, with no room for longer ones."""
        target = self.go[state][word]
        return target if self.longest[target] == self.longest[state] + 1 else self._split(state, word, target)

    def add(self, words: Sequence[int]) -> list[int]:
        """Add an item; returns the state of each of its beginnings."""
        last, states = 0, []
        for word in words:
            if word in self.go[last]:
                last = self._step(last, word)
            else:
                before, last = last, self._state(self.longest[last] + 1, {}, 0)
                while before != -1 and word not in self.go[before]:
                    self.go[before][word] = last
                    before = self.link[before]
                if before != -1:
                    self.link[last] = self._step(before, word)
            states.append(last)
        return states


def _distinct_pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of two columns of whole numbers below 2**31, in order."""
    both = sorted_distinct((left.astype(np.int64) << 32) | right.astype(np.int64))
    return both >> 32, both & 0xFFFFFFFF


def automaton(items: list[np.ndarray], window: int) -> dict[str, np.ndarray]:
    """The automaton of items, each an array of word codes, as plain arrays.

    ``window_of`` gives for a state of long runs the state of their last
    ``window`` words, ``short_of`` the state of the longest whole item that is
    shorter than the window and ends all runs of a state (0: none).
    """
    vocabulary = sorted_distinct(np.concatenate([np.zeros(0, np.uint64), *items]))
    builder, ends, owners, links = _Builder(), [], [], []
    whole = set()
    for number, codes in enumerate(items):
        words = np.searchsorted(vocabulary, codes)
        states = builder.add(words.tolist())
        links.append(words[:-1] * len(vocabulary) + words[1:])
        if 0 < len(states) < window:
            whole.add(states[-1])
        reached = states[window - 1 :] or states[-1:]
        ends += reached
        owners += [number] * len(reached)
    n = len(builder.link)
    window_of, short_of = [0] * n, [0] * n
    for state in np.argsort(builder.longest, kind="stable")[1:].tolist():
        link = builder.link[state]
        if builder.longest[state] >= window:
            window_of[state] = window_of[link] if builder.longest[link] >= window else state
        short_of[state] = state if state in whole else short_of[link]
    # Items shorter than the window are known by their last state itself.
    at = [window_of[s] or s for s in ends]
    state, item = _distinct_pairs(np.array(at, np.int64), np.array(owners, np.int64))
    edges = [(s, word, to) for s, go in enumerate(builder.go) for word, to in go.items()]
    edge = np.array(edges, np.int64).reshape(-1, 3)
    return {
        "vocabulary": vocabulary.view(np.int64),
        "pairs": sorted_distinct(np.concatenate([np.zeros(0, np.int64), *links])),
        "edge": edge[:, 0] * max(1, len(vocabulary)) + edge[:, 1],
        "target": edge[:, 2],
        "link": np.array(builder.link, np.int64),
        "longest": np.array(builder.longest, np.int64),
        "window_of": np.array(window_of, np.int64),
        "short_of": np.array(short_of, np.int64),
        "owned": state,
        "owner": item,
        "least": np.array([min([window, *(len(x) for x in items if len(x))])]),
    }


class Matcher:
    """An automaton ready to take words."""

    def __init__(self, arrays: dict[str, np.ndarray], names: list[str | None], window: int) -> None:
        self.__dict__.update(arrays)
        self.vocabulary = self.vocabulary.view(np.uint64)
        self.names = names
        self.window = window
        self.least = int(arrays["least"][0])
        self._go = dict(zip(self.edge.tolist(), self.target.tolist(), strict=True))
        self._link, self._longest = self.link.tolist(), self.longest.tolist()

    def _stream(self, words: list[int]) -> tuple[list[int], list[int]]:
        """The state and the longest matching length after each word of a stretch."""
        go, link, longest, width = self._go.get, self._link, self._longest, len(self.vocabulary)
        state = length = 0
        states, lengths = [], []
        for word in words:
            to = go(state * width + word)
            while to is None and state:
                state = link[state]
                length = longest[state]
                to = go(state * width + word)
            state, length = (0, 0) if to is None else (to, length + 1)
            states.append(state)
            lengths.append(length)
        return states, lengths

    def matches(self, codes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, states and longest lengths of all matches of ``least`` words or more.

        ``codes`` are words of several texts in a row; ``begins`` marks the first
        of each text.
        """
        none = np.zeros(0, np.int64)
        if not len(codes) or not len(self.vocabulary):
            return none, none, none
        words = np.minimum(np.searchsorted(self.vocabulary, codes), len(self.vocabulary) - 1)
        known = self.vocabulary[words] == codes
        linked = np.zeros(len(codes), bool)
        behind = np.flatnonzero(known[1:] & known[:-1] & ~begins[1:]) + 1
        if len(self.pairs) and len(behind):
            pairs = words[behind - 1] * len(self.vocabulary) + words[behind]
            linked[behind] = self.pairs[np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)] == pairs
        starts = np.flatnonzero(known & ~linked)
        ends = np.flatnonzero(known & ~np.append(linked[1:], False)) + 1
        long = ends - starts >= self.least
        places, states, lengths = [none], [none], [none]
        for start, end in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            state, length = self._stream(words[start:end].tolist())
            length = np.array(length, np.int64)
            enough = np.flatnonzero(length >= self.least)
            places.append(enough + start)
            states.append(np.array(state, np.int64)[enough])
            lengths.append(length[enough])
        return np.concatenate(places), np.concatenate(states), np.concatenate(lengths)

    def windows(self, places: np.ndarray, states: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(last word, state)`` of every window and short item that ends at a match."""
        long = lengths >= self.window
        found = [(places[long], self.window_of[states[long]])]
        short = np.where(lengths == self.longest[states], self.short_of[states], self.short_of[self.link[states]])
        while short.any():
            there = short > 0
            places, short = places[there], short[there]
            found.append((places, short))
            short = self.short_of[self.link[short]]
        return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])

    def items(self, docs: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct pairs of a document and an item that has one of its windows."""
        docs, states = _distinct_pairs(docs, states)
        first = np.searchsorted(self.owned, states)
        counts = np.searchsorted(self.owned, states, "right") - first
        out = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        ends = np.cumsum(counts)
        at = 0
        while at < len(docs):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + _PAIRS, "right")))
            some = counts[at:to]
            inner = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
            owner = self.owner[np.repeat(first[at:to], some) + inner]
            out = _distinct_pairs(np.append(out[0], np.repeat(docs[at:to], some)), np.append(out[1], owner))
            at = to
        return out


_ARRAYS = ("vocabulary", "pairs", "edge", "target", "link", "longest", "window_of", "short_of", "owned", "owner", "least")
_BLOCK_SCHEMA = ", ".join(f"{name} array<long>" for name in _ARRAYS) + f", names array<string>, {BLOCK} int"


def word_codes(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all words of a slice, with their starts and ends, and the first word of each text."""
    starts, ends, first = part.words(SEPARATORS)
    return code(part.prefix_sums(), starts, ends), starts, ends, first


def _build(window: int):
    def run(table: pa.Table) -> pa.Table:
        items = []
        for part in slices(table.column("text")):
            codes, _, _, first = word_codes(part)
            items += [codes[a:b] for a, b in itertools.pairwise(first.tolist())]
        arrays = automaton(items, window)
        columns = {name: pa.array([arrays[name]], pa.list_(pa.int64())) for name in _ARRAYS}
        columns["names"] = pa.array([table.column("item_id").to_pylist()], pa.list_(pa.string()))
        columns[BLOCK] = table.column(BLOCK).slice(0, 1)
        return pa.table(columns)

    return run


def item_automata(items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> Blocks:
    """The automata of ``items`` (``item_id``, ``text``), by blocks, in the shared folder.

    Items without words have no part in them. A NULL ``item_id`` names no item:
    words are hit through it, but it is neither counted nor listed.
    """
    dealt = dealt_into_blocks(items.select(F.col("item_id").cast("string"), "text"), block_bytes)
    built = dealt.select("item_id", "text", BLOCK).groupBy(BLOCK).applyInArrow(_build(window), _BLOCK_SCHEMA)
    return Blocks.write(built, "automata")


def _matcher(block: pa.Table, window: int) -> Matcher:
    # One row, but a reader may cut it into chunks.
    row = block.combine_chunks()
    arrays = {name: row.column(name).chunk(0).values.to_numpy(zero_copy_only=False) for name in _ARRAYS}
    return Matcher(arrays, row.column("names").chunk(0).values.to_pylist(), window)


class _Hits:
    """What a slice of texts shares with the items of all blocks."""

    def __init__(self, part: Slice) -> None:
        self.codes, self.starts, self.ends, self.first = word_codes(part)
        self.n_words = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(part)), self.n_words)
        self.begins = np.zeros(len(self.codes) + 1, bool)
        self.begins[self.first] = True
        self.begins = self.begins[:-1]
        self.hit = np.zeros(len(self.codes), bool)
        self.longest = np.zeros(len(part), np.int64)
        self.items: list[set[str]] = [set() for _ in range(len(part))]

    def take(self, matcher: Matcher) -> None:
        places, states, lengths = matcher.matches(self.codes, self.begins)
        if not len(places):
            return
        np.maximum.at(self.longest, self.doc[places], lengths)
        last, found = matcher.windows(places, states, lengths)
        spans = np.minimum(matcher.longest[found], matcher.window)
        edges = np.zeros(len(self.codes) + 1, np.int64)
        np.add.at(edges, last + 1 - spans, 1)
        np.add.at(edges, last + 1, -1)
        self.hit |= np.cumsum(edges)[:-1] > 0
        for doc, item in zip(*(x.tolist() for x in matcher.items(self.doc[last], found)), strict=True):
            if matcher.names[item] is not None:
                self.items[doc].add(matcher.names[item])

    def n_hit(self) -> np.ndarray:
        running = np.append(0, np.cumsum(self.hit))
        return running[self.first[1:]] - running[self.first[:-1]]

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents, first bytes and ends of the stretches of hit words."""
        follows = np.append(False, self.hit[1:] & self.hit[:-1] & ~self.begins[1:])[: len(self.hit)]
        opened = np.flatnonzero(self.hit & ~follows)
        closed = np.flatnonzero(self.hit & ~np.append(follows[1:], False)[: len(self.hit)])
        return self.doc[opened], self.starts[opened], self.ends[closed]


def match_documents(
    docs: DataFrame, automata: Blocks, window: int = WINDOW, keep: Sequence[str] = ("doc_id",), cleaned: bool = False
) -> DataFrame:
    """What each whole text shares with the test items.

    Returns per row ``keep``, ``n_words``, ``n_hit`` (words inside windows that
    occur in items), ``longest`` (words of the longest run that an item holds,
    told from the least window on), ``items`` (ids of items with a window here, as
    sorted strings), ``spans`` (first byte and end of each stretch of hit
    words) and, if asked for, ``cleaned``: the text without those stretches.
    NULL, empty and blank texts have no words and share nothing; a cleaned NULL
    is empty. Without items nothing is hit. Every row gives one row, and other
    columns are ignored. Words are compared by 64-bit codes.
    """
    names = list(dict.fromkeys(keep))
    span = T.StructType().add("begin", "long").add("end", "long")
    schema = T.StructType(docs.select(*names).schema.fields)
    schema = schema.add("n_words", "long").add("n_hit", "long").add("longest", "long")
    schema = schema.add("items", T.ArrayType(T.StringType())).add("spans", T.ArrayType(span))
    schema = schema.add("cleaned", "string") if cleaned else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single = next(iter(automata), None) if len(automata.numbers) == 1 else None
        ready = None if single is None else _matcher(single, window)
        for batch in batches:
            for part in slices(batch.column("__text")):
                hits = _Hits(part)
                for matcher in [ready] if ready else (_matcher(block, window) for block in automata):
                    hits.take(matcher)
                yield output(batch.slice(part.first, len(part)), part, hits)

    def output(rows: pa.RecordBatch, part: Slice, hits: _Hits) -> pa.RecordBatch:
        doc, begin, end = hits.spans()
        inner = pa.StructArray.from_arrays(
            [pa.array(begin - part.offsets[doc]), pa.array(end - part.offsets[doc])], names=["begin", "end"]
        )
        where = np.searchsorted(doc, np.arange(len(part) + 1))
        columns = [rows.column(i) for i in range(len(names))]
        columns += [pa.array(hits.n_words), pa.array(hits.n_hit()), pa.array(hits.longest)]
        columns.append(pa.array([sorted(x) for x in hits.items], pa.list_(pa.string())))
        columns.append(pa.ListArray.from_arrays(pa.array(where, pa.int32()), inner))
        if cleaned:
            gone = np.zeros(len(part.data) + 1, np.int64)
            gone[begin] += 1
            np.add.at(gone, end, -1)
            kept = np.cumsum(gone[:-1]) == 0
            offsets = np.append(0, np.cumsum(kept))[part.offsets]
            buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(part.data[kept])]
            columns.append(pa.Array.from_buffers(pa.string(), len(part), buffers))
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(*names, F.col("text").alias("__text")).mapInArrow(run, schema)


def decontaminated(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: float = 0.5
) -> DataFrame:
    """``docs`` without the stretches they share with test items.

    Stretches of ``window`` words or more go, and short items as a whole. A
    document of whose words more than ``coverage`` are hit goes altogether.
    Texts without a hit stay as they are, NULL ones too.
    """
    rows = docs.select("text", F.struct(*docs.columns).alias("row"))
    found = match_documents(rows, item_automata(items, window), window, keep=("row",), cleaned=True)
    text = F.when(F.col("n_hit") > 0, F.col("cleaned")).otherwise(F.col("row.text"))
    columns = [text.alias("text") if name == "text" else F.col(f"row.`{name}`") for name in docs.columns]
    return found.where(F.col("n_hit") <= F.lit(coverage) * F.col("n_words")).select(*columns)
