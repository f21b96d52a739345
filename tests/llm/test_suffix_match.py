import random
import re

import pytest

from tiersmith.llm import suffix_match
from tiersmith.llm.suffix_match import decontaminated, item_automata, match_documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def windows_of(words, window):
    return {tuple(words[i : i + window]) for i in range(max(1, len(words) - window + 1))} if words else set()


def brute(texts, items, window):
    """Per text: words, hit words, ids of items with a window there, the longest run an item holds."""
    known = [(name, words_of(text)) for name, text in items]
    out = []
    for text in texts:
        words = words_of(text)
        hit, names, longest = set(), set(), 0
        for name, item in known:
            for some in windows_of(item, window):
                at = [i for i in range(len(words) - len(some) + 1) if tuple(words[i : i + len(some)]) == some]
                if at and name is not None:
                    names.add(str(name))
                hit.update(j for i in at for j in range(i, i + len(some)))
            for i in range(len(words)):
                for j in range(len(item)):
                    n = 0
                    while i + n < len(words) and j + n < len(item) and words[i + n] == item[j + n]:
                        n += 1
                    longest = max(longest, n)
        out.append((len(words), len(hit), sorted(names), longest))
    return out


@pytest.fixture(scope="module")
def items_of(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")


def found(docs, items, window, **options):
    rows = match_documents(docs, item_automata(items, window, **options), window).orderBy("doc_id").collect()
    return [(r.n_words, r.n_hit, r["items"], r.longest) for r in rows]


@pytest.mark.parametrize(("seed", "window", "letters"), [(1, 3, 3), (2, 4, 2), (3, 5, 6), (4, 10, 2), (5, 1, 9)])
@pytest.mark.parametrize("block_bytes", [suffix_match.BLOCK_BYTES, 60])
def test_random_texts_equal_brute_force(make, items_of, seed, window, letters, block_bytes):
    draw = random.Random(seed)
    text = lambda most: " ".join(draw.choice("ABCdefghé"[:letters]) for _ in range(draw.randint(0, most)))
    texts = [text(40) for _ in range(60)]
    items = [(draw.choice([n, n // 2, None]), text(15)) for n in range(14)]
    got = found(make([(n, t) for n, t in enumerate(texts)]), items_of(items), window, block_bytes=block_bytes)
    # Runs shorter than the least window are not told.
    sizes = [len(words_of(t)) for _, t in items]
    least = min([window, *(n for n in sizes if n)])
    assert [x[:3] for x in got] == [x[:3] for x in brute(texts, items, window)]
    if block_bytes == suffix_match.BLOCK_BYTES:
        assert [x[3] for x in got] == [x[3] if x[3] >= least else 0 for x in brute(texts, items, window)]


def test_odd_rows_give_a_row_each(make, items_of, odd_rows):
    docs = make(odd_rows)
    items = [(1, "five six seven eight nine"), (1, None), (None, "word word"), (None, None), (7, ""), (7, " ?! "), (8, "naïve GRÖSSE")]
    rows = match_documents(docs, item_automata(items_of(items), 4), 4, keep=("doc_id", "score")).collect()
    assert len(rows) == len(odd_rows) and {r.score for r in rows} == {"y"}
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append((r.n_words, r.n_hit, r["items"]))
    assert by_id[1] == [(15, 5, ["1"])] * 2 and by_id[2] == [(15, 5, ["1"])]
    assert by_id[3] == by_id[4] == by_id[5] == [(0, 0, [])]
    # An item without an id hits words and is not named.
    assert by_id[7] == [(2, 2, [])] and by_id[6] == [(1, 0, [])]
    assert by_id[8] == [(60_000, 0, [])] and by_id[9] == [(1, 0, [])]
    assert sorted(by_id[10]) == [(5, 0, []), (6, 0, [])]


def test_words_that_only_differ_beyond_ascii_case_are_different(make, items_of):
    docs = make([(1, "Größe"), (2, "GRÖSSE größe"), (3, "grÖsse")])
    assert [x[1] for x in found(docs, items_of([(1, "GRÖSSE")]), 10)] == [0, 1, 1]


def test_empty_tables(make, items_of):
    one, none = make([(1, "a b c")]), make([])
    assert found(one, items_of([]), 3) == [(3, 0, [], 0)]
    assert found(none, items_of([(1, "a b c")]), 3) == []
    assert decontaminated(one, items_of([])).collect() == one.collect()


def test_spans_are_cut_and_covered_documents_go(make, items_of):
    item = "the quick brown fox jumps over the lazy dog today"
    prose = "some words that nobody has ever put into any test at all"
    docs = make(
        [
            (1, f"{prose}. THE quick, brown fox jumps over the lazy dog today! {prose}"),
            (2, item),
            (3, prose),
            (4, None),
            (5, "naïve 中文. " + item + " " + item + " 😀 " + prose * 3),
        ]
    )
    left = {r.doc_id: r for r in decontaminated(docs, items_of([(1, item)]), window=10).collect()}
    assert left[1].text == f"{prose}. ! {prose}"
    assert sorted(left) == [1, 3, 4, 5]
    assert left[3].text == prose and left[4].text is None and left[1].score == "y"
    # Both copies and the blank between them are one stretch.
    assert left[5].text == "naïve 中文.  😀 " + prose * 3


def test_spans_are_bytes_of_the_text(make, items_of):
    docs = make([(1, "ééé a b c ééé a b c, a b"), (2, "x")])
    row = match_documents(docs, item_automata(items_of([(1, "a b c")])), 10).where("doc_id = 1").first()
    raw = "ééé a b c ééé a b c, a b".encode()
    assert [raw[s.begin : s.end] for s in row.spans] == [b"a b c", b"a b c"]


def test_a_passage_of_very_many_items(make, items_of):
    passage = " ".join(f"w{i}" for i in range(40))
    items = items_of([(n, f"{passage} own{n}") for n in range(300)])
    docs = make([(n, passage) for n in range(20)])
    rows = match_documents(docs, item_automata(items)).collect()
    assert {(r.n_hit, len(r["items"])) for r in rows} == {(40, 300)}
