"""Decontamination against all alignments, and line dedup against all pairs of documents."""

import random
from collections import defaultdict

import numpy as np
import pytest

from orderloom.llm import decontamination, line_dedup

Q, W, RATE = 4, 20, 0.1


def _least_edits(pattern, text):
    """Fewest edits of the whole pattern against any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def _expected(docs, items):
    def plain(t):
        return " ".join((t or "").lower().split())

    found = set()
    for d, text in docs:
        for k, item in items:
            own = plain(item)
            if len(own) < 2 * Q:
                continue
            w = min(W, len(own))
            windows = {own[i : i + w] for i in range(len(own) - w + 1)}
            if any(_least_edits(x, plain(text)) <= int(RATE * w) for x in windows):
                found.add((d, k))
    return found


def _cases(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcde ") for _ in range(n)).strip()

    def edited(part, edits):
        part = list(part)
        for _ in range(edits):
            i = rng.randrange(len(part))
            part[i : i + 1] = rng.choice([[], ["x"], [part[i], "y"]])
        return "".join(part)

    items = [(k, text(n)) for k, n in enumerate((60, 45, 20, 12, 5))] + [(7, None), (8, ""), (9, "Same  Item of the BENCHMARK here"), (10, "same item of the benchmark here")]
    docs = []
    for i in range(40):
        k = rng.randrange(4)
        own = items[k][1]
        start = rng.randrange(max(1, len(own) - W))
        part = edited(own[start : start + rng.choice([12, 18, W, W + 6])], rng.randint(0, 4))
        docs.append((i, f"{text(30)} {part} {text(30)}"))
    docs += [(50, None), (51, ""), (52, "x SAME item\nof  the benchmark here y"), (52, "x SAME item\nof  the benchmark here y"), (None, items[0][1])]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_contaminations_match_all_alignments(spark, make_docs, seed):
    docs, items = _cases(seed)
    table = spark.createDataFrame(items, "item_id long, text string")
    want = _expected(docs, items)
    for block_chars in (10_000, 60):
        got = decontamination.contaminations(make_docs(docs), table, q=Q, window=W, rate=RATE, block_chars=block_chars)
        assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want
    clean = decontamination.clean_documents(make_docs(docs), table, q=Q, window=W, rate=RATE)
    assert clean.columns == make_docs(docs).columns
    hit = {d for d, _ in want}
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(d for d, _ in docs if d not in hit)


def test_contaminations_of_odd_and_empty_tables(spark, odd_docs):
    table = spark.createDataFrame([(1, "some benchmark item of a certain length")], "item_id int, text string")
    assert decontamination.contaminations(odd_docs, table).count() == 0
    assert decontamination.clean_documents(odd_docs, table).count() == odd_docs.count()
    assert decontamination.contaminations(odd_docs.limit(0), table).count() == 0
    assert decontamination.contaminations(odd_docs, table.limit(0)).count() == 0
    assert decontamination.clean_documents(odd_docs, table.limit(0)).count() == odd_docs.count()
    with pytest.raises(ValueError):
        decontamination.contaminations(odd_docs, table, q=6)


def test_stretches_are_given_in_the_text_as_it_is():
    searcher = decontamination.Searcher(["the quick brown fox jumps over the lazy dog and runs away"])
    text = "Start. The  QUICK brown\nfox jumps over the lazy dog and runs away. End."
    edits, low, high = searcher.matches(text)[0]
    assert edits == 0 and text[low:high] == "The  QUICK brown\nfox jumps over the lazy dog and runs away"


def test_an_exact_stretch_is_given_whole():
    item = " ".join(f"word{i}" for i in range(30))
    text = f"before it. {item[20:]} And after"
    edits, low, high = decontamination.Searcher([item]).matches(text)[0]
    assert edits == 0 and text[low:high].strip() == item[20:].strip()


def test_a_match_across_slices(monkeypatch):
    monkeypatch.setattr(decontamination, "_SLICE", 150)
    item = " ".join(f"word{i}" for i in range(40))
    searcher = decontamination.Searcher([item])
    for offset in range(0, 300, 17):
        assert 0 in searcher.matches("z" * offset + " " + item + " tail")


# ------------------------------------------------------------------------- line dedup


def _line_docs(seed=4):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    line = lambda n: " ".join(word() for _ in range(n))
    passages = [[line(12), line(9), line(15)] for _ in range(5)] + [[line(60)], [line(6)]]
    docs = []
    for i in range(60):
        lines = [line(8) for _ in range(rng.randint(1, 4))]
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(lines) + 1)
            lines[at:at] = rng.choice(passages)
        docs.append((i, "\n".join(lines)))
    return docs


def _expected_lines(docs):
    """Lines that an alignment with any earlier document deletes."""
    gone = defaultdict(set)
    split = [(d, [x.strip() for x in t.split("\n")]) for d, t in docs]
    for k, (later, a) in enumerate(split):
        for _, b in split[:k]:
            code = {x: i for i, x in enumerate(dict.fromkeys(a + b))}
            for start, _, n in line_dedup.patience_blocks(np.array([code[x] for x in a]), np.array([code[x] for x in b])):
                if sum(len(x.split()) for x in a[start : start + n]) >= line_dedup.MIN_WORDS:
                    gone[later].update(range(start, start + n))
    return gone


@pytest.mark.parametrize("rare", [0, 16])
def test_line_dedup_matches_all_pairs(make_docs, monkeypatch, rare):
    monkeypatch.setattr(line_dedup, "RARE", rare)
    docs = _line_docs()
    want = _expected_lines(docs)
    texts = dict(docs)
    for r in line_dedup.remove_repeated_passages(make_docs(docs)).collect():
        lines = texts[r["doc_id"]].split("\n")
        assert r["n_lines"] == len(lines)
        assert r["removed_lines"] == sorted(want[r["doc_id"]])
        assert r["text"] == "\n".join(x for i, x in enumerate(lines) if i not in want[r["doc_id"]])


def test_line_dedup_of_copies_and_odd_rows(make_docs, odd_docs):
    long = " ".join(f"word{i}" for i in range(30))
    docs = make_docs([(3, long), (1, long), (2, f"{long}\nown line of this text"), (4, "short\nshort"), (2, None), (None, long)])
    found = {(r["doc_id"], r["n_lines"]): (r["text"], r["removed_lines"]) for r in line_dedup.remove_repeated_passages(docs).collect()}
    assert found[(None, 1)] == (long, [])  # no id sorts first
    assert found[(1, 1)] == found[(3, 1)] == ("", [0])
    assert found[(2, 2)] == ("own line of this text", [0])
    assert found[(2, 1)] == (None, [])
    got = line_dedup.remove_repeated_passages(odd_docs)
    assert got.columns == [*odd_docs.columns, "n_lines", "removed_lines"]
    assert sorted(map(str, [r["text"] for r in got.collect()])) == sorted(map(str, [r["text"] for r in odd_docs.collect()]))
    assert line_dedup.remove_repeated_passages(odd_docs.limit(0)).count() == 0


def test_lines_are_compared_without_any_white_space_at_their_ends(make_docs):
    lines = [f"line {k} of a passage that both texts have" for k in range(6)]
    docs = [(1, "\n".join(lines)), (2, "\r\n".join([*lines, "own"])), (3, "\n".join(f"\t{x} \t" for x in [*lines, "other"]))]
    found = {r["doc_id"]: list(r["removed_lines"]) for r in line_dedup.remove_repeated_passages(make_docs(docs)).collect()}
    assert found == {1: [], 2: list(range(6)), 3: list(range(6))}


def test_left_over_lines_are_tried_at_every_place():
    # No line is unique in b, and each stands alone in b before the passage does.
    b = np.array([1, 90, 2, 91, 3, 92, 1, 2, 3, 93, 1, 2, 3])
    assert line_dedup.patience_blocks(np.array([1, 2, 3]), b) == [(0, 6, 3)]
    assert line_dedup.patience_blocks(np.array([7, 1, 2, 3, 8, 1, 2, 3, 91]), b) == [(1, 6, 3), (5, 6, 3), (8, 3, 1)]


def test_patience_blocks():
    a, b = np.array([1, 2, 3, 9, 4, 5, 7, 7]), np.array([8, 1, 2, 3, 6, 4, 5, 7, 7])
    assert line_dedup.patience_blocks(a, b) == [(0, 1, 3), (4, 5, 4)]
    assert line_dedup.patience_blocks(np.array([1, 2]), np.array([2, 1])) == [(0, 1, 1), (1, 0, 1)]
    assert line_dedup.patience_blocks(np.array([5, 5]), np.array([5, 5, 5])) == [(0, 0, 2)]


def test_rules_of_dashes_and_dots_are_searched_in_bounded_memory():
    words = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    searcher = decontamination.Searcher(["-" * 300, ". " * 150, words])

    def text(n):
        return "begin " + "-" * n + " middle " + ". " * n + words + " -=" * n

    short, long = searcher.matches(text(2000)), searcher.matches(text(200_000))
    assert set(short) == set(long) == {0, 1, 2}
    assert short[0] == long[0] and [short[k][0] for k in (0, 1, 2)] == [long[k][0] for k in (0, 1, 2)] == [0, 0, 0]


@pytest.mark.parametrize("seed", range(4))
def test_few_hits_at_once_find_the_same_items(monkeypatch, seed):
    rng = random.Random(seed)
    parts = ["-" * 200, "ab" * 120, "abc " * 60, "the quick brown fox jumps over the lazy dog and runs far away from here " * 2]
    searcher = decontamination.Searcher(["".join(rng.sample(parts, 2))[:150] for _ in range(4)], window=40)
    text = "".join(rng.choice([*parts, "something else in between ", "x"]) * rng.randint(1, 20) for _ in range(30))
    edited = list(text)
    for i in rng.sample(range(len(edited)), len(edited) // 40):
        edited[i] = rng.choice("abxyz")
    wanted = {k: v[0] == 0 for k, v in searcher.matches("".join(edited)).items()}
    monkeypatch.setattr(decontamination, "HITS_AT_ONCE", 500)
    assert {k: v[0] == 0 for k, v in searcher.matches("".join(edited)).items()} == wanted


def test_an_item_without_edits_behind_an_edited_one_is_told_whatever_lies_between():
    words = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    searcher = decontamination.Searcher([words])
    edited = words.replace("v", "w")
    for between in (100, decontamination._SLICE):
        text = edited + " " + "x" * between + " " + words
        assert searcher.matches(text) == {0: (0, text.index(words), len(text))}
    assert searcher.matches(edited + " " + "x" * decontamination._SLICE)[0][0] > 0
