"""Exact and near duplicates against plain Python on small tables."""

import hashlib
import random
import re
from collections import Counter

import pytest

from orderloom.llm import components, exact_dedup, ngram_join


def _groups(rows):
    found = {}
    for doc_id, text in rows:
        found.setdefault(text or "", []).append(doc_id)
    return found


def _expected_exact(rows):
    want = Counter()
    for text, ids in _groups(rows).items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        kept_left = 1
        for i in sorted(ids, key=lambda x: (x is not None, x or 0)):
            kept = i == keep and kept_left > 0
            kept_left -= kept
            want[(i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest())] += 1
    return want


@pytest.mark.parametrize("block_chars", [1, 3, 1024])
def test_exact_duplicates_of_odd_rows(odd_docs, block_chars):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect() if r["text"] is None or len(r["text"]) < 100 or block_chars > 3]
    docs = odd_docs.filter("text is null or length(text) < 100 or {} > 3".format(block_chars))
    got = Counter(tuple(r) for r in exact_dedup.exact_duplicates(docs, block_chars=block_chars).collect())
    assert got == _expected_exact(rows)


def test_names_do_not_confuse_pairings(make_docs):
    texts = ["abcdef", "abcde", "abcdeg", "defabc", "abcabc", "abc", "abcabcabc", "abcdefabc", "abcdef"]
    rows = list(enumerate(texts))
    got = Counter(tuple(r) for r in exact_dedup.exact_duplicates(make_docs(rows), block_chars=1).collect())
    assert got == _expected_exact(rows)


def test_hot_blocks_are_salted_and_united(make_docs):
    rows = [(i, "same " * 500 if i % 3 == 0 else f"text {i}") for i in range(300)]
    got = Counter(tuple(r) for r in exact_dedup.exact_duplicates(make_docs(rows), block_chars=64).collect())
    assert got == _expected_exact(rows)


def test_drop_exact_keeps_one_row_and_all_columns(odd_docs):
    kept = exact_dedup.drop_exact_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    texts = [r["text"] or "" for r in kept.collect()]
    assert sorted(texts) == sorted({r["text"] or "" for r in odd_docs.collect()})


@pytest.mark.parametrize("run", [exact_dedup.exact_duplicates, exact_dedup.drop_exact_duplicates, ngram_join.near_duplicates, ngram_join.drop_near_duplicates])
def test_empty_tables(odd_docs, run):
    assert run(odd_docs.limit(0)).count() == 0


# ------------------------------------------------------------------------ near duplicates


def _shingles(text, width):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def _expected_near(rows, width, percent):
    sets = [_shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * same >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return Counter((d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows))


def _near_copies(seed=3):
    """Clusters of texts that differ in a few words, chains of edits, and texts that share a passage."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts = []
    for _ in range(6):
        base = [word() for _ in range(rng.randint(30, 80))]
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
            base = copy if rng.random() < 0.5 else base
    passage = " ".join(word() for _ in range(40))
    texts += [" ".join([passage, *(word() for _ in range(60))]) for _ in range(15)]
    return [(i * 7 % 200, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80), (1, 50)])
def test_near_duplicates_match_brute_force(make_docs, width, percent):
    rows = _near_copies()
    got = ngram_join.near_duplicates(make_docs(rows), width=width, percent=percent)
    assert Counter(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == _expected_near(rows, width, percent)


def test_links_inside_a_group_whose_head_is_not_linked(make_docs):
    # Two pairs with one prefix, of rare words that nobody else has: whichever text is the head, the other pair is not linked with it.
    passage = [f"rare{i}" for i in range(60)]
    endings = [[f"common{k}x{i}" for i in range(43)] for k in range(2)]
    rows = [(10 * k + j, " ".join(passage + end[3 * j : 3 * j + 40])) for k, end in enumerate(endings) for j in range(2)]
    rows += [(100 + i, " ".join(endings[0] + endings[1])) for i in range(20)]
    want = _expected_near(rows, 1, 90)
    assert {c for _, _, c in want} == {0, 10, 100}
    got = ngram_join.near_duplicates(make_docs(rows), width=1, percent=90)
    assert Counter(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == want


def test_near_duplicates_of_odd_rows(odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = ngram_join.near_duplicates(odd_docs)
    assert Counter(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == _expected_near(rows, 5, 80)


def test_drop_near_duplicates_keeps_one_of_each(make_docs):
    rows = _near_copies()
    docs = make_docs([*rows, rows[0], (None, None), (500, None), (501, "")])
    kept = ngram_join.drop_near_duplicates(docs, width=3, percent=80)
    assert kept.columns == docs.columns
    components_ = {c for _, n, c in _expected_near(rows, 3, 80) if n}
    ids = [r["doc_id"] for r in kept.filter("text <> ''").collect()]
    assert sorted(ids) == sorted(components_)
    assert kept.filter("coalesce(text, '') = ''").count() == 3


def test_words_are_split_across_slices(monkeypatch):
    text = " ".join(f"w{i}" for i in range(1000))
    whole = list(ngram_join.shingle_sets([text, "a b", ""], 3))
    monkeypatch.setattr(ngram_join, "_SLICE", 64)
    monkeypatch.setattr(ngram_join, "_WORDS_AT_ONCE", 50)
    assert [list(x) for x in ngram_join.shingle_sets([text, "a b", ""], 3)] == [list(x) for x in whole]


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200)]
    edges += [(rng.randint(300, 340), rng.randint(300, 340)) for _ in range(25)]
    edges += [(b, a) for a, b in edges[:10]]
    parent = {x: x for e in edges for x in e}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    got = {r["u"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for x in parent if root(x) != x}
