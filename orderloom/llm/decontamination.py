"""Benchmark decontamination by q-gram lemma filtering.

A document is contaminated by a benchmark item if some stretch of it aligns with a window
of the item (``window`` characters, or the whole item if it is shorter) in at most
``rate * window`` edits. Such a stretch shares at least ``window + 1 - q * (edits + 1)``
q-grams with the window, and they lie in a band of diagonals (text position minus item
position) no wider than the edits allow. So the shared q-grams are counted in overlapping
diagonal bands; a place where a band holds enough of them within a window's length is
verified by banded alignment. Everything else needs no alignment, and nothing is missed.

The documents are read once per block of the benchmark, in Arrow batches; a block holds
at most ``block_chars`` characters, so what the tasks are given is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import prepare, read_table, strings, text_of

Q = 8
WINDOW = 80
RATE = 0.08
BLOCK_CHARS = 2_000_000
_SLICE = 1 << 20
_TABLE_BITS = 20
#: Shared q-grams that are looked at together; beyond that, repetition is left out and a text is halved.
HITS_AT_ONCE = 2_000_000
#: Periods of repeated text, such as rules of dashes or dots, that are noticed.
PERIODS = range(1, 9)


def _case_table() -> np.ndarray:
    lowered = [chr(i).lower() for i in range(1 << 17)]
    return np.array([ord(c) if len(c) == 1 else i for i, c in enumerate(lowered)], np.uint32)


_LOWER = _case_table()
_WHITE = np.array([chr(i).isspace() for i in range(1 << 14)], bool)


def normalised(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points with one space for each run of white space, and their places."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    small = codes < len(_LOWER)
    codes = np.where(small, _LOWER[np.where(small, codes, 0)], codes)
    white = _WHITE[np.where(codes < len(_WHITE), codes, 1)]
    again = np.zeros(len(codes), bool)
    again[1:] = white[1:] & white[:-1]
    places = np.flatnonzero(~again)
    return np.where(white, np.uint32(32), codes)[places], places


def qgram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the q-gram at each position; q is a power of two."""
    h, width = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 1
    while width < q:
        h = (h[:-width] * np.uint64(0xC4CEB9FE1A85EC53)) ^ (h[width:] + (h[width:] >> np.uint64(29)))
        width *= 2
    return h * np.uint64(0xFF51AFD7ED558CCD)


def banded_distance(windows: np.ndarray, text: np.ndarray, starts: np.ndarray, slack: int) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of each window against the text from about ``starts``, and where it ends.

    The alignment may begin and end up to ``slack`` diagonals away from the start's own.
    Rows run over the window, columns over the band's diagonals.
    """
    span = np.arange(-slack, slack + 1)
    padded = np.concatenate([np.full(slack + 1, 0xFFFFFFFF, np.uint32), text, np.full(windows.shape[1] + slack + 1, 0xFFFFFFFF, np.uint32)])
    cost = np.zeros((len(windows), len(span)), np.int32)
    for row in range(windows.shape[1]):
        at = np.clip(starts[:, None] + row + span[None], -slack - 1, len(text) + slack) + slack + 1
        kept = cost + (padded[at] != windows[:, row : row + 1])
        dropped = np.full_like(cost, 1 << 20)
        dropped[:, :-1] = cost[:, 1:] + 1
        best = np.minimum(kept, dropped)
        cost = np.minimum.accumulate(best - span, axis=1) + span
    last = cost.argmin(axis=1)
    return cost[np.arange(len(cost)), last], starts + windows.shape[1] + span[last]


class _TooMany(Exception):
    """A stretch of text has more shared q-grams than are looked at together."""


@dataclass
class _Item:
    codes: np.ndarray
    window: int
    edits: int
    needed: int


class Searcher:
    """Index of one block of benchmark texts."""

    def __init__(self, texts: list[str], q: int = Q, window: int = WINDOW, rate: float = RATE):
        self.q = q
        self.items: list[_Item] = []
        for text in texts:
            codes = normalised(text.strip())[0]
            own = min(window, len(codes))
            edits = int(rate * own)
            self.items.append(_Item(codes, own, edits, max(1, own + 1 - q * (edits + 1))))
        hashes, owners, places = [], [], []
        for i, item in enumerate(self.items):
            # Items of fewer than two q-grams would match ordinary text.
            if len(item.codes) >= 2 * q:
                own = qgram_hashes(item.codes, q)
                hashes.append(own)
                owners.append(np.full(len(own), i))
                places.append(np.arange(len(own)))
        flat = np.concatenate([np.empty(0, np.uint64), *hashes])
        order = np.argsort(flat, kind="stable")
        self.owner = np.concatenate([np.empty(0, np.int64), *owners])[order]
        self.place = np.concatenate([np.empty(0, np.int64), *places])[order]
        self.grams, self.first, self.uses = np.unique(flat[order], return_index=True, return_counts=True)
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[self.grams >> np.uint64(64 - _TABLE_BITS)] = True
        self.reach = max([i.window + i.edits for i in self.items], default=0)
        self.band = max([i.edits for i in self.items], default=0) + 1
        self.needed = np.array([i.needed for i in self.items], np.int64)
        self.spread = np.array([i.window + i.edits - q for i in self.items], np.int64)

    def _repeated(self, hashes: np.ndarray) -> np.ndarray:
        """Positions deep inside a periodic stretch.

        All that can align near them aligns alike near the stretch's begin, a whole number of
        periods before, so they tell nothing new.
        """
        deep = np.zeros(len(hashes), bool)
        margin = 2 * self.reach
        for period in PERIODS:
            alike = np.zeros(len(hashes) + 1, np.int8)
            alike[period:-1] = hashes[period:] == hashes[:-period]
            edges = np.diff(alike, prepend=0)
            for low, high in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)):
                if high - low > 2 * margin:
                    deep[low + margin : high - margin] = True
        return deep

    def _hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text position, item and item position of every shared q-gram."""
        hashes = qgram_hashes(codes, self.q)
        at = np.flatnonzero(self.table[hashes >> np.uint64(64 - _TABLE_BITS)])
        gram = np.searchsorted(self.grams, hashes[at])
        gram = np.minimum(gram, len(self.grams) - 1)
        same = self.grams[gram] == hashes[at]
        at, gram = at[same], gram[same]
        uses = self.uses[gram]
        if uses.sum() > HITS_AT_ONCE:
            told = ~self._repeated(hashes)[at]
            at, gram, uses = at[told], gram[told], uses[told]
            if uses.sum() > HITS_AT_ONCE and len(codes) > 8 * self.reach:
                raise _TooMany
        nth = np.arange(uses.sum()) - np.repeat(np.cumsum(uses) - uses, uses)
        entry = np.repeat(self.first[gram], uses) + nth
        return np.repeat(at, uses), self.owner[entry], self.place[entry]

    def _places(self, codes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, first text position, its item position) of bands with enough q-grams."""
        at, owner, place = self._hits(codes)
        # An item whose q-grams are too few in the whole text needs no bands.
        enough = np.bincount(owner, minlength=len(self.items)) >= self.needed
        some = enough[owner]
        at, owner, place = at[some], owner[some], place[some]
        if not len(at):
            return
        band = (at - place) // self.band
        # Bands are two steps wide and overlap by one, so any run of diagonals as wide as a step lies in one.
        at, owner, place = (np.concatenate([x, x]) for x in (at, owner, place))
        band = np.concatenate([band, band - 1])
        order = np.lexsort((at, band, owner))
        at, owner, place, band = at[order], owner[order], place[order], band[order]
        last = np.arange(len(at)) + self.needed[owner] - 1
        inside = last < len(at)
        last = np.minimum(last, len(at) - 1)
        full = inside & (owner[last] == owner) & (band[last] == band) & (at[last] - at <= self.spread[owner])
        for i in np.flatnonzero(full):
            yield int(owner[i]), int(at[i]), int(place[i])

    def _verified(self, item: _Item, codes: np.ndarray, places: list[tuple[int, int]]) -> tuple[int, int, int] | None:
        """(edits, start, end) of a window of the item in the text, near one of the places."""
        w = item.window
        for at, place in places:  # a whole window without edits
            if place + w <= len(item.codes) and np.array_equal(codes[at : at + w], item.codes[place : place + w]):
                low, high = 0, w  # the whole stretch that equals the item
                while low < min(at, place) and codes[at - low - 1] == item.codes[place - low - 1]:
                    low += 1
                while high < min(len(codes) - at, len(item.codes) - place) and codes[at + high] == item.codes[place + high]:
                    high += 1
                return 0, at - low, at + high
        best = None
        slack = 2 * self.band + item.edits
        tried: set[tuple[int, int]] = set()
        for at, place in places:
            # Windows that contain the place's q-gram and begin at most as far before it as edits can hide.
            low = max(0, place - self.q * item.edits - self.q)
            high = min(len(item.codes) - w, place)
            begins = [b for b in range(min(low, high), high + 1) if (b, (at - place) // self.band) not in tried]
            tried.update((b, (at - place) // self.band) for b in begins)
            for some in range(0, len(begins), 64):
                part = np.array(begins[some : some + 64])
                windows = item.codes[part[:, None] + np.arange(w)[None]]
                cost, end = banded_distance(windows, codes, part + at - place, slack)
                k = int(cost.argmin())
                if cost[k] <= item.edits and (best is None or cost[k] < best[0]):
                    best = int(cost[k]), int(max(0, part[k] + at - place)), int(min(len(codes), end[k]))
            if best:
                return best
        return best

    def matches(self, text: str) -> dict[int, tuple[int, int, int]]:
        """For each item found in the text: edits, and start and end of the stretch in it."""
        found: dict[int, tuple[int, int, int]] = {}
        if not len(self.grams):
            return found
        codes, origin = normalised(text)
        stretches = [(start, start + _SLICE) for start in range(0, max(1, len(codes)), _SLICE)][::-1]
        while stretches:
            start, end = stretches.pop()
            part = codes[start : end + 2 * self.reach]
            if len(part) < self.q:
                continue
            by_item: dict[int, list[tuple[int, int]]] = {}
            try:
                for item, at, place in self._places(part):
                    by_item.setdefault(item, []).append((at, place))
            except _TooMany:
                middle = start + len(part) // 2
                stretches += [(middle, end), (start, middle)]
                continue
            for item, places in by_item.items():
                # Found with edits, an item may still stand without edits in a later stretch.
                if item in found and not found[item][0]:
                    continue
                hit = self._verified(self.items[item], part, places)
                if hit and (item not in found or not hit[0]):
                    edits, low, high = hit
                    found[item] = edits, int(origin[start + low]), int(origin[start + high - 1]) + 1
        return found


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts of the benchmark, in blocks of about ``block_chars`` characters."""
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-total // block_chars)
    for k in range(count):
        rows = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == k).toArrow()
        yield rows["id"].combine_chunks(), rows["text"].to_pylist()


def _parameters(q: int) -> int:
    if q < 1 or q & (q - 1):
        raise ValueError("q must be a power of two")
    return q


def contaminations(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    q: int = Q,
    window: int = WINDOW,
    rate: float = RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document and benchmark item in it: ``doc_id, item_id, edits, start, end``.

    ``start`` and ``end`` are positions in the text as given, of a stretch that aligns with a
    window of the item; without edits it is the whole stretch that equals the item. Texts are compared in lower
    case with runs of white space as one space. Null and empty texts on either side match
    nothing, nor do items of fewer than two q-grams' length. Repeated rows and rows without
    an id give a row each; items with equal texts are all reported. Empty tables give an
    empty result; other columns are ignored.
    """
    spark = prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("_text"))
    item_type = benchmark.schema[item_col].dataType
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_type.simpleString()}, edits long, start long, end long"
    result = spark.createDataFrame([], schema)
    for ids, texts in _blocks(benchmark, item_col, "text", block_chars):
        shared = spark.sparkContext.broadcast((ids, Searcher(texts, _parameters(q), window, rate)))

        def search(batches, shared=shared):
            item_ids, searcher = shared.value
            for batch in batches:
                at, items, spans = [], [], []
                for row, text in enumerate(strings(batch["_text"]).to_pylist()):
                    for item, span in searcher.matches(text).items():
                        at.append(row)
                        items.append(item)
                        spans.append(span)
                columns = {"doc_id": batch["doc_id"].take(pa.array(at, pa.int64())), "item_id": item_ids.take(pa.array(items, pa.int64()))}
                for k, name in enumerate(("edits", "start", "end")):
                    columns[name] = pa.array([s[k] for s in spans], pa.int64())
                if at:
                    yield pa.record_batch(columns)

        result = result.unionByName(rows.mapInArrow(search, schema))
    return result


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item, with all their columns."""
    spark = prepare(docs.sparkSession)
    block_chars = settings.pop("block_chars", BLOCK_CHARS)
    for _, texts in _blocks(benchmark, settings.pop("item_col", "item_id"), "text", block_chars):
        shared = spark.sparkContext.broadcast(Searcher(texts, **settings))

        def keep(batches, shared=shared):
            for batch in batches:
                hit = [bool(shared.value.matches(t)) for t in strings(batch[text_col]).to_pylist()]
                yield batch.filter(pa.array([not h for h in hit], pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminations(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
