"""Removal of passages that an earlier document has, by pairwise alignment of lines.

1. Every line gets a hash. Documents that share a rare line (in at most ``RARE`` documents)
   are paired, every later one with every earlier one. Passages without a rare line have
   another way, so that nothing is capped: a document is paired with the earliest one that
   has the same run of lines, for each shortest run of common lines that is long enough to
   be deleted. Which lines are common is known to the tasks as a bit map of fixed size; a
   rare line that looks common only adds a run. Pairs are linear in the number of lines.
2. Each pair is aligned with patience diff over line hashes: lines that are unique in both
   documents and in the same order are anchors, and blocks grow from them over equal
   neighbours; passages that were moved are found from the anchors left over. Only line
   hashes travel, in Arrow batches of pairs.
3. Blocks of at least ``min_words`` words are deleted from the later document. The earliest
   holder of a passage keeps it, since a line is only deleted for an earlier document.

Documents are ordered by id (null first), then by text hash. Equal lines of a hot passage
are first counted per task; the join that hands the earliest holder back, and the one that
fetches its lines, are splittable. Text stays where it is read: only documents that may
lose a line, by a bit map of fixed size, are shuffled to meet their deletions.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import BitMap, bit_map, prepare, read_table, stored, text_of, unused_name

MIN_WORDS = 20
LINE_WORDS = 4
RARE = 16
#: What ``\s`` matches, which words are split at.
SPACE = " \t\n\x0b\f\r"


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per distinct document: id, text hash, and for each line its hash and words."""
    text = text_of(text_col)
    words = lambda line: F.size(F.filter(F.split(line, r"\s+"), lambda w: w != ""))
    line = lambda s: F.struct(F.xxhash64(F.trim(s, F.lit(SPACE))).alias("hash"), words(s).alias("words"))
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_text_hash"), F.transform(F.split(text, "\n"), line).alias("_lines"))
    return rows.groupBy("_id", "_text_hash").agg(F.first("_lines").alias("_lines"))


def _order(prefix: str = ""):
    """Sorts documents: rows without an id first, then by id and text hash."""
    return F.struct(F.col(f"{prefix}_id").isNotNull().alias("known"), F.col(f"{prefix}_id").alias("id"), F.col(f"{prefix}_text_hash").alias("hash"))


def shortest_runs(words: np.ndarray, min_words: int) -> set[tuple[int, int]]:
    """(start, end) of the runs with at least ``min_words`` words that lose them without their last or first line."""
    total = np.concatenate([[0], np.cumsum(words)])
    starts = np.arange(len(words))
    ends = np.searchsorted(total, total[:-1] + min_words, side="left")
    fit = ends <= len(words)
    runs = set(zip(starts[fit].tolist(), ends[fit].tolist()))
    lows = np.searchsorted(total, total[1:] - min_words, side="right") - 1
    fit = lows >= 0
    return runs | set(zip(lows[fit].tolist(), (starts[fit] + 1).tolist()))


def _runs(lines: DataFrame, common: BitMap, line_words: int, min_words: int) -> DataFrame:
    """``_doc, _hash`` of each distinct shortest run without a rare line that is long enough."""
    shared = lines.sparkSession.sparkContext.broadcast(common)

    def read(batches):
        for batch in batches:
            docs, found = [], []
            for doc, hashes, words in zip(batch["_doc"].to_pylist(), batch["hashes"], batch["words"]):
                own, words = hashes.values.to_numpy(), words.values.to_numpy()
                rare = (words >= line_words) & ~shared.value.holds(own.view(np.uint64))
                before = np.concatenate([[0], np.cumsum(rare)])
                runs = (r for r in shortest_runs(words, min_words) if before[r[0]] == before[r[1]])
                keys = {xxhash.xxh3_64_intdigest(own[a:b].tobytes()) for a, b in runs}
                docs += [doc] * len(keys)
                found += keys
            yield pa.record_batch({"_doc": pa.array(docs, pa.int64()), "_hash": pa.array(np.array(found, np.uint64).view(np.int64))})

    own = lines.select("_doc", F.col("_lines.hash").alias("hashes"), F.col("_lines.words").alias("words"))
    return own.mapInArrow(read, "_doc long, _hash long")


def _pairs(lines: DataFrame, line_words: int, min_words: int) -> DataFrame:
    """Distinct pairs (later, earlier) of document numbers."""
    held = lines.select("_doc", F.explode("_lines").alias("_line")).filter(F.col("_line.words") >= line_words)
    held = held.select("_doc", F.col("_line.hash").alias("_hash")).distinct()
    uses = stored(held.groupBy("_hash").agg(F.count("*").alias("_uses")).filter("_uses > 1"), "line-uses")
    # At most RARE documents are collected for a line.
    rare = held.join(uses.filter(F.col("_uses") <= RARE).select("_hash"), "_hash")
    holders = rare.groupBy("_hash").agg(F.sort_array(F.collect_list("_doc")).alias("_docs")).select("_docs").distinct()
    earlier = lambda doc, at: F.transform(F.slice("_docs", 1, at), lambda e: F.struct(doc.alias("later"), e.alias("earlier")))
    pairs = holders.select(F.inline(F.flatten(F.transform("_docs", earlier))))
    common = bit_map(uses.filter(F.col("_uses") > RARE).select("_hash"))
    runs = _runs(lines, common, line_words, min_words)
    first = runs.groupBy("_hash").agg(F.min("_doc").alias("earlier"), F.count("*").alias("_uses")).filter("_uses > 1")
    repeated = runs.join(first, "_hash").filter("earlier < _doc").select(F.col("_doc").alias("later"), "earlier")
    return pairs.union(repeated).distinct()


def _increasing(values: np.ndarray) -> list[int]:
    """Positions of a longest increasing subsequence."""
    tails: list[int] = []
    at: list[int] = []
    back = np.full(len(values), -1, np.int64)
    for i, v in enumerate(values.tolist()):
        k = bisect_left(tails, v)
        back[i] = at[k - 1] if k else -1
        if k == len(tails):
            tails.append(v)
            at.append(i)
        else:
            tails[k], at[k] = v, i
    found = []
    i = at[-1] if at else -1
    while i >= 0:
        found.append(i)
        i = int(back[i])
    return found[::-1]


def _longest_ends(a: np.ndarray, b: np.ndarray, used: np.ndarray) -> list[tuple[int, int, int]]:
    """(place in a, place in b, length) of the longest common run that ends at each unused line of a; the longest first, in b the first."""
    order = np.argsort(b, kind="stable")
    low, high = np.searchsorted(b[order], a, side="left"), np.searchsorted(b[order], a, side="right")
    found = []
    # Lengths of the runs that end at each place of b, in one array per row; entries of other rows are set back.
    before, now = np.zeros(len(b) + 1, np.int64), np.zeros(len(b) + 1, np.int64)
    filled = order[:0]
    for x in np.flatnonzero(~used & (high > low)).tolist():
        if not found or found[-1][0] != x - 1:
            before[filled + 1] = 0
            filled = order[:0]
        places = order[low[x] : high[x]]
        lengths = before[places] + 1
        now[places + 1] = lengths
        before[filled + 1] = 0
        before, now, filled = now, before, places
        best = int(lengths.argmax())
        found.append((x, int(places[best]), int(lengths[best])))
    return sorted(found, key=lambda e: (-e[2], e[0]))


def patience_blocks(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int]]:
    """Common blocks (start in a, start in b, length) by their start in a, without overlap in a.

    Anchors that keep their order come first. Lines of a that are left over and that b has
    too are passages that were moved or repeated; they get blocks of their own, the longest
    first, over all the line's places in b.
    """
    once_a, at_a, n_a = np.unique(a, return_index=True, return_counts=True)
    once_b, at_b, n_b = np.unique(b, return_index=True, return_counts=True)
    _, i, j = np.intersect1d(once_a[n_a == 1], once_b[n_b == 1], assume_unique=True, return_indices=True)
    anchors = np.stack([at_a[n_a == 1][i], at_b[n_b == 1][j]], axis=1)
    anchors = anchors[np.argsort(anchors[:, 0])]
    ordered = [tuple(p) for p in anchors[_increasing(anchors[:, 1])].tolist()]
    used = np.zeros(len(a), bool)
    blocks: list[tuple[int, int, int]] = []
    for x, y in ordered:
        if used[x]:
            continue
        low = 0
        while x > low and y > low and a[x - low - 1] == b[y - low - 1] and not used[x - low - 1]:
            low += 1
        high = 1
        while x + high < len(a) and y + high < len(b) and a[x + high] == b[y + high] and not used[x + high]:
            high += 1
        used[x - low : x + high] = True
        blocks.append((x - low, y - low, low + high))
    for x, y, length in _longest_ends(a, b, used):
        low = 0
        while low < length and not used[x - low]:
            low += 1
        if low:
            used[x - low + 1 : x + 1] = True
            blocks.append((x - low + 1, y - low + 1, low))
    return sorted(blocks)


def _aligned(pairs: DataFrame, lines: DataFrame, min_words: int) -> DataFrame:
    """``later, line``: lines (from 0) of the later document that lie in a long enough common block."""
    own = lines.select("_doc", F.col("_lines.hash").alias("hashes"), F.col("_lines.words").alias("words"))
    later = own.select(F.col("_doc").alias("later"), F.col("hashes").alias("a"), "words")
    earlier = own.select(F.col("_doc").alias("earlier"), F.col("hashes").alias("b"))

    def align(batches):
        for batch in batches:
            docs, found = [], []
            columns = [batch[c] for c in ("later", "a", "b", "words")]
            for doc, a, b, words in zip(columns[0].to_pylist(), *columns[1:]):
                words = words.values.to_numpy()
                for start, _, length in patience_blocks(a.values.to_numpy(), b.values.to_numpy()):
                    if words[start : start + length].sum() >= min_words:
                        docs += [doc] * length
                        found += range(start, start + length)
            yield pa.record_batch({"later": pa.array(docs, pa.int64()), "line": pa.array(found, pa.int32())})

    both = pairs.join(earlier, "earlier").join(later, "later").select("later", "a", "b", "words")
    return both.mapInArrow(align, "later long, line int")


def remove_repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, line_words: int = LINE_WORDS
) -> DataFrame:
    """The rows with the text without repeated passages, and ``n_lines, removed_lines``.

    ``removed_lines`` lists the deleted lines, counted from 0, in order. Lines are compared
    without white space at their ends. A null text stays null and has one line, as an empty
    one. Rows with the same id and text count as one document, so repeated rows are treated
    alike; rows that share an id but not the text are told apart. An empty table gives an
    empty result. Columns named ``n_lines`` or ``removed_lines`` are replaced.
    """
    prepare(docs.sparkSession)
    lines = stored(_lines(docs, id_col, text_col), "lines")
    # Numbers in the order of the documents: a sorted, stored table, so they are fixed.
    keys = lines.select("_id", "_text_hash").orderBy(_order())
    numbers = stored(keys.withColumn("_doc", F.monotonically_increasing_id()), "document-numbers")
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"n.{c}")) for c in ("_id", "_text_hash")]
    numbered = stored(lines.alias("l").join(numbers.alias("n"), on).select("n._doc", "l._lines"), "numbered-lines")
    pairs = stored(_pairs(numbered, line_words, min_words), "line-pairs")
    gone = _aligned(pairs, numbered, min_words).groupBy("later").agg(F.sort_array(F.collect_set("line")).alias("removed_lines"))
    gone = stored(gone.join(numbers, F.col("later") == F.col("_doc")).select("_id", "_text_hash", "removed_lines"), "removed")
    key = unused_name(docs, "_text_hash")
    rows = docs.drop("n_lines", "removed_lines").withColumn(key, F.xxhash64(text_of(text_col)))
    bits = docs.sparkSession.sparkContext.broadcast(bit_map(gone.select(F.xxhash64("_id", "_text_hash"))))

    @F.arrow_udf("boolean")
    def may_lose(hashes: pa.Array) -> pa.Array:
        return pa.array(bits.value.holds(hashes.to_numpy().view(np.uint64)))

    touched = may_lose(F.xxhash64(id_col, key))
    on = F.col(f"d.{id_col}").eqNullSafe(F.col("g._id")) & (F.col(f"d.{key}") == F.col("g._text_hash"))
    joined = rows.filter(touched).alias("d").join(gone.alias("g"), on, "left")
    parts = F.split(text_of(text_col), "\n")
    kept = F.filter(parts, lambda _, i: ~F.array_contains("g.removed_lines", i))
    own = [c for c in docs.columns if c not in ("n_lines", "removed_lines")]
    cleaned = F.when(F.col("g.removed_lines").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    none = F.array().cast("array<int>")
    n_lines = F.size(parts).cast("long").alias("n_lines")
    changed = joined.select(
        *[cleaned.alias(c) if c == text_col else F.col(f"d.`{c}`") for c in own],
        n_lines,
        F.coalesce("g.removed_lines", none).alias("removed_lines"),
    )
    same = rows.filter(~touched).select(*[F.col(f"`{c}`") for c in own], n_lines, none.alias("removed_lines"))
    return same.unionByName(changed)


def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    found = remove_repeated_passages(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "removed_lines", "text")
