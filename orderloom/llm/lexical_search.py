"""Ranked lexical search of whole items by the Best Position Algorithm.

1. One pass over the documents takes the terms of every whole text and keeps, per document,
   its number of terms and the counts of the terms that the items hold. The table is stored.
2. The number of documents and terms and the document frequency of each item term are
   aggregated from it. With them every count becomes an integer impact.
3. Tasks read the stored rows in shards of bounded size. In a shard each term has a list of
   its documents by falling impact. An item reads its lists side by side; every document
   that shows up is scored at once by direct access to all its lists, and its place in each
   of them counts as seen. The best position of a list is the end of the stretch, from the
   top, that has been seen entirely. No unseen document can score more than the sum of the
   impacts at the best positions, so reading stops when this sum is strictly below the
   score of the k-th document found so far in the task, and ties with it are all found.
4. Each task returns its k best documents per item; a window in two steps, first over groups
   of tasks, picks the k best of all.

Items come to the driver in blocks of bounded size, each searched in a pass of its own.
Documents are never compared with each other and no text is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import prepare, read_table, stored, strings, text_of

BEST = 50
#: Characters of items that are searched in one pass.
ITEM_BLOCK = 2_000_000
#: A shard has so many documents at most, and so many places in its table of positions.
SHARD_ROWS, SHARD_CELLS = 16_384, 1 << 25
#: Rows that the first round of an item reads from each list; every further round doubles it.
FIRST_READ = 16
#: Groups of tasks whose results are merged before the last step.
GROUPS = 64
# Letters and digits stay, A to Z in lower case, and so do all bytes of other characters.
_TABLE = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).lower()


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a whole text in order, as UTF-8."""
    return (text or "").encode().translate(_TABLE).split()


def _item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[dict]:
    """Terms by item id, in blocks; rows of one id count as one item."""
    block, size = {}, 0
    rows = items.select(F.col(id_col).alias("item_id"), text_of(text_col).alias("text"))
    grouped = rows.groupBy("item_id").agg(F.concat_ws(" ", F.collect_list("text")).alias("text"))
    for row in grouped.toLocalIterator():
        block[row["item_id"]] = set(terms_of(row["text"]))
        size += len(row["text"])
        if size >= ITEM_BLOCK:
            yield block
            block, size = {}, 0
    if block:
        yield block


def _postings(docs: DataFrame, id_col: str, text_col: str, known: dict[bytes, int]) -> DataFrame:
    """Per document the number of its terms, and the item terms that it holds with their counts."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            count = []
            words = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
            sizes = []
            for text in strings(batch["text"]).to_pylist():
                terms = terms_of(text)
                count.append(len(terms))
                found = np.fromiter(map(known.get, terms, repeat(-1)), np.int64, len(terms))
                found, times = np.unique(found[found >= 0], return_counts=True)
                words[0].append(found)
                words[1].append(times)
                sizes.append(len(found))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(w).astype(np.int32))) for w in words]
            yield pa.record_batch(
                [batch["doc_id"], pa.array(count, pa.int64()), *lists], ["doc_id", "n_terms", "terms", "times"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_terms long, terms array<int>, times array<int>")


def weights(frequency: dict[int, int], documents: int) -> dict[int, int]:
    """Weight of each term, from the number of documents that hold it."""
    return {t: int(np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1)))) for t, df in frequency.items()}


class Shard:
    """Impact lists of some documents, with the place of every document in every list."""

    def __init__(self, postings: pa.Table, documents: int, total: int, vocabulary: int):
        ids = postings["doc_id"].combine_chunks()
        # In the order of ids, so that the row number decides ties; null ids come last.
        order = pc.array_sort_indices(ids, order="ascending", null_placement="at_end")
        postings = postings.take(order)
        self.ids = postings["doc_id"].combine_chunks()
        size = postings["n_terms"].to_numpy()
        terms, times = (postings[c].combine_chunks() for c in ("terms", "times"))
        row = np.repeat(np.arange(len(size)), np.asarray(terms.value_lengths()))
        term, tf = terms.flatten().to_numpy().astype(np.int64), times.flatten().to_numpy().astype(np.int64)
        m = 50 + (50 * size * documents) // max(total, 1)
        impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m[row])
        by_impact = np.lexsort((row, -impact, term))
        self.row, self.impact = row[by_impact], impact[by_impact]
        self.bounds = np.searchsorted(term[by_impact], np.arange(vocabulary + 1))
        # Place of a document in the list of a term, or -1.
        self.place = np.full((vocabulary, len(size)), -1, np.int16)
        self.place[term[by_impact], self.row] = np.arange(len(row)) - np.repeat(self.bounds[:-1], np.diff(self.bounds))

    def search(self, terms: np.ndarray, weight: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the k best documents, as far as they reach ``floor``; ties by row."""
        length = self.bounds[terms + 1] - self.bounds[terms]
        terms, weight, length = (a[length > 0] for a in (terms, weight, length))
        start = self.bounds[terms]
        seen = [np.zeros(n + 1, bool) for n in length]  # one unseen place behind the end
        best = np.zeros(len(terms), np.int64)
        known = np.zeros(len(self.ids), bool)
        rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, step = 0, FIRST_READ
        while depth < length.max(initial=0):
            read = [self.row[s + depth : s + min(n, depth + step)] for s, n in zip(start, length) if n > depth]
            depth, step = depth + step, step * 2
            found = np.unique(np.concatenate(read))
            found = found[~known[found]]
            known[found] = True
            score = np.zeros(len(found), np.int64)
            for i, term in enumerate(terms):
                place = self.place[term, found]
                there = place >= 0
                place = place[there]
                score[there] += weight[i] * self.impact[start[i] + place]
                seen[i][place] = True
                best[i] += np.argmin(seen[i][best[i] :])
            rows, scores = np.concatenate([rows, found]), np.concatenate([scores, score])
            top = np.lexsort((rows, -scores))[:k]
            rows, scores = rows[top], scores[top]
            # A list that has been seen to its end holds no unseen document.
            open_list = best < length
            bound = int((weight * self.impact[start + np.maximum(best - 1, 0)])[open_list].sum())
            if bound < max(floor, scores[-1] if len(scores) == k else 0):
                break
        good = scores >= max(floor, 1)
        return rows[good], scores[good]


def _shards(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    waiting, size = [], 0
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            part = batch.slice(low, rows)
            if size + part.num_rows > rows:
                yield pa.Table.from_batches(waiting)
                waiting, size = [], 0
            waiting.append(part)
            size += part.num_rows
    if waiting:
        yield pa.Table.from_batches(waiting)


def _search(postings: DataFrame, block: dict, known: dict[bytes, int], k: int, item_type: str) -> DataFrame:
    """The k best documents of each item and task."""
    total = postings.agg(
        F.count_if(F.col("n_terms") > 0).alias("documents"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("terms")
    ).first()
    frequency = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = weights({r["term"]: r["df"] for r in frequency.collect()}, total["documents"])
    items = []
    for item, words in block.items():
        terms = sorted(known[w] for w in words if weight.get(known[w], 0) > 0)
        items.append((item, np.array(terms, np.int64), np.array([weight[t] for t in terms], np.int64)))
    vocabulary, documents, terms = max(len(known), 1), total["documents"], total["terms"]
    shared = postings.sparkSession.sparkContext.broadcast(items)

    def run(batches):
        items = shared.value
        rows = max(1, min(SHARD_ROWS, SHARD_CELLS // vocabulary))
        found: list[list[tuple[int, object]]] = [[] for _ in items]
        for table in _shards(batches, rows):
            shard = Shard(table, documents, terms, vocabulary)
            for i, (_, own, weight) in enumerate(items):
                floor = found[i][-1][0] if len(found[i]) == k else 1
                at, score = shard.search(own, weight, k, floor)
                if len(at):
                    new = zip(score.tolist(), shard.ids.take(pa.array(at)).to_pylist())
                    found[i] = sorted([*found[i], *new], key=lambda f: (-f[0], f[1] is None, f[1]))[:k]
        for (item, _, _), best in zip(items, found):
            if best:
                columns = [[item] * len(best), [d for _, d in best], [s for s, _ in best]]
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    schema = f"item_id {item_type}, doc_id {postings.schema['doc_id'].dataType.simpleString()}, score long"
    out = to_arrow_schema(postings.sparkSession.createDataFrame([], schema).schema)
    return postings.select("doc_id", "n_terms", "terms", "times").mapInArrow(run, schema)


def _best_of(rows: DataFrame, k: int, *keys) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = BEST,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The ``k`` highest-scoring documents of each item: ``item_id, rank, doc_id, score``.

    Only scores above 0 count. Equal scores rank by ascending id, a null id last; documents
    with a repeated id each have a rank. Rows of one item id, null included, are one item
    with the terms of all. A null or empty text has no terms; an item without terms, or with
    terms that no document holds, has no rows. Empty tables give an empty result, other
    columns are ignored.
    """
    spark = prepare(docs.sparkSession)
    item_type = items.schema[item_col].dataType.simpleString()
    kind = docs.schema[id_col].dataType.simpleString()
    found = spark.createDataFrame([], f"item_id {item_type}, doc_id {kind}, score long, part int")
    for block in _item_blocks(items, item_col, item_text_col):
        known = {term: i for i, term in enumerate(sorted(set().union(*block.values())))}
        postings = stored(_postings(docs, id_col, text_col, known), "postings")
        best = _search(postings, block, known, k, item_type).withColumn("part", F.spark_partition_id() % GROUPS)
        found = found.unionByName(best)
    found = _best_of(found, k, "item_id", "part").select("item_id", "doc_id", "score")
    return _best_of(found, k, "item_id").select("item_id", "rank", "doc_id", "score")


def op12_ranked_search(spark, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

SQL = {
    "op12_ranked_search": f"""
    WITH texts AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
    total AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM texts),
    wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
    occurrences AS (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM texts),
    counted AS (SELECT r, doc_id, n, term, count(*) AS tf FROM occurrences
      WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
    weighed AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
      FROM counted, total GROUP BY term, n_docs),
    scored AS (SELECT item_id, r, doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // n_terms)))))::BIGINT AS score
      FROM wanted JOIN counted USING (term) JOIN weighed USING (term), total GROUP BY item_id, r, doc_id)
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
    FROM scored WHERE score > 0
    QUALIFY rank <= 50"""
}
