"""Jaccard self-join of word shingle sets by a grouped prefix join.

1. Every text becomes the set of its distinct shingles (64-bit hashes, read in Arrow
   batches). Documents with the same set are one class; copies go no further.
2. Shingles are ordered by document frequency, rare ones first. Frequencies are counted
   over all documents in ``BUCKETS`` hash buckets, a table of fixed size that the tasks
   get. The order only has to be the same everywhere, so a shared bucket does no harm.
3. Two sets at or above the threshold share a shingle of their prefixes. Classes of equal
   size and prefix form a group, and only groups are indexed and paired.
4. Pairs of groups are expanded to members. A pair whose sizes, or whose counts of
   shingles by the top byte of the hash, rule out the threshold is left out; so is one
   whose first common shingle comes too late in either prefix. The others are verified on
   whole sets, which are read again for their members only.

Components are asked for, not all links, so pairs are formed in rounds and a pair whose
ends are already connected is not formed again: first each group with the pivots of its
two most frequent shingles, then with the pivots of all its shingles, then all remaining
pairs that share a shingle. The last round leaves out nothing but pairs inside a
component, so the result is exact; a group of thousands of near copies is united by the
pivots, in a number of pairs that is linear in its size. There is no cap on partners.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import session
from .common import prepare, read_table, slices, stored, strings, text_of, unused_name
from .components import components

#: Size of the frequency table that tasks get; fixed, whatever the input.
BUCKETS = 1 << 18
#: A table of ids of at most so many rows (16 bytes each) is broadcast, a larger one is shuffled.
BROADCAST_ROWS = 1_000_000
_WORDS_AT_ONCE = 200_000
#: Parity of the number of shingles for each top byte of the hash, 64 in each.
_ODD = ["odd0", "odd1", "odd2", "odd3"]
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_SLICE = 1 << 20


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The words of one lower-cased text, in slices that end at white space."""
    start = 0
    while start < len(text):
        end = start + _SLICE
        cut = _SPACE.search(text, end) if end < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[start:end].split()
        start = end


def _hashes(words: list[bytes]) -> np.ndarray:
    coded = pa.array(words, pa.binary()).dictionary_encode()
    distinct = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return distinct[coded.indices.to_numpy()] if words else np.empty(0, np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of a well-known 64-bit hash: every input bit changes every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _factors(n: int) -> np.ndarray:
    return _mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_sets(texts: list[str], width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text.

    Words are runs of bytes other than space and \\x09-\\x0D, with A-Z in lower case. A
    text of fewer words has one shingle, all its words; a text without words has none.
    """
    pending: list[bytes] = []
    hashed: list[np.ndarray] = []
    lengths = []
    for text in texts:
        n = 0
        for words in _words(text.encode("utf-8", "surrogatepass").lower()):
            pending += words
            n += len(words)
            if len(pending) >= _WORDS_AT_ONCE:
                hashed.append(_hashes(pending))
                pending = []
        lengths.append(n)
    hashed.append(_hashes(pending))
    words = np.concatenate(hashed)
    factors = _factors(width)
    rolled = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for j in range(width):
        rolled += words[j : j + len(rolled)] * factors[j]
    rolled = _mixed(rolled)
    start = 0
    for n in lengths:
        if n >= width:
            yield np.unique(rolled[start : start + n - width + 1])
        elif n:
            few = words[start : start + n] * _factors(n) + np.uint64(n)
            yield _mixed(few.sum(dtype=np.uint64, keepdims=True))
        else:
            yield np.empty(0, np.uint64)
        start += n


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _bucket(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(46)).astype(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = _signed(np.concatenate(arrays)) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in parts of bounded text, since words, shingles and outputs of a part are held at once."""
    for batch in batches:
        yield from slices(batch, pc.binary_length(batch["_text"]), _SLICE)


def _frequencies(texts: DataFrame, width: int) -> np.ndarray:
    """Document frequency by bucket, over all documents: ``BUCKETS`` numbers."""

    def count(batches):
        seen = np.zeros(BUCKETS, np.int64)
        for batch in _parts(batches):
            sets = list(shingle_sets(strings(batch["_text"]).to_pylist(), width))
            seen += np.bincount(_bucket(np.concatenate(sets)), minlength=BUCKETS) if sets else 0
        full = np.flatnonzero(seen)
        for i in range(0, len(full), 1 << 16):
            part = full[i : i + (1 << 16)]
            yield pa.record_batch({"bucket": part, "n": seen[part]})

    rows = texts.select("_text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    found = np.zeros(BUCKETS, np.int64)
    found[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return found


def _sets_of(batch: pa.RecordBatch, width: int) -> tuple[list[np.ndarray], dict]:
    sets = list(shingle_sets(strings(batch["_text"]).to_pylist(), width))
    digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
    pairs = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    return sets, {"n": np.array([len(s) for s in sets], np.int64), "d1": pairs[:, 0].copy(), "d2": pairs[:, 1].copy()}


def _profiles(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """For each row: set size, set digest, prefix and prefix digest."""
    frequency = texts.sparkSession.sparkContext.broadcast(_frequencies(texts, width))

    def profile(batches):
        rank = frequency.value
        for batch in _parts(batches):
            sets, found = _sets_of(batch, width)
            prefixes = []
            for s in sets:
                length = len(s) - -(-percent * len(s) // 100) + 1 if len(s) else 0
                prefixes.append(s[np.argsort(rank[_bucket(s)], kind="stable")[:length]])
            counts = [np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=256) for s in sets]
            odd = np.packbits((np.array(counts, np.int64).reshape(-1, 256) & 1).astype(np.uint8), axis=1).view(np.int64)
            groups = np.frombuffer(b"".join(xxhash.xxh3_128_digest(p.tobytes()) for p in prefixes), np.int64).reshape(-1, 2)
            yield pa.record_batch(
                {"_id": batch["_id"], "_text_hash": batch["_text_hash"], **found}
                | {"g1": groups[:, 0].copy(), "g2": groups[:, 1].copy(), "prefix": _lists(prefixes)}
                | {"sketch": pa.array([c.astype(np.uint8).tobytes() if c.max() < 256 else None for c in counts], pa.binary())}
                | {name: odd[:, k].copy() for k, name in enumerate(_ODD)}
            )

    id_type = texts.schema["_id"].dataType.simpleString()
    schema = f"_id {id_type}, _text_hash long, n long, d1 long, d2 long, g1 long, g2 long, prefix array<long>, sketch binary"
    schema += "".join(f", {name} long" for name in _ODD)
    return texts.mapInArrow(profile, schema)


def _full_sets(texts: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``node, n, tokens`` of the wanted classes, read again from one document of each."""

    def read(batches):
        for batch in _parts(batches):
            sets, found = _sets_of(batch, width)
            yield pa.record_batch(found | {"tokens": _lists(sets)})

    rows = texts.select("_id", "_text", "_text_hash").alias("t")
    on = F.col("t._id").eqNullSafe(F.col("w._id")) & (F.col("t._text_hash") == F.col("w._text_hash"))
    ids = wanted.select("_id", "_text_hash")
    ids = F.broadcast(ids) if wanted.count() <= BROADCAST_ROWS else ids
    one = rows.join(ids.alias("w"), on, "left_semi")
    sets = one.select("_text").mapInArrow(read, "n long, d1 long, d2 long, tokens array<long>")
    found = sets.join(wanted.select("node", "d1", "d2", F.col("n").alias("_n")), ["d1", "d2"]).filter("n = _n")
    # A repeated row gives the same set twice.
    return found.groupBy("node").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))


def _may_reach(percent: int) -> Column:
    """Whether sizes and parities allow the threshold for sides a and b.

    Two sets differ in at least as many shingles as there are hash bytes whose numbers of
    shingles differ in parity.
    """
    sizes = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    differ = sum(F.bit_count(F.col(f"{c}a").bitwiseXOR(F.col(f"{c}b"))) for c in _ODD)
    return sizes & (differ * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent))


def _possible(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose counts by hash byte allow the threshold: the smaller count of each byte bounds what is shared."""

    def bound(batches):
        for batch in batches:
            a, b = batch["sketcha"].to_pylist(), batch["sketchb"].to_pylist()
            known = np.array([x is not None and y is not None for x, y in zip(a, b)], bool)
            rows = np.flatnonzero(known)
            most = batch["na"].to_numpy() + batch["nb"].to_numpy()
            for k in range(0, len(rows), 4096):
                part = rows[k : k + 4096]
                x, y = (np.frombuffer(b"".join(side[i] for i in part), np.uint8).reshape(-1, 256) for side in (a, b))
                same = np.minimum(x, y).sum(axis=1, dtype=np.int64)
                known[part] = same * 100 < (most[part] - same) * percent
            yield pa.record_batch({"a": batch["a"], "b": batch["b"]}).filter(pa.array(~known))

    return pairs.select("a", "b", "na", "nb", "sketcha", "sketchb").mapInArrow(bound, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    a = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    b = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = pairs.join(a, "a").join(b, "b").withColumn("same", F.size(F.array_intersect("ta", "tb")))
    return both.filter(F.col("same") * 100 >= (F.col("na") + F.col("nb") - F.col("same")) * percent).select(
        F.col("a").alias("u"), F.col("b").alias("v")
    )


def _relabelled(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Labels after the components that the edges connect are united."""
    ends = edges.join(labels.select(F.col("node").alias("u"), F.col("label").alias("lu")), "u")
    ends = ends.join(labels.select(F.col("node").alias("v"), F.col("label").alias("lv")), "v")
    roots = components(ends.filter("lu != lv").select(F.col("lu").alias("u"), F.col("lv").alias("v")))
    roots = roots.select(F.col("u").alias("label"), "root")
    return labels.join(roots, "label", "left").select("node", F.coalesce("root", "label").alias("label"))


class _Join:
    """The state of the rounds: classes, groups, index and the labels found so far."""

    def __init__(self, texts: DataFrame, width: int, percent: int):
        self.width, self.percent, self.texts = width, percent, texts
        self.rows = stored(_profiles(texts, width, percent), "profiles")
        filled = self.rows.filter("n > 0")
        # One document of each class: its smallest id, and the smallest hash among equal ids.
        self.classes = stored(
            filled.groupBy("n", "d1", "d2", "g1", "g2")
            .agg(F.min(F.struct("_id", "_text_hash")).alias("_row"), F.first("prefix").alias("prefix"), F.first("sketch").alias("sketch"), *[F.first(c).alias(c) for c in _ODD])
            .select(
                *("n", "d1", "d2", "g1", "g2", "_row._id", "_row._text_hash", "prefix", "sketch", *_ODD),
                F.monotonically_increasing_id().alias("node"),
            ),
            "classes",
        )
        groups = self.classes.groupBy("n", "g1", "g2").agg(F.min("node").alias("grp"))
        self.members = stored(self.classes.select("node", "n", "g1", "g2").join(groups, ["n", "g1", "g2"]).select("node", "grp", "n"), "members")
        sizes = self.members.groupBy("grp").agg(F.count("*").alias("size")).withColumnRenamed("grp", "node")
        heads = self.classes.select("node", "prefix").join(sizes, "node")
        self.index = self._index(heads.select(F.col("node").alias("grp"), "prefix", "size"))

    def _index(self, heads: DataFrame) -> DataFrame:
        """``token, grp, at, uses, pivot`` for the shingles that several groups have in their prefixes.

        A group of several members has its first shingle here in any case, so that its members meet.
        The pivot of a shingle is one of its groups, chosen by the shingle's own bits so that
        the shingles of a cluster have different pivots.
        """
        entries = heads.select("grp", "size", F.posexplode("prefix").alias("at", "token"))
        mask = F.shiftrightunsigned(F.xxhash64("token"), 2)
        shared = entries.groupBy("token").agg(
            F.count("*").alias("uses"), F.min(F.col("grp").bitwiseXOR(mask)).alias("low"), F.max(F.expr("at = 0 and size > 1")).alias("inside")
        )
        shared = shared.filter("uses > 1 or inside").select("token", "uses", F.col("low").bitwiseXOR(mask).alias("pivot"))
        return stored(entries.drop("size").join(shared, "token"), "index")

    def expanded(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) of each member of a group with the head of another."""
        return pairs.join(self.members.select("grp", F.col("node").alias("a")), "grp").select("a", F.col("pivot").alias("b"))

    def fitting(self, pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """Distinct pairs that may reach the threshold and are not connected yet."""
        side = self.classes.select("node", "n", "sketch", *_ODD).join(labels, "node")
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a != b").distinct()
        for end in "ab":
            pairs = pairs.join(side.select(*[F.col(c).alias(c + end) for c in side.columns]).withColumnRenamed(f"node{end}", end), end)
        return _possible(pairs.filter(_may_reach(self.percent) & (F.col("labela") != F.col("labelb"))), self.percent)

    def linked(self, pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """Labels after a round over the given candidate pairs. The round's own tables go with it."""
        spark = labels.sparkSession
        path = session.scratch_path(spark, "labels")
        with session.scratch_scope(spark):
            pairs = stored(self.fitting(pairs, labels), "pairs")
            ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
            wanted = self.classes.select("node", "n", "d1", "d2", "_id", "_text_hash").join(ends, "node")
            wanted = stored(wanted, "wanted")
            if wanted.isEmpty():
                return labels
            sets = stored(_full_sets(self.texts, wanted, self.width), "sets")
            edges = stored(_verified(pairs, sets, self.percent), "links")
            _relabelled(labels, edges).write.parquet(path)
        return spark.read.schema(labels.schema).parquet(path)

    def remaining(self, labels: DataFrame) -> DataFrame:
        """All pairs in different components whose first common shingle of the prefixes leaves room for enough others.

        None of the shingles before the first common one is shared, since they would be in
        both prefixes; so the rest of either set bounds what the two have in common.
        """
        side = self.classes.select("node", "n", *_ODD).join(labels, "node")
        rows = self.index.select("token", "grp", "at").join(self.members.select("grp", "node"), "grp").join(side, "node")
        rows = rows.select("token", "at", "node", "n", "label", *_ODD)
        mixed = rows.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low != high")
        rows = stored(rows.join(mixed.select("token"), "token", "left_semi"), "mixed")
        a, b = (rows.select("token", *[F.col(c).alias(c + end) for c in ("at", "node", "n", "label", *_ODD)]) for end in "ab")
        room = F.least(F.col("na") - F.col("ata"), F.col("nb") - F.col("atb")) * (100 + self.percent)
        enough = room >= (F.col("na") + F.col("nb")) * self.percent
        pairs = a.join(b, "token").filter(F.expr("nodea < nodeb and labela != labelb") & enough & _may_reach(self.percent))
        return pairs.select(F.col("nodea").alias("a"), F.col("nodeb").alias("b"))

    def labels(self) -> DataFrame:
        labels = stored(self.members.select("node", F.col("node").alias("label")), "labels")
        star = self.index.filter("grp != pivot").select("grp", "pivot", "uses")
        frequent = Window.partitionBy("grp").orderBy(F.desc("uses"), "pivot")
        closest = star.distinct().withColumn("nth", F.row_number().over(frequent)).filter("nth <= 2")
        inside = self.members.filter("node != grp").select(F.col("node").alias("a"), F.col("grp").alias("b"))
        labels = self.linked(self.expanded(closest).union(inside), labels)
        labels = self.linked(self.expanded(star.select("grp", "pivot").distinct()), labels)
        return self.linked(self.remaining(labels), labels)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, text_hash``.

    Two texts are linked when ``100 * |A and B| >= percent * |A or B|`` for their shingle
    sets; ``component_id`` is the smallest id that links lead to, itself included. Null and
    empty texts have no shingles and are linked with nothing. Rows without an id take part;
    their component is named by the smallest id in it, null if there is none. Repeated rows
    each get a row. An empty table gives an empty result; other columns are ignored.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    texts = texts.withColumn("_text_hash", F.xxhash64("_text"))
    state = _Join(texts, width, percent)
    labels = state.labels()
    classes = state.classes.join(labels, "node").select("n", "d1", "d2", "label")
    rows = state.rows.filter("n > 0").select("_id", "_text_hash", "n", "d1", "d2").join(classes, ["n", "d1", "d2"])
    rows = stored(rows.select("_id", "_text_hash", "n", "label"), "labelled")
    # Stored, so that the join below is between two plain exchanges and splits a hot component.
    names = stored(rows.groupBy("label").agg(F.min("_id").alias("component_id")), "component-names")
    linked = rows.join(names, "label").select("_id", "_text_hash", "n", "component_id")
    alone = state.rows.filter("n = 0").select("_id", "_text_hash", "n", F.col("_id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("_id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", F.col("_text_hash").alias("text_hash")
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """The rows of ``docs`` of which one per component stays: the one with the smallest id.

    Rows without shingles all stay. Of rows with the same smallest id one stays, the one
    with the smallest text hash; of repeated rows any one. A component without ids keeps
    all its rows.
    """
    found = stored(near_duplicates(docs, id_col, text_col, width, percent), "near")
    first = found.filter("n_shingles > 0 and doc_id = component_id").groupBy("component_id").agg(
        F.min("text_hash").alias("first_hash"), F.count("*").alias("copies")
    )
    judged = found.filter("n_shingles > 0 and component_id is not null").join(first, "component_id")
    stays = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("first_hash"))
    judged = judged.withColumn("copies", F.when(stays, F.col("copies")).otherwise(F.lit(0)))
    marked = stored(judged.filter("copies != 1").select("doc_id", "text_hash", "copies").distinct(), "near-marked")
    helper = unused_name(docs, "_text_hash")
    rows = docs.withColumn(helper, F.xxhash64(text_of(text_col))).alias("d")
    on = F.col(f"d.{id_col}").eqNullSafe(F.col("m.doc_id")) & (F.col(f"d.{helper}") == F.col("m.text_hash"))
    clean = rows.join(marked.alias("m"), on, "left_anti")
    repeated = rows.join(marked.filter("copies > 1").alias("m"), on, "left_semi").dropDuplicates([id_col, helper])
    return clean.unionByName(repeated).select(*[F.col(f"`{c}`") for c in docs.columns])


def op4_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"), width=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


SQL = {
    "op4_ngram_jaccard_join": r"""
        with recursive words as (
            select doc_id,
                   list_filter(
                       regexp_split_to_array(
                           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[\x20\x09-\x0D]+'),
                       lambda w: w <> '') as w
            from documents
        ), sets as (
            select doc_id,
                   case when len(w) = 0 then []
                        when len(w) < 3 then [array_to_string(w, ' ')]
                        else list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
                   end as s
            from words
        ), grams as (
            select doc_id, len(s) as n, unnest(s) as g from sets
        ), shared as (
            select a.doc_id as x, b.doc_id as y, a.n as nx, b.n as ny, count(*) as same
            from grams a join grams b on a.g = b.g and a.doc_id < b.doc_id and 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
            group by all
        ), links as (
            select x, y from shared where 100 * same >= 90 * (nx + ny - same)
            union all
            select y, x from shared where 100 * same >= 90 * (nx + ny - same)
        ), reach(x, y) as (
            select doc_id, doc_id from documents
            union
            select reach.x, links.y from reach join links on reach.y = links.x
        )
        select sets.doc_id, len(s) as n_shingles, min(reach.y) as component_id
        from sets join reach on sets.doc_id = reach.x
        group by sets.doc_id, len(s)"""
}
