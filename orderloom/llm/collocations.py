"""Mining of phrase collocations per language, over a prefix-free parse of the texts.

1. Parse: texts are cut into pieces at punctuation and pieces into chunks. A chunk begins
   where the hash of a window of four words is a multiple of ``TRIGGER``, so equal passages
   are cut alike wherever they stand, and it reaches over the window that begins the next
   one. The distinct chunks with their frequencies are the dictionary; copies of documents
   and passages shrink to a number. It is stored in blocks that number their own words.
2. Count: n-grams are counted inside the distinct chunks, weighted by the frequency of the
   chunk. One that begins in the four words shared with the next chunk belongs to that
   one, so every occurrence counts once. Hashes are counted first, one length after the
   other: a longer phrase is only looked at where both phrases one word shorter may be
   frequent. What may be frequent is known to the tasks as a bit map of fixed size, which
   lets some rare phrases pass but holds back no frequent one.
3. The phrases that pass, of all lengths, are counted by their words in one more reading of
   the dictionary. Hashes decide nothing but which positions are looked at.
4. Score: every candidate is joined with the frequencies of the parts of its cuts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import BitMap, bit_map, prepare, read_table, slices, stored, strings, text_of

MIN_COUNT, TOP, LONGEST = 100, 2000, 5
#: One in so many windows begins a chunk.
TRIGGER = 32
#: Words that two chunks share: one less than the longest phrase has.
_SHARED = LONGEST - 1
#: Bytes of text that a task parses at a time, and of distinct chunks that make a block.
PARSE_BYTES, BLOCK_BYTES = 4 << 20, 2 << 20
NO_LANGUAGE = "und"
# A to Z in lower case, the tab as a space and the marks that end a piece as line feeds.
_TABLE = bytes(0x0A if c in b".,;:!?\n\x0b\x0c\r" else 0x20 if c == 0x09 else c for c in range(256)).lower()
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _ODD
    return h ^ (h >> np.uint64(29))


def _of_language(words: np.ndarray, langs: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """Hashes of words in their languages; ``es`` in ``en`` is not ``en`` in ``es``, as the names of languages are words too."""
    return _mixed(words ^ _mixed(langs * _ODD)[lang])


class Words:
    """The words of some lines: codes, values, and the line and language that each stands in."""

    def __init__(self, lines: pa.Array, lang: pa.Array):
        lang = lang.dictionary_encode()
        self.langs = lang.dictionary
        joined = pc.binary_join(pa.LargeListArray.from_arrays([0, len(lines)], lines), pa.scalar("\n", lines.type))
        size = pc.binary_length(lines).to_numpy().astype(np.int64) + 1
        text = np.frombuffer(joined[0].as_buffer().to_pybytes().translate(_TABLE), np.uint8)
        inside = (text != 0x0A) & (text != 0x20)
        edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
        self.start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        offsets = np.concatenate([[0], np.cumsum(end - self.start)])
        if offsets[-1] >= 1 << 31:
            raise ValueError("one text of more than 2 GB")
        values = pa.BinaryArray.from_buffers(
            pa.binary(), len(self.start), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(text[inside])]
        ).dictionary_encode()
        self.code, self.values = values.indices.to_numpy().astype(np.int64), values.dictionary
        self.piece = np.cumsum(text == 0x0A, dtype=np.int32 if len(text) < 1 << 31 else np.int64)[self.start]
        self.line = np.repeat(np.arange(len(lines)), np.diff(np.searchsorted(self.start, np.cumsum(size)), prepend=0))
        self.lang_of_line = lang.indices.to_numpy().astype(np.int64)
        self.lang = self.lang_of_line[self.line]
        digest = xxhash.xxh3_64_intdigest
        self.value_hash = np.fromiter(map(digest, self.values.to_numpy(zero_copy_only=False)), np.uint64, len(self.values))
        self.hash = self.value_hash[self.code]
        self.lang_hash = np.array([digest(v) for v in self.langs.to_pylist()], np.uint64)

    def joined(self, start: np.ndarray, length: np.ndarray) -> pa.Array:
        """The words of some stretches, with single spaces."""
        ends = np.cumsum(length)
        at = np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)
        offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
        lists = pa.ListArray.from_arrays(offsets, self.values.take(pa.array(self.code[at])))
        return pc.binary_join(lists, b" ").cast(pa.string())

    def grams(self, n: int) -> np.ndarray:
        """Hash of the ``n`` words from each word on; they may reach into the next piece."""
        found = _of_language(self.hash, self.lang_hash, self.lang)
        for i in range(1, n):
            found = _mixed(found[:-1] * _ODD + self.hash[i:]) if len(found) else found
        return found


def _chunks(words: Words, trigger: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word and number of words of each chunk, and whether another one follows in its piece."""
    n = len(words.code)
    begins = np.ones(n, bool)
    begins[1:] = words.piece[1:] != words.piece[:-1]
    head = np.zeros(n, bool)
    if n >= _SHARED:
        whole = words.piece[: n - _SHARED + 1] == words.piece[_SHARED - 1 :]
        head[: n - _SHARED + 1] = whole & (words.grams(_SHARED) % np.uint64(trigger) == 0)
    start = np.flatnonzero(begins | head)
    after = np.append(start, n)[1:]
    goes_on = ~np.append(begins, True)[after]
    return start, after - start + np.where(goes_on, _SHARED, 0), goes_on


def parse(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", trigger: int = TRIGGER) -> DataFrame:
    """The dictionary: ``lang, chunk, goes_on, times``, one row per distinct chunk.

    ``goes_on`` says that the chunk's last four words begin another chunk.
    """
    spark = prepare(docs.sparkSession)
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE))
    rows = docs.select(lang.alias("lang"), text_of(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, pc.binary_length(batch["text"]), PARSE_BYTES):
                words = Words(strings(part["text"]), part["lang"])
                start, length, goes_on = _chunks(words, trigger)
                found = pa.table(
                    {
                        "lang": words.langs.take(pa.array(words.lang[start])),
                        "chunk": words.joined(start, length),
                        "goes_on": goes_on,
                    }
                )
                counted = found.group_by(["lang", "chunk", "goes_on"]).aggregate([([], "count_all")])
                yield from counted.rename_columns(["lang", "chunk", "goes_on", "times"]).to_batches()

    found = rows.mapInArrow(run, "lang string, chunk string, goes_on boolean, times long")
    return found.groupBy("lang", "chunk", "goes_on").agg(F.sum("times").alias("times"))


_NUMBERS = {"hashes": np.uint64, "lang_hashes": np.uint64, "codes": np.int32, "lang": np.int32, "size": np.int32, "own": np.int32}
_NUMBERS["times"] = np.int64
_BLOCK = "words array<string>, langs array<string>, totals array<bigint>, " + ", ".join(f"{c} binary" for c in _NUMBERS)


def _summed(group: np.ndarray, times: np.ndarray, size: int) -> np.ndarray:
    total = np.zeros(size, np.int64)
    np.add.at(total, group.ravel(), times)
    return total


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Dictionary rows as blocks: the words of all chunks by number, and facts of each chunk."""
    waiting, size = [], 0

    def block() -> pa.RecordBatch:
        table = pa.Table.from_batches(waiting)
        words = Words(strings(table["chunk"].combine_chunks()), table["lang"].combine_chunks())
        length = np.bincount(words.line, minlength=table.num_rows)
        own = length - np.where(table["goes_on"].to_numpy(), _SHARED, 0)
        lang, times = words.lang_of_line, table["times"].to_numpy()
        totals = _summed(lang, own * times, len(words.langs))
        facts = [words.value_hash, words.lang_hash, words.code, lang, length, own, times]
        packed = [[f.astype(kind).tobytes()] for f, kind in zip(facts, _NUMBERS.values())]
        lists = [words.values.cast(pa.string()), words.langs.cast(pa.string()), pa.array(totals)]
        columns = [*(pa.ListArray.from_arrays([0, len(values)], values) for values in lists), *packed]
        return pa.record_batch(columns, ["words", "langs", "totals", *_NUMBERS])

    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        size += batch.nbytes
        if size >= BLOCK_BYTES:
            yield block()
            waiting, size = [], 0
    if waiting:
        yield block()


class Block:
    """A block of the dictionary: per word its number, hash, chunk and the words left in the chunk."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        """The values of words and languages are there where the batch has them."""
        self.words, self.langs = (batch[c][row].values if c in batch.schema.names else None for c in ("words", "langs"))
        hashes, lang_hashes, self.code, lang, size, own, times = (
            np.frombuffer(batch[c][row].as_buffer(), kind) for c, kind in _NUMBERS.items()
        )
        self.hash = hashes[self.code]
        ends = np.cumsum(size, dtype=np.int32)
        place = np.arange(len(self.code), dtype=np.int32) - np.repeat(ends - size, size)
        self.left = np.where(place < np.repeat(own, size), np.repeat(size, size) - place, np.int32(0))  # 0: the next chunk's
        self.times = np.repeat(times, size)
        self.lang = np.repeat(lang, size)
        self._grams = [_of_language(self.hash, lang_hashes, self.lang)]

    def grams(self, n: int) -> np.ndarray:
        """Hash of language and ``n`` words from each word on; they may reach into the next chunk."""
        while len(self._grams) < n:
            last = self._grams[-1]
            self._grams.append(_mixed(last[:-1] * _ODD + self.hash[len(self._grams) :]) if len(last) else last)
        return self._grams[n - 1]

    def places(self, n: int, bits: BitMap | None, length: int) -> np.ndarray:
        """Where phrases of ``n`` words begin whose parts of ``length`` words may be frequent."""
        found = np.flatnonzero(self.left >= n)
        if bits is not None:
            for i in range(n - length + 1):
                found = found[bits.holds(self.grams(length)[found + i])]
        return found

    def same(self, a: np.ndarray, b: np.ndarray, n: int) -> bool:
        """Whether the phrases at ``a`` are those at ``b``, word by word."""
        return bool((self.lang[a] == self.lang[b]).all()) and all((self.code[a + i] == self.code[b + i]).all() for i in range(n))

    def phrases(self, at: np.ndarray, n: int) -> pa.Array:
        parts = [self.words.take(pa.array(self.code[at + i])) for i in range(n)]
        return pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0]


def _count_hashes(block: Block, n: int, bits: BitMap | None) -> pa.RecordBatch:
    """Frequencies by hash of the phrases of ``n`` words whose parts of one word less may be frequent."""
    at = block.places(n, bits, n - 1)
    grams, group = np.unique(block.grams(n)[at], return_inverse=True)
    total = _summed(group, block.times[at], len(grams))
    return pa.record_batch([pa.array(grams.view(np.int64)), pa.array(total)], ["hash", "times"])


def _count_phrases(block: Block, n: int, bits: BitMap) -> pa.RecordBatch:
    """Frequencies by words of the phrases of ``n`` words that may be frequent."""
    at = block.places(n, bits, n)
    grams, group = np.unique(block.grams(n)[at], return_inverse=True)
    first = np.empty(len(grams), np.int64)
    first[group] = np.arange(len(at))  # any place of the group; NumPy's own first place takes a much slower sort
    if not block.same(at, at[first][group], n):  # equal hashes of unequal words
        keys = np.stack([block.lang[at], *[block.code[at + i] for i in range(n)]], axis=1)
        _, first, group = np.unique(keys, axis=0, return_index=True, return_inverse=True)
    here = at[first]
    columns = [block.langs.take(pa.array(block.lang[here])), block.phrases(here, n)]
    return pa.record_batch([*columns, pa.array(_summed(group, block.times[at], len(here)))], ["lang", "phrase", "times"])


def _over_blocks(blocks: DataFrame, count, schema: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                for found in count(Block(batch, row)):
                    for low in range(0, found.num_rows, 100_000):
                        yield found.slice(low, 100_000)

    return blocks.mapInArrow(run, schema)


def _frequent_hashes(blocks: DataFrame, n: int, bits: BitMap | None, min_count: int) -> DataFrame:
    shared = blocks.sparkSession.sparkContext.broadcast(bits)
    found = _over_blocks(
        blocks.select(*_NUMBERS), lambda block: [_count_hashes(block, n, shared.value)], "hash long, times long"
    )
    return found.groupBy("hash").agg(F.sum("times").alias("f")).filter(F.col("f") >= min_count)


def _phrases(blocks: DataFrame, bits: BitMap, min_count: int) -> DataFrame:
    """All frequent phrases: ``lang, phrase, f``. One map has the hashes of all lengths."""
    shared = blocks.sparkSession.sparkContext.broadcast(bits)
    found = _over_blocks(
        blocks.select("words", "langs", *_NUMBERS),
        lambda block: (_count_phrases(block, n, shared.value) for n in range(1, LONGEST + 1)),
        "lang string, phrase string, times long",
    )
    return found.groupBy("lang", "phrase").agg(F.sum("times").alias("f")).filter(F.col("f") >= min_count)


def _totals(blocks: DataFrame) -> DataFrame:
    """How many words each language has."""
    found = blocks.select(F.inline(F.arrays_zip("langs", "totals")))
    return found.groupBy(F.col("langs").alias("lang")).agg(F.sum("totals").alias("n"))


def _words(first: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, length), " ")


def _scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """Each candidate with its lowest-scoring cut."""
    size = F.size(F.split("phrase", " "))
    cuts = (
        phrases.filter(size > 1)
        .select("lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
        .withColumns({"first": _words(F.lit(1), F.col("k")), "rest": _words(F.col("k") + 1, F.lit(LONGEST))})
    )
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    joined = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    score = F.expr("(cast(1000 * a as decimal(20, 0)) * cast(n as decimal(18, 0))) div (cast(l as decimal(19, 0)) * r)")
    return (
        joined.withColumn("score", score)
        .groupBy("lang", "phrase", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    )


def _held(phrases: DataFrame) -> DataFrame:
    """For phrases inside longer ones, the greatest frequency of a longer one.

    One word more is enough: a phrase is never rarer than one that holds it, so where a
    longer one is as frequent, those in between are too.
    """
    size = F.size(F.split("phrase", " "))
    inner = F.array(_words(F.lit(1), size - 1), _words(F.lit(2), size - 1))
    return (
        phrases.filter(size > 2)
        .select("lang", F.col("f"), F.explode(inner).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("longer"))
    )


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    top: int = TOP,
    trigger: int = TRIGGER,
) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    ``a`` is the frequency of the phrase, ``l`` and ``r`` those of the parts of its
    lowest-scoring cut, ``n`` all words of the language, the score their ratio in
    thousandths, rounded down. A phrase inside a longer one of the same frequency is left
    out. Ties go by frequency, then by the bytes of the phrase. A null language is ``und``;
    null and empty texts have no words; repeated rows count as often as they stand there;
    an empty table gives an empty result; other columns are ignored.
    """
    blocks = stored(parse(docs, text_col, lang_col, trigger).mapInArrow(_pack, _BLOCK), "chunk-blocks")
    maps, bits = [], None
    for n in range(1, LONGEST + 1):
        bits = bit_map(_frequent_hashes(blocks, n, bits, min_count).select("hash"))
        maps.append(bits)
    phrases, totals = stored(_phrases(blocks, BitMap.union(maps), min_count), "phrases"), _totals(blocks)
    scored = _scored(phrases, totals).join(_held(phrases), ["lang", "phrase"], "left")
    kept = scored.filter(F.col("longer").isNull() | (F.col("longer") < F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


SQL = {
    "op11_collocations": r"""
    WITH texts AS (SELECT coalesce(lang, 'und') AS lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
    pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
    cut AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
    totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM cut GROUP BY lang),
    grams AS (SELECT lang, size, unnest([words[i:i + size - 1] for i in range(1, len(words) - size + 2)]) AS gram
      FROM cut, range(1, 6) AS s(size)),
    counted AS (SELECT lang, size, gram, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
    candidates AS (SELECT lang, size, gram, f AS a FROM counted WHERE size > 1),
    cuts AS (SELECT c.lang, c.gram, c.size, c.a, k, x.f AS l, y.f AS r, n,
        (1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS score
      FROM candidates c, range(1, 5) AS ks(k), counted x, counted y, totals t
      WHERE k < c.size AND x.lang = c.lang AND y.lang = c.lang AND t.lang = c.lang
        AND x.gram = c.gram[1:k] AND y.gram = c.gram[k + 1:]),
    lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1),
    inner_grams AS (SELECT lang, a, unnest(flatten([[gram[i:i + m - 1] for i in range(1, size - m + 2)] for m in range(2, size)]))
      AS gram FROM candidates),
    longer AS (SELECT lang, gram, max(a) AS most FROM inner_grams GROUP BY ALL),
    kept AS (SELECT w.lang, array_to_string(w.gram, ' ') AS phrase, w.a, l, r, n, score FROM lowest w
      LEFT JOIN longer o ON o.lang = w.lang AND o.gram = w.gram WHERE o.most IS NULL OR 100 * o.most < 100 * w.a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
      a, l, r, n, score::BIGINT AS score
    FROM kept QUALIFY rank <= 2000"""
}
