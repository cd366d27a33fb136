"""Exact duplicates by deterministic block naming.

A text is cut into blocks of a fixed number of characters. Blocks are dealt out by
content and sorted; a run of equal blocks gets one integer. Then names of adjacent pairs
are named again, level by level, until one integer is left for each document. Names stand
for content without collisions: two texts are equal exactly if they have as many blocks
and the same last name. No digest decides equality.

Only DataFrame operations. The text is shuffled once. A block that makes up more than
1/4096 of all blocks is dealt out over ``SALTS`` partitions; at most 4095 blocks can be
that frequent, so the table that unites their names is bounded and may be broadcast.
Pair names are plain integers: they are counted before they are shuffled, and the join
that hands them back is one that Spark splits on a hot pair.

Names are read from stored tables, so a repeated task cannot give out other ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import prepare, read_table, stored, text_of, unused_name

BLOCK_CHARS = 1024
HOT_SHARE = 4096
SALTS = 32

_KEY = ["_id", "_sha"]


def _sha(text: Column) -> Column:
    return F.sha2(text, 256)


def _blocks(docs: DataFrame, id_col: str, text_col: str, block_chars: int) -> DataFrame:
    """One row per block. The digest only tells apart rows that share an id."""
    text = text_of(text_col)
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    pieces = F.when(text == "", F.array(F.lit(""))).otherwise(pieces)
    rows = docs.select(F.col(id_col).alias("_id"), F.unhex(_sha(text)).alias("_sha"), pieces.alias("_pieces"))
    return rows.select(
        *_KEY, F.size("_pieces").alias("_n"), F.posexplode("_pieces").alias("_pos", "_block")
    ).withColumn("_hash", F.xxhash64("_block"))


def _hot_hashes(blocks: DataFrame) -> DataFrame:
    """Hashes of the blocks that are more than one in ``HOT_SHARE``: fewer than ``HOT_SHARE`` rows."""
    counts = stored(blocks.groupBy("_hash").agg(F.count("*").alias("_count")), "block-counts")
    total = counts.agg(F.sum("_count")).first()[0] or 0
    return counts.filter(F.col("_count") * HOT_SHARE > total).select("_hash", F.lit(True).alias("_hot"))


def _block_names(blocks: DataFrame) -> DataFrame:
    """``_name`` for each block: the number of the first row of its run in the sorted blocks."""
    hot = F.broadcast(_hot_hashes(blocks))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*_KEY, "_pos"), F.lit(SALTS))).otherwise(F.lit(0))
    dealt = blocks.join(hot, "_hash", "left").withColumn("_salt", salt).repartition("_block", "_salt")
    run = Window.partitionBy("_block", "_salt")
    local = stored(
        dealt.withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_local", F.min("_row").over(run))
        .select(
            *_KEY,
            "_n",
            "_pos",
            "_local",
            F.when(F.col("_hot") & (F.col("_row") == F.col("_local")), F.col("_block")).alias("_hot_block"),
        ),
        "block-names",
    )
    # At most HOT_SHARE * SALTS rows: one for each hot block and salt.
    heads = local.filter(F.col("_hot_block").isNotNull()).select("_local", "_hot_block")
    united = heads.join(heads.groupBy("_hot_block").agg(F.min("_local").alias("_united")), "_hot_block")
    names = local.join(F.broadcast(united.select("_local", "_united")), "_local", "left")
    return names.select(*_KEY, "_n", "_pos", F.coalesce("_united", "_local").alias("_name"))


def _pair_level(rows: DataFrame) -> DataFrame:
    """Names of adjacent pairs; a last block without a neighbour is paired with -1."""
    even = F.col("_pos") % 2 == 0
    half = F.floor(F.col("_pos") / 2).cast("int")
    pairs = stored(
        rows.groupBy(*_KEY, "_n", half.alias("_pos")).agg(
            F.max(F.when(even, F.col("_name"))).alias("_left"),
            F.coalesce(F.max(F.when(~even, F.col("_name"))), F.lit(-1)).alias("_right"),
        ),
        "pairs",
    )
    names = stored(
        pairs.select("_left", "_right").distinct().withColumn("_name", F.monotonically_increasing_id()), "pair-names"
    )
    return stored(pairs.join(names, ["_left", "_right"]).select(*_KEY, "_n", "_pos", "_name"), "pair-level")


def document_names(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per (id, digest): ``_n`` blocks, last ``_name`` and ``_copies`` (repeated rows)."""
    prepare(docs.sparkSession)
    names = stored(_block_names(_blocks(docs, id_col, text_col, block_chars)), "named-blocks")
    copies = names.filter("_pos = 0").groupBy(*_KEY).agg(F.count("*").alias("_copies"))
    level, width = names, 1
    longest = names.agg(F.max("_n")).first()[0] or 1
    done = []
    while True:
        # Those whose blocks are united by now leave; the rest goes on.
        done.append(level.filter((F.col("_pos") == 0) & (F.col("_n") <= width)).select(*_KEY, "_n", "_name").distinct())
        if width >= longest:
            break
        level, width = _pair_level(level.filter(F.col("_n") > width)), 2 * width
    united = done[0]
    for other in done[1:]:
        united = united.unionByName(other)
    join = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in _KEY]
    return united.alias("a").join(copies.alias("b"), join).select("a.*", "b._copies")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the largest id stays. A null text is empty; an empty text is one empty
    block, so empty texts form one group. A null id counts as smaller than any other. Of
    repeated rows (same id, same text) one is kept. Rows that share an id but not the text
    are told apart. An empty table gives an empty result; other columns are ignored.
    """
    names = stored(document_names(docs, id_col, text_col, block_chars), "document-names")
    group = ["_n", "_name"]
    # Stored, so that the join below is between two plain exchanges and splits a hot group.
    groups = stored(names.groupBy(*group).agg(F.sum("_copies").alias("group_size"), F.max("_id").alias("keep_id")), "groups")
    rows = names.join(groups, group).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    return rows.select(
        F.col("_id").alias("doc_id"),
        "keep_id",
        "group_size",
        (F.col("_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of repeated rows any one."""
    decided = exact_duplicates(docs, id_col, text_col)
    kept = decided.groupBy(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).agg(
        F.max("kept").alias("_kept"), F.count("*").alias("_copies")
    )
    kept = stored(kept, "kept")
    helper = unused_name(docs, "_sha_row")
    rows = docs.withColumn(helper, _sha(text_of(text_col)))
    on = F.col(f"_d.{id_col}").eqNullSafe(F.col("_k._id")) & (F.col(f"_d.{helper}") == F.col("_k._sha"))
    single = rows.alias("_d").join(kept.filter("not _kept or _copies > 1").alias("_k"), on, "left_anti")
    repeated = (
        rows.alias("_d").join(kept.filter("_kept and _copies > 1").alias("_k"), on, "left_semi").dropDuplicates([id_col, helper])
    )
    return single.unionByName(repeated).select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf_dir, "documents"))


SQL = {
    "op8_exact_dedup": """
        select doc_id,
               max(doc_id) over same as keep_id,
               count(*) over same as group_size,
               doc_id = max(doc_id) over same as kept,
               sha256(coalesce(text, '')) as text_sha256
        from documents
        window same as (partition by coalesce(text, ''))"""
}
