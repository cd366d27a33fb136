"""Every stage of the corpus pipeline against plain Python, each on its own input."""

from collections import Counter

import pytest

import corpus_pipeline
from llm.cases import SMALL
from llm.test_exact_and_near import _expected_near, _shingles
from llm.test_packing import _check, _whole
from orderloom.llm.tokens import END_ID


@pytest.fixture(scope="module")
def stages(spark, documents, tmp_path_factory):
    """Input and output rows of every stage, stored in between as the pipeline does."""
    docs, found = documents, []
    extra = [(10_000, "123 456"), (10_001, None), (10_002, ""), (10_003, documents.first()["text"])]
    more = spark.createDataFrame([(i, t, None, "s", 0) for i, t in extra], documents.schema)
    docs = docs.unionByName(more)
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        out = stage(spark, docs, SMALL)
        out.write.parquet(path)
        out = spark.read.schema(out.schema).parquet(path)
        found.append((docs, out))
        docs = out
    return found


def _rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages_keep_the_columns_of_documents(stages, documents):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontamination", "packing"]
    for _, out in stages[:-1]:
        assert out.dtypes == documents.dtypes


def test_language_stage_keeps_text_with_letters(stages):
    before, after = map(_rows, stages[0])
    assert sorted(after) == sorted(r for r in before if any(c.isalpha() for c in r[1] or ""))


def test_exact_stage_keeps_the_largest_id(stages):
    before, after = map(_rows, stages[1])
    want = {}
    for doc_id, text in before:
        want[text] = max(doc_id, want.get(text, doc_id))
    assert sorted(after) == sorted((d, t) for t, d in want.items())


def test_near_stage_keeps_one_of_each_component(stages):
    before, after = map(_rows, stages[2])
    keep = {c for _, n, c in _expected_near(before, 5, 80)}
    assert sorted(after) == sorted(r for r in before if r[0] in keep or not _shingles(r[1], 5))


def test_decontamination_stage_drops_benchmark_text(spark, stages):
    plain = lambda t: " ".join(t.lower().split())
    items = [plain(r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    before, after = map(_rows, stages[3])
    # The test data holds items only as they are, so containment tells.
    assert sorted(after) == sorted(r for r in before if not any(i in plain(r[1]) for i in items))
    assert len(after) < len(before)


def test_packing_stage(stages):
    before, packed = stages[4]
    texts = _rows(before)
    assert _check(packed.collect(), texts, 1024) == Counter((d, tuple([*_whole(t), END_ID])) for d, t in texts)


def _tables(spark, folder, documents, benchmark):
    documents.write.parquet(f"{folder}/documents.parquet")
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_run_is_all_stages_one_after_the_other(spark, stages, tmp_path):
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    packed = corpus_pipeline.run(spark, _tables(spark, tmp_path / "sf", stages[0][0], benchmark)).collect()
    pieces = lambda rows: Counter((r["doc_id"], r["start"], r["ids_crc32"], r["doc_tokens"]) for r in rows)
    assert pieces(packed) == pieces(stages[4][1].collect())


def test_empty_tables(spark, documents, tmp_path):
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    nothing = _tables(spark, tmp_path / "a", documents.limit(0), benchmark)
    assert corpus_pipeline.run(spark, nothing).collect() == []
    no_items = _tables(spark, tmp_path / "b", documents.limit(30), benchmark.limit(0))
    kept = {r["doc_id"] for r in corpus_pipeline.run(spark, no_items).collect()}
    assert kept and kept <= {r["doc_id"] for r in documents.limit(30).collect()}
