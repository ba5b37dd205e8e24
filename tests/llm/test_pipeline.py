"""The pipeline, stage by stage, against brute force on what each stage was given."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.plain import words
from tests.llm.test_decontamination import plain as windows
from tests.llm.test_near_duplicates import plain as components
from tidemark.llm import queries, queries_files
from tidemark.llm.common import in_small_batches
from tidemark.sources import scratch

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What went into each stage and what came out of the last one."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append(docs.collect())
        path = str(tmp_path_factory.mktemp(name) / "docs")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "tokens":
            assert docs.columns == COLUMNS
    return [*out, docs.collect()]


def test_toxicity_keeps_clean_documents(spark, stages):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = {r["doc_id"] for r in stages[0]} - {r["doc_id"] for r in stages[1]}
    clean = {i for i, t in labels.items() if t == 0}
    assert len(gone & clean) <= 0.02 * len(clean)
    assert gone


def test_one_of_each_group_stays(stages):
    rows = [tuple(r) for r in stages[1]]
    want = {i for i, _, _, kept in components(rows, 5).elements() if kept}
    assert Counter(r["doc_id"] for r in stages[2]) == Counter(want)


def test_documents_with_windows_go(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = {k[0] for k in windows([tuple(r) for r in stages[2]], items) if not k[5]}
    assert Counter(r["doc_id"] for r in stages[3]) == Counter(want)


def test_mixture_repeats_documents_at_most_twice(stages):
    given, taken = {r["doc_id"]: r for r in stages[3]}, Counter(r["doc_id"] for r in stages[4])
    assert set(taken) <= set(given) and max(taken.values()) <= 2
    sizes = sum(len(words(r["text"])) for r in given.values())
    assert sum(len(words(r["text"])) for r in stages[4]) == pytest.approx(1.5 * sizes, rel=0.15)


def test_tokens_of_the_mixture(stages):
    tokenizer = Tokenizer.from_file(queries_files.tokenizer_path())
    start, want = 0, []
    for r in sorted(stages[4], key=lambda r: r["doc_id"]):
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        want.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, stages[5])) == sorted(want)


def test_run_applies_all_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, stages[-1]))


def test_queries_have_their_contract(spark):
    names = {n.split("_")[0] for n in queries.all_queries()}
    assert names == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize(("stage", "module", "inner", "table"), [
    ("drop_toxic", "toxicity", "without_toxic", "labels"),
    ("drop_contaminated", "decontamination", "decontaminate", "benchmark"),
])
def test_python_gets_small_batches(spark, tmp_path, monkeypatch, stage, module, inner, table):
    """An executor's buffers are as large as the batches that go to Python."""
    spark.range(1).write.parquet(f"{tmp_path}/{table}.parquet")
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('word ', 1000) AS text").coalesce(1)

    def sized(docs, _):
        def each(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

        return docs.mapInArrow(each, "n long")

    monkeypatch.setattr(getattr(corpus_pipeline, module), inner, sized)
    got = [r["n"] for r in getattr(corpus_pipeline, stage)(spark, docs, str(tmp_path)).collect()]
    assert sum(got) > 3000 * 5000
    assert max(got) < 2 * corpus_pipeline.BATCH_BYTES


@pytest.fixture
def made(spark, tmp_path, monkeypatch):
    """A folder of tables of texts that no codec shortens much, and the scratch folder."""
    monkeypatch.setattr(scratch, "scratch_root", lambda _: str(tmp_path / "scratch"))
    text = "array_join(transform(sequence(1, 100), i -> sha2(concat(id, ':', i), 256)), ' ')"
    docs = spark.range(300).selectExpr(
        "id AS doc_id", f"{text} AS text", "'en' AS lang", "concat('s', id % 3) AS source", "1L AS n_chars"
    )
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.range(40).selectExpr("id AS doc_id", "0 AS toxic")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items = spark.createDataFrame([("a", "no document has this")], "item_id string, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    return tmp_path, tmp_path / "scratch"


def held(folder):
    return sum(p.stat().st_size for p in folder.rglob("*") if p.is_file())


@pytest.mark.parametrize("stage", ["drop_toxic", "drop_contaminated"])
def test_stages_leave_no_copy_of_all_documents(spark, made, stage):
    tables, kept = made
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    getattr(corpus_pipeline, stage)(spark, docs, str(tables)).write.parquet(f"{tables}/out")
    assert Counter(spark.read.parquet(f"{tables}/out").collect()) == Counter(docs.collect())
    # 40 of 300 texts are labelled; these are kept to learn from.
    assert held(kept) < held(tables / "documents.parquet") / 4


def test_run_leaves_nothing_that_stages_kept(spark, made):
    tables, kept = made
    got = corpus_pipeline.run(spark, str(tables))
    assert len({r["doc_id"] for r in got.collect()}) > 200
    assert list((kept / "tidemark").glob("pipeline-*")) == []


def test_rows_in_small_batches_keep_settings_and_columns(spark):
    docs = spark.sql("SELECT 1L AS doc_id, CAST(NULL AS STRING) AS `a.b`, NULL AS none")
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    own = in_small_batches(docs, 1 << 16)
    assert own.dtypes == docs.dtypes and own.collect() == docs.collect()
    conf = own.sparkSession.conf
    assert conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(1 << 16)
    assert conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
