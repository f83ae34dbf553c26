"""Stages on odd rows and columns, and reading files back in parallel."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF_SMALL
from triplake.llm import decontaminate, near_dedup, pii, steps, token_files, tokens, warc
from triplake.plans.materialize import materialize

PASSAGE = " ".join(f"word{i} of{i % 7}" for i in range(30))
CLEAN = "nothing of the kind stands here at all " * 6
EXTRA = "doc_id long, text string, lang string, source string, n_chars string, _bad long, bad_row long, _dropped long, dropped string"


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")


def rows(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "s", "x", 1, 2, 3, "y") for i, t in pairs], EXTRA)


def kept(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_contaminated_rows_go_by_their_own_text(spark, benchmark):
    dirty = f"before {PASSAGE} after"
    docs = rows(spark, [(1, CLEAN), (None, dirty), (None, CLEAN), (2, dirty), (2, CLEAN), (3, None), (4, ""), (5, dirty), (5, dirty)])
    got = decontaminate.drop_contaminated(docs, benchmark)
    assert got.schema == docs.schema
    assert kept(got) == sorted([(1, CLEAN), (None, CLEAN), (2, CLEAN), (3, None), (4, "")], key=str)
    assert decontaminate.drop_contaminated(docs.limit(0), benchmark).collect() == []
    assert decontaminate.drop_contaminated(docs, benchmark.limit(0)).count() == 9


def test_near_duplicates_with_clashing_columns(spark):
    docs = rows(spark, [(1, CLEAN), (2, CLEAN), (3, PASSAGE), (None, CLEAN), (4, None), (5, "")])
    got = near_dedup.drop_near_duplicates(docs)
    assert got.schema == docs.schema
    assert kept(got) == sorted([(1, CLEAN), (3, PASSAGE), (None, CLEAN), (4, None), (5, "")], key=str)


def test_masking_leaves_a_length_column_that_is_no_number(spark):
    docs = rows(spark, [(1, "write to ann@example.com"), (2, None), (None, "plain")])
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pii.mask(docs).collect()}
    assert got == {1: ("write to <EMAIL>", "x"), 2: (None, "x"), None: ("plain", "x")}
    assert pii.mask(docs.limit(0)).collect() == []
    numbers = docs.withColumn("n_chars", F.length("text").cast("int"))
    assert {r["n_chars"] for r in pii.mask(numbers).collect()} == {16, None, 5}


def test_files_are_read_by_many_tasks(spark):
    """Adaptive execution must not merge the manifest's rows into one task."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    folder, manifest, by_rank = token_files.write_files(docs, tokens.vocabulary_path(), 2, 20)
    files = manifest.count()
    tasks = token_files.read_files(folder, manifest, by_rank).select(F.spark_partition_id().alias("t")).distinct().count()
    assert files >= 4 and tasks == files
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").repartition(5)
    folder, manifest = warc.write_archives(warc.with_revisits(pages).repartition(5))
    archives = manifest.count()
    tasks = warc.read_archives(folder, manifest).select(F.spark_partition_id().alias("t")).distinct().count()
    assert tasks == archives


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Nulls in any column, repeated ids, a very long text, extra columns."""
    source = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    long = " ".join(r["text"] for r in source.limit(200).collect() if r["text"]) * 3
    odd = spark.createDataFrame(
        [(None, "some text of a row without an id", None, None, None), (10**9, None, "en", "s", 0), (10**9 + 1, long, None, "s", len(long)), (10**9 + 1, "again", "en", None, 5)],
        source.schema,
    )
    source.unionByName(odd).withColumns({"dropped": F.lit("x"), "kept": F.lit(1)}).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.materialize(stage(spark, docs, str(tmp_path)), f"odd-{name}")
        if name != "pack":
            assert docs.schema == before.schema and 0 < docs.count() <= before.count()
    assert docs.count() > 0 and docs.where("doc_id is null").groupBy().agg(F.sum("length")).first()[0] != 0


@pytest.mark.parametrize("slots", [1, 8, steps.FILTER_SLOTS])
def test_texts_of_ids(spark, monkeypatch, slots):
    monkeypatch.setattr(steps, "FILTER_SLOTS", slots)  # full bits let every text pass to the join
    rows = [*((i, f"text {i}", i) for i in range(500)), (3, "again", 1), (None, "no id", 2), (-7, None, 3)]
    texts = spark.createDataFrame(rows, "doc_id long, text string, slot int")
    ids = spark.createDataFrame([(i,) for i in [*range(0, 400, 3), -7, 9999, None]], "doc_id long")
    got = steps.texts_of(texts, ids)
    assert got.columns == texts.columns
    wanted = {r.doc_id for r in ids.collect()} - {None}
    assert sorted(map(tuple, got.collect()), key=str) == sorted((r for r in rows if r[0] in wanted), key=str)
    assert steps.texts_of(texts, ids.limit(0)).count() == 0


def test_texts_are_filtered_before_they_are_shuffled(spark, capsys):
    texts = spark.range(2000).selectExpr("id AS doc_id", "repeat('x', 50) AS text")
    steps.texts_of(texts, spark.range(10).selectExpr("id AS doc_id")).explain("simple")
    join = capsys.readouterr().out.split("SortMergeJoin")[1]
    text_side = join[: join.rindex("HashAggregate")]
    # the exchange of the texts stands above the join with the filter's bits
    assert -1 < text_side.index("Exchange hashpartitioning(doc_id") < text_side.index("BroadcastHashJoin")


def test_written_alone_leaves_one_table(spark, tmp_path):
    made = []

    def make():
        made.append(materialize(spark.range(5).toDF("a"), "part"))
        return made[0].selectExpr("a + 1 AS b")

    got = steps.written_alone(spark, make, "alone")
    assert sorted(r.b for r in got.collect()) == [1, 2, 3, 4, 5]
    with pytest.raises(Exception):
        made[0].collect()
