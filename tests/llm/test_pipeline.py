"""The corpus pipeline on the smallest documents, and the queries' SQL."""

import collections

import duckdb
import pytest

import corpus_pipeline
from tidemark.llm import mixing
from tidemark.llm.mixing import mix_sources
from tidemark.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_stages_keep_and_change_what_they_should(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").cache()
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF_DIR).cache()
        assert after.columns == docs.columns
        if name == "language":
            assert after.count() >= 0.97 * docs.count()
        elif name == "near_duplicates":
            assert after.select("doc_id").distinct().count() == after.count() < before.count()
        elif name == "personal_data":
            assert after.count() == before.count()
            assert after.where("text rlike '[a-z0-9]@[a-z0-9-]+[.][a-z]'").isEmpty()
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, SF_DIR)
    assert pieces.groupBy("doc_id").agg({"length": "sum"}).count() == before.select("doc_id").distinct().count()


FOREIGN = [
    "Litwo! Ojczyzno moja! ty jesteś jak zdrowie. Ile cię trzeba cenić, ten tylko się dowie, kto cię stracił. Dziś piękność twą w całej ozdobie widzę.",
    "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。何でも薄暗いじめじめした所でニャーニャー泣いていた事だけは記憶している。",
    "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему. Все смешалось в доме Облонских.",
    "asdkjh qwlekj zxmcn asdlkj qpwoei zmxncb alskdj qwoeiu zxmnc laksjd qpwoeu zmxnc alsjdh qwpeo zxmcnb aslkdj qwpoei zmxcn",
]


def test_foreign_texts_go_and_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    foreign = spark.createDataFrame([(-i, t, None, "s", len(t)) for i, t in enumerate(FOREIGN, 1)], docs.schema)
    short = spark.createDataFrame([(-9, "zq xw", None, "s", 5), (-10, None, None, None, None), (-11, "123 ...", None, None, 7)], docs.schema)
    kept = corpus_pipeline.known_language(spark, docs.unionByName(foreign).unionByName(short), "").select("doc_id").collect()
    ids = {r[0] for r in kept}
    assert {i for i in ids if i < 0} == {-9}
    assert len(ids) - 1 >= 0.99 * docs.where("text rlike '[a-zA-Z]'").count()


def test_rows_that_share_an_id_go_only_as_near_duplicates(spark):
    one, two, three = (" ".join(f"{p}{i}" for i in range(60)) for p in "abc")
    rows = [(1, one), (1, two), (2, one), (None, two), (None, three), (None, None), (5, None), (6, ""), (7, one + " tail")]
    docs = spark.createDataFrame([(i, t, "de", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.without_near_duplicates(spark, docs.repartition(3), "").collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted([(1, one), (1, two), (None, three), (None, None), (5, None), (6, "")], key=str)


def test_unmasked_texts_do_not_stay_in_the_shared_folder(spark):
    from tidemark.session import checkpoint_folder
    from tidemark.sources.files import child_names

    folder = checkpoint_folder(spark)
    before = set(child_names(spark, folder))
    pieces = corpus_pipeline.run(spark, SF_DIR)
    new = set(child_names(spark, folder)) - before
    assert len(new) == 1 and pieces.count() > 0
    left = spark.read.parquet(f"{folder}/{new.pop()}")
    assert left.where("text rlike '[a-z0-9]@[a-z0-9-]+[.][a-z]'").isEmpty()


def test_the_pipeline_on_an_empty_table(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_mixing_keeps_rows_without_or_with_repeated_ids(spark):
    rows = [(None if i % 3 == 0 else i // 2, "w " * (1 + i % 7), "de", ("a", "b", "c")[i // 200], 2) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5).cache()
    mixed = corpus_pipeline.mixed_sources(spark, docs, SF_DIR).collect()
    taken = collections.Counter()
    for r in mixed:
        taken[r["source"]] += len(r["text"].split())
    targets = {r["source"]: r["target"] for r in mix_sources(docs).select("source", "target").distinct().collect()}
    assert all(abs(taken[s] - targets[s]) <= 7 / 2 + 1 for s in "abc")
    assert any(r["doc_id"] is None for r in mixed)
    assert sorted(map(str, mixed)) == sorted(map(str, corpus_pipeline.mixed_sources(spark, docs.repartition(3), SF_DIR).collect()))


def test_mixing_deals_alike_rows_over_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([(None, "a b c", "s" if i % 9 else "t") for i in range(900)], "doc_id long, text string, source string")
    largest = []
    fold = mixing._fold

    def watched(units):
        largest.append(units.groupBy("source", "block").count().agg({"count": "max"}).first()[0])
        return fold(units)

    monkeypatch.setattr(mixing, "_fold", watched)
    assert mix_sources(docs, block=30).count() == 900
    assert max(n for n in largest if n) < 100


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    result = connection.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    ours = QUERIES[name](spark, SF_DIR).select(*columns).collect()
    assert sorted(map(tuple, ours)) == sorted(result.fetchall())


def test_every_operator_is_registered():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
