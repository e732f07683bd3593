"""The corpus pipeline, stage by stage, and the components it needs."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from milepost.llm import language, mixing, ngram_join, queries
from milepost.llm.components import components

SMALL = "/root/testdata/sf0.001"


def test_stages_on_odd_rows(spark, odd_documents, no_documents):
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, odd_documents, SMALL)
        if name != "encoding":
            assert done.columns == odd_documents.columns and done.dtypes == odd_documents.dtypes, name
        done.collect()
        assert stage(spark, no_documents, SMALL).count() == 0, name


def test_stages_keep_columns_with_their_own_names(spark):
    names = ["_id", "_mark", "_text", "_lower", "_letter", "_changed", "_later", "_text_key", "_rank", "score", "n_entities"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(f"own {name} "), F.col("doc_id")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        done = stage(spark, docs, SMALL)
        assert done.dtypes == docs.dtypes, name
        rows = done.collect()
        assert rows and all(r[c] == f"own {c} {r.doc_id}" for r in rows for c in names), name
    assert corpus_pipeline.encode(spark, docs, SMALL).count() == docs.count()


def test_the_key_of_the_tests_is_refused(spark):
    drawn = corpus_pipeline.surrogate_key(spark)
    assert drawn == corpus_pipeline.surrogate_key(spark) and len(drawn) == 64
    spark.conf.set(corpus_pipeline.SECRET, queries.SURROGATE_KEY.decode())
    try:
        with pytest.raises(ValueError):
            corpus_pipeline.surrogate_key(spark)
    finally:
        spark.conf.set(corpus_pipeline.SECRET, drawn.decode())


def test_pipeline_keeps_what_its_stages_keep(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = corpus_pipeline.keep_languages(spark, docs, SMALL)
    judged = language.identify_languages(docs, language.learn_languages(docs)).collect()
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in judged if r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST_SCORE}
    alone = corpus_pipeline.drop_near_duplicates(spark, kept, SMALL)
    classes = ngram_join.similar_classes(kept).collect()
    assert {r.doc_id for r in alone.collect()} == {r.class_id for r in classes}
    hidden = corpus_pipeline.hide_private(spark, alone, SMALL).collect()
    assert all("@mail" not in r.text and r.n_chars == len(r.text) for r in hidden)
    mixed = corpus_pipeline.mix(spark, alone, SMALL).collect()
    times = {r.doc_id: r.taken // r["size"] for r in mixing.mix_sources(alone).collect() if r["size"]}
    assert Counter(r.doc_id for r in mixed) == Counter({d: t for d, t in times.items() if t})
    last = corpus_pipeline.run(spark, SMALL).collect()
    assert last and all(r.n_tokens == len(r.ids) for r in last)


def test_components_against_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(200, 240)] + [(5, 5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {x: find(x) for x in parent}


def test_registered(spark):
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.queries()) <= names and "pipeline" in names
