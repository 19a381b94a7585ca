import collections

import pytest
from conftest_llm import rows_of
from pyspark.sql import functions as F

import corpus_pipeline
from fieldtrail.llm import lines, mixing, simhash, toxicity
from fieldtrail.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_against_sql(spark, oracle, small, name):
    from compare import differences

    assert differences(QUERIES[name](spark, small), oracle, ORACLE_SQL[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_covers_its_table(spark, small, name):
    made = QUERIES[name](spark, small)
    # These have rows of their own: neighbours, findings, words.
    other = {"op9_nearest": None, "op10_secrets": None, "op12_spelling": None}
    whole = ({"op4_html": "pages"} | other).get(name, "documents")
    count = made.count()
    if name == "op1_pack":
        made = made.where("piece = 0")
    if whole:
        assert made.count() == spark.read.parquet(f"{small}/{whole}.parquet").count()
    assert count > 0


def test_stages_one_after_the_other(spark, small, tmp_path):
    """Each stage against what its operator says of the stage before it."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    kept = [docs]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept[-1], small).write.parquet(f"{tmp_path}/{i}")
        kept.append(spark.read.parquet(f"{tmp_path}/{i}"))
        if i < 4:
            assert kept[-1].columns == docs.columns, name
    ids = [sorted(r.doc_id for r in rows_of(k.select("doc_id"))) for k in kept]
    judged = rows_of(toxicity.toxicity(docs, labels).where("predicted = 0").select("doc_id"))
    assert ids[1] == sorted(r.doc_id for r in judged)
    want = {r.doc_id: r.text for r in rows_of(lines.dedup_lines(kept[1]))}
    assert {r.doc_id: r.text for r in rows_of(kept[2])} == want
    groups = rows_of(simhash.near_groups(kept[2]))
    assert ids[3] == sorted({r.component_id for r in groups})
    taken = {r.doc_id: r.taken for r in rows_of(mixing.mix_plan(kept[3])) if r.taken}
    mixed = collections.Counter()
    for r in rows_of(kept[4].select("doc_id", "text")):
        mixed[r.doc_id] += len((r.text or "").encode().split())
    assert {i: n for i, n in mixed.items() if n} == taken
    whole = collections.Counter(ids[4])
    assert collections.Counter(r.doc_id for r in rows_of(kept[5].where("piece = 0").select("doc_id"))) == whole
    filled = kept[5].groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert filled.where("n <> end or n > 2048").count() == 0


def test_run_is_the_stages(spark, small):
    assert corpus_pipeline.run(spark, small).columns[:3] == ["doc_id", "piece", "start"]
