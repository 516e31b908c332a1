"""The pipeline on planted cases, stage by stage."""

from __future__ import annotations

import pytest

import __spark_entry__
import corpus_pipeline
from retail_strata.llm.queries import ORACLE_SQL, QUERIES


@pytest.fixture
def tables(spark, documents, prose, tmp_path):
    item = prose(70, 30)
    shared = " ".join(f"{prose(80 + k, 12)}." for k in range(5))
    rows = [(k, prose(k, 60)) for k in range(40)]
    rows += [(k, prose(k, 60) + " idiot moron idiot") for k in range(40, 70)]
    rows += [(100, prose(1, 60)), (101, prose(2, 60) + " more"), (102, prose(200, 40) + " " + item)]
    rows += [(103, prose(201, 40) + ".\n" + shared), (104, prose(202, 40) + ".\n" + shared)]
    rows += [(105, None), (106, ""), (107, prose(3, 60)), (107, prose(3, 60))]
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(k, 1, int(40 <= k)) for k in range(70)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    return str(tmp_path)


def test_each_stage_takes_effect(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(stage(spark, docs, tables), name)
        kept.append({r[0] for r in docs.select("doc_id").collect()})
        if name != "bpe":
            assert docs.columns == columns
    toxic, near, cut, clean, encoded = kept
    assert toxic == {*range(40), *range(100, 108)}
    assert near == toxic - {100, 101, 107}
    assert cut == near and clean == near - {102} and encoded == clean
    tokens = {r.doc_id: r.n_tokens for r in docs.collect()}
    assert tokens[105] == tokens[106] == 0
    assert tokens[104] < tokens[103] - 20


def test_run_is_the_stages(spark, tables):
    assert corpus_pipeline.run(spark, tables).count() == 44


def test_registered():
    found = __spark_entry__.queries()
    assert "pipeline" in found and len([q for q in found if q.startswith("op")]) == len(QUERIES) == 13
    assert ORACLE_SQL.keys() <= __spark_entry__.oracle_sql().keys()
