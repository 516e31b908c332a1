"""A corpus pipeline: each stage works on all rows that its predecessor kept.

``run`` writes each stage's rows to the shared scratch folder and reads them back for the next.

In every stage null and empty texts are kept, null ids are ids like others, texts are read whole at
any length, and repeated rows stand or fall together; an empty table gives an empty table. Columns
besides ``doc_id`` and ``text`` are carried along whatever their names, ``n_chars`` follows the
text where there is one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_strata.llm import bpe, decontaminate, partenum, substring_dedup, toxicity
from retail_strata.llm.common import read_table, ship, stage

TOKENIZER = "word_bpe_49k.json"
#: A name that no column of the documents has.
OTHER = "__doc_id_of_the_other_side"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from this stage's own rows.

    Without labels nothing is learned and all stay. Null and empty texts are scored by the model's
    constant term.
    """
    ship(spark)
    labels = read_table(spark, sf_dir, "labels")
    scorer = toxicity.train(docs, "doc_id", "text", labels, "doc_id", "toxic")
    return toxicity.reject_toxic(docs, "text", scorer)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents joined by near-duplicate links, the one with the least id stays.

    Texts without words link with nothing and stay. Rows of one id with equal texts become one row,
    and those with other texts stay if the id does. A null id goes where its text has another.
    """
    ship(spark)
    found = stage(partenum.jaccard_components(docs, "doc_id", "text"), "components")
    others = found.where("component_id <> doc_id").select(F.col("doc_id").alias(OTHER)).distinct()
    kept = docs.join(others, docs["doc_id"].eqNullSafe(others[OTHER]), "left_anti")
    counts = found.groupBy(F.col("doc_id").alias(OTHER)).count().where("count > 1").select(OTHER)
    repeated = stage(counts, "repeated-ids")
    same = kept["doc_id"].eqNullSafe(repeated[OTHER])
    once = kept.join(repeated, same, "left_anti")
    return once.unionByName(
        kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"])
    )


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out; every document stays.

    A text may become empty, a null one stays null. A null id ranks last.
    """
    ship(spark)
    repeats = stage(substring_dedup.find_repeats(docs, "doc_id", "text"), "repeats")
    cut = substring_dedup.remove(docs, "doc_id", "text", repeats)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, with all rows of their id; a null id is one id."""
    ship(spark)
    benchmark = read_table(spark, sf_dir, "benchmark")
    leaks = decontaminate.find_leaks(docs, "doc_id", "text", benchmark, "item_id", "text")
    return decontaminate.drop_leaked(docs, "doc_id", stage(leaks, "leaks"))


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text; null texts have no tokens."""
    ship(spark)
    return bpe.digests(docs, "doc_id", "text", public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", keep_one_of_each_group),
    ("substring_dedup", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("bpe", encode_documents),
]

#: Models, hashes of shingles and merges of a tokenizer are not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
