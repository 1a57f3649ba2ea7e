"""The corpus pipeline: stages over documents, each written and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import jaccard_join, language_id, line_dedup, mixture_packing, secret_scan
from quern.llm.common import held_out, prepare, table, written
from quern.llm.queries import WORD_MODEL

#: How far the best language must lead for a document to stay.
LEAD = 0.1


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those undetermined or ambiguous go.

    Learns from labelled rows outside the fold that op3_language_id holds out.
    """
    model = language_id.fit(docs.where(~held_out("doc_id", 4)))
    said = language_id.identify(docs, model, LEAD)
    return said.where((F.col("lang_pred") != language_id.UNDETERMINED) & ~F.col("ambiguous")).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated chunks of lines; a document of which nothing is left goes."""
    made = line_dedup.dedup_lines(docs)
    return made.where("NOT (n_removed > 0 AND trim(BOTH '\n' FROM text) = '')").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group of near duplicates; repeated rows stay once, rows without id all."""
    found = jaccard_join.jaccard_components(docs).where("component_id = doc_id").select("doc_id").distinct()
    kept = docs.join(found, "doc_id", "left_semi").distinct()
    return kept.unionByName(docs.where("doc_id IS NULL")).select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret replaced by a mark; all documents stay."""
    return secret_scan.redact(secret_scan.scan(docs, secret_scan.fit(docs))).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, in sequences of 2048 ids, each with the corpus's own mix of sources."""
    return mixture_packing.pack(docs, WORD_MODEL)


STAGES = [
    ("language ID", language),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secrets),
    ("packing", packing),
]

#: SQL has no trained models, reachability or tokenizers; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
