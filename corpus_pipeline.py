"""A corpus pipeline of five operators: language, lines, near duplicates, benchmark passages, mixture."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetra.llm import decontam, jaccard, langid, linededup, mixing
from kinetra.llm.common import cut, quoted, table
from kinetra.scratch import clean_up, recorded


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go; null and letterless texts and letter junk are among them."""
    return langid.reject(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a smaller doc_id holds too go; every document stays, its text and n_chars renewed."""
    found = linededup.dedup_lines(docs)
    kept, dropped = F.col(found.columns[-1]), F.col(found.columns[-2])
    new = {"text": F.when(dropped > 0, kept).otherwise(F.col("text")), "n_chars": F.when(dropped > 0, F.length(kept).cast("long")).otherwise(F.col("n_chars"))}
    return found.select(*(new[c].alias(c) if c in new else quoted(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at a similarity of 0.8 in five-word shingles the one with the smallest doc_id stays."""
    return jaccard.keep_one(docs, n=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a row for each time the mix takes a document, numbered in a further column copy."""
    return mixing.mix_documents(docs)


STAGES = [
    ("language", identify_language),
    ("lines", dedup_lines),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mixture", mix_sources),
]

#: The fitted model and the seeded knapsack have no SQL.  tests/llm holds the stages against plain versions, each on its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows.  What a stage read and wrote on its way is deleted once its own rows are written."""
    docs, last = table(spark, sf_dir, "documents"), set()
    for name, stage in STAGES:
        with recorded() as made:
            found = stage(spark, docs, sf_dir)
        with recorded() as own:
            docs = cut(found, name.replace(" ", "-"))
        clean_up(spark, made | last)
        last = own
    return docs
