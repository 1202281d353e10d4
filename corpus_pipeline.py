"""The corpus pipeline: toxicity, line dedup, near-dedup, benchmark decontamination, best-fit packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm import decontam, line_dedup, near_dedup, packing, toxicity
from rillstone.llm._common import save, table
from rillstone.llm.queries import MIN_LINE_DOCS, MIN_LINE_LENGTH, VOCABULARY

#: Documents with this score or more are rejected.
TOXIC_FROM = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below TOXIC_FROM, learnt from all labels. Texts are judged, so null and repeated ids are
    kept or rejected row by row; null and empty texts take the label rate and stay; all columns are kept."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_rows(docs, model)
    return scored.filter(F.col("score") < TOXIC_FROM).select("row.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them repeat; null texts and texts that become empty stay as empty ones.
    All columns are kept, of any name; n_chars, where there is one, follows the text."""
    done = line_dedup.without_repeated_lines(docs, min_docs=MIN_LINE_DOCS, min_length=MIN_LINE_LENGTH)
    return done.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else done


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one with the smallest id (null last; ties: the smallest text key).
    Rows that repeat leave one; texts without words are alike only when they are equal; all columns are kept."""
    return near_dedup.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item, items of one word to any length; null texts contain none. Texts decide, so
    null and repeated ids are treated row by row; all columns are kept."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all remaining documents with their sequence and offset, whatever other columns there are; null and
    empty texts are a piece of the end id alone, repeated rows are packed each."""
    return packing.pack_documents(docs, VOCABULARY)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("minhash_near_dedup", drop_near_copies), ("benchmark_decontamination", drop_benchmark), ("best_fit_packing", pack)]
#: No SQL here fits a classifier, bands signatures or tokenises; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
