"""A corpus pipeline of five stages: each takes (spark, docs, sf_dir) and returns a DataFrame.

All but the last keep the columns of `documents`. Each stage's rows are written as Parquet and
read again as the next one's docs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions.scratch import Scratch
from sievework.llm import decontaminate, line_dedup, near_dedup, packing, toxicity
from sievework.llm.common import carried, released, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go."""
    usable = ~toxicity.held_out(F.col("doc_id"))
    scored = toxicity.score_toxicity(carried(docs, "doc_id", "text"), table(spark, sf_dir, "labels"), usable=usable)
    return released(scored.where("predicted = 0"), docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, without the lines that larger ids repeat; its size is counted anew where there is an n_chars."""
    out = line_dedup.dedup_lines(carried(docs, "doc_id", "text"))
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast(dict(docs.dtypes).get("n_chars", "long"))}
    changed = [c for c in docs.columns if c in new]
    return out.select(*((new[c] if c in changed else F.col("carried").getField(c)).alias(c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays; documents without an id do."""
    classes = near_dedup.near_duplicates(docs)
    gone = classes.where("not kept").select("doc_id").distinct()
    return released(carried(docs, "doc_id").join(gone.hint("shuffle_hash"), "doc_id", "left_anti"), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    found = decontaminate.decontaminate(carried(docs, "text"), table(spark, sf_dir, "benchmark"))
    return released(found.where("not contaminated"), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their token ids, in sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: SQL can express neither the fitted score nor the packing.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        if k:
            scratch.drop(STAGES[k - 1][0])
    return docs
