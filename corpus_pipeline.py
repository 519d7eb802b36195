"""A corpus pipeline: quality rules, line dedup, near-copies, source mix, BPE tokens.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; all but the last return the
columns of ``documents``. Between stages the rows are written as Parquet below ``spark.checkpoint.dir``.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import bpe, line_dedup, mixing, quality_rules
from lakeops.llm import near_copies as copies
from lakeops.llm.queries import tokenizer
from lakeops.session import ensure_checkpoint_dir, load_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a risk-controlled cutoff rejects go."""
    return quality_rules.keep_good(docs, load_table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line runs that stand earlier go; a document of which no word is left goes as a whole.

    ``n_chars``, where there is such a column, follows the text.
    """
    done = line_dedup.without_repeats(docs)
    done = done.where((F.col("n_removed") == 0) | F.col("kept").rlike(r"[^\x20\x09-\x0D]"))
    fresh = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        fresh["n_chars"] = F.when(F.col("n_removed") == 0, F.col("row")["n_chars"]).otherwise(
            F.length("kept")).cast(docs.schema["n_chars"].dataType)
    return done.select(*[fresh[c].alias(c) if c in fresh else F.col("row")[c].alias(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, likeness 0.8) stays, the one with the smallest id."""
    return copies.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources holds it."""
    return mixing.mixture(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE ids of every text and the digests of the ids and of the text they decode to."""
    return bpe.sealed(docs, tokenizer("word_bpe_49k.json"), keep=[c for c in docs.columns if c != "text"])


STAGES = [("quality", quality), ("lines", lines), ("near_copies", near_copies), ("mix", mix), ("tokens", tokens)]

#: calibrated cutoffs, a prefix join and BPE have no SQL twin; the tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table ``documents``; each one's rows are written and read again."""
    docs = load_table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
