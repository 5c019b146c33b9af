"""From raw documents to token files, in five stages.

Every stage works on all rows that the one before it kept, and is written as
Parquet before the next one reads it, so a lost executor costs no more than a stage.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foralytics.llm.common import remainder_of_id, table
from foralytics.llm.decontamination import drop_leaks
from foralytics.llm.jaccard_join import keep_one_of_each
from foralytics.llm.language_id import keep_known
from foralytics.llm.mixing import mix_rows
from foralytics.llm.token_files import token_files
from foralytics.scratch import stage

# The network of the first stage and the tokenizer of the last are beyond SQL.
ORACLE_SQL = None


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; a quarter of the labels is held out."""
    return keep_known(docs, docs.where(remainder_of_id(F.col("doc_id"), 4) != 2))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose 5-word shingles are alike by 0.8."""
    return keep_one_of_each(docs, n=5, num=4, den=5)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources ask for."""
    return mix_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of the ids of every row, read back from the token files."""
    return token_files(docs)


STAGES = [
    ("language identification", known_languages),
    ("near copies", without_near_copies),
    ("benchmark decontamination", without_leaks),
    ("mixing sources", mixed_sources),
    ("token files", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
