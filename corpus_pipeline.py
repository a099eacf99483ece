"""The training-data pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of ``documents``:

1. toxicity: documents that score 0.7 or more go;
2. near copies: of each class of (near) copies the document with the smallest id stays;
3. decontamination: documents that hold a phrase of the benchmark go;
4. mixing: sources are brought to their target weights; a document may be taken twice;
5. token files: the texts as token ids, read back from the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from isotherm.llm import fm_index, mixing, near_copies, token_files, toxicity
from isotherm.llm.common import bucket_of_id, scratch_table, table
from isotherm.llm.queries import VOCABULARY
from isotherm.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").filter(bucket_of_id("doc_id", 3) != 1)
    return toxicity.reject_toxic(docs, toxicity.learn_toxicity(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.one_of_each_class(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return fm_index.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_rows(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(docs, path, VOCABULARY)
    return token_files.read_tokens(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_files", write_token_files),
]

# The stages' models, samples and token ids are beyond SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the token files."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
