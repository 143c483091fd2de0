"""The corpus pipeline: quality, repeated lines, near duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet to the shared folder and
reads again as the next stage's documents. All stages but the last return the columns of the documents; a
column ``n_chars`` follows the text where a stage changes it.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logvigil.llm.common import stored, work_folder
from logvigil.llm.line_dedup import line_dedup
from logvigil.llm.packing import pack
from logvigil.llm.pii import personal_data
from logvigil.llm.quality import THRESHOLD, quality_scores, train
from logvigil.llm.simhash import kept_documents


def _columns(docs: DataFrame, text: Column | None = None) -> list[Column]:
    """The columns of ``docs`` out of the column ``doc``, with a new text if given."""
    out = []
    for name in docs.columns:
        column = F.col(f"doc.`{name}`")
        if text is not None and name == "text":
            column = text
        elif text is not None and name == "n_chars":
            column = F.length(text).cast(docs.schema[name].dataType)
        out.append(column.alias(name))
    return out


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; the model learns from labels outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality_scores(docs, train(docs, labels, "quality"))
    return scored.filter(F.col("score") >= THRESHOLD).select(*_columns(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the later occurrences of passages of three or more lines."""
    return line_dedup(docs).select(*_columns(docs, F.col("text")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, the one with the smallest id."""
    return kept_documents(docs).select(*_columns(docs))


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with [KIND] in place of personal data."""
    text = F.coalesce(F.col("redacted"), F.col("doc.text"))
    return personal_data(docs).select(*_columns(docs, text))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of windows of tokens."""
    return pack(docs)


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("privacy", privacy),
    ("packing", packing),
]

#: Classifier votes, a random field and a tokenizer can't be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage, over all of ``documents``."""
    folder = work_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), folder, name)
    return docs
