"""The corpus pipeline: documents that pass the quality classifier, one of each group of copies and near copies,
with surrogates for personal data, packed into sequences.

Defined cases, for every stage and for ``run``: a null text is judged, compared and packed as an empty one; texts of
any length are read whole; of equal texts, repeated rows and rows without an id too, one row stays; ties go to the
largest id among equal texts and to the smallest among near copies; empty tables give empty results; further columns
are kept to the last stage, whatever their names. Ids are whole numbers or null.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.llm import exact_dedup, near_text, packing, pii, quality
from noticelake.llm.common import checkpoint_folder


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_duplicates(docs)


def _near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_text.keep_representatives(docs)


def _private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = next(c for c in (f"mentions_{k}" for k in range(len(docs.columns) + 1)) if c not in docs.columns)
    done = pii.pseudonymise(docs, pii.session_key(spark), found_col=found)
    return done.select(*(F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))


def _pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, added=True).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", _quality),
    ("exact dedup", _exact),
    ("SimHash near-dedup", _near),
    ("PII surrogates", _private),
    ("best-fit packing", _pack),
]

#: SQL can express neither the classifier nor the tokeniser.
ORACLE_SQL = None


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; every result but the last is written to the shared checkpoint folder and read again.

    A stage's files go once the next stage has written its own; the last of them stay, as the result is read from them.
    """
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
            if k:
                _remove(spark, f"{folder}/{k - 1}")
    return docs
