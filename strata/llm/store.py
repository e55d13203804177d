"""Tables written between steps, in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import MAX_SHUFFLE_PARTITIONS, SHUFFLE_PARTITIONS, scratch_path, ship_package

# Stored bytes of whole texts that one Python worker takes, together with what it keeps of them.
PART_BYTES = 64 * 1024 * 1024
# Above this Spark does not know a size.
_UNKNOWN = 1 << 60


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a step's rows below ``spark.checkpoint.dir`` and read them back.

    Later steps then start from files: lost executors repeat one step only, and nothing is computed twice.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts_for(df: DataFrame, part_bytes: int = PART_BYTES) -> int:
    """Into how many parts to deal rows out: as many as the stored bytes of ``df`` call for, the session's number at least."""
    spark = df.sparkSession
    usual = int(spark.conf.get(SHUFFLE_PARTITIONS))
    stored = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return usual if stored > _UNKNOWN else min(max(usual, -(-stored // part_bytes)), MAX_SHUFFLE_PARTITIONS)


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and whole text under fixed names, so that clashing extra columns do not matter."""
    ship_package(docs.sparkSession)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
