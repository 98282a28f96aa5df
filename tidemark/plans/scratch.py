"""Intermediate tables in the shared folder.

A written table cuts the lineage, survives the loss of executors and can be read
again with fewer columns, which a row checkpoint cannot.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tidemark.session import shared_dir


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a DataFrame that reads the written table."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
