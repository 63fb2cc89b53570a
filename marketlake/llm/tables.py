"""Written intermediate tables: lineage is cut on shared storage, and shuffles are freed once they were read."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.session import shared_scratch, shuffles_freed

def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, as a Parquet table under ``spark.checkpoint.dir`` (shared by all executors)."""
    spark = df.sparkSession
    path = shared_scratch(spark, f"llm/{name}-{uuid.uuid4().hex}")
    with shuffles_freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def gathered(dfs: Iterable[DataFrame], name: str) -> DataFrame:
    """The rows of all ``dfs`` (one or more of one schema) as one such table, computed one after another: what one leaves
    in shuffles is freed before the next."""
    path = ""
    for df in dfs:
        path = path or shared_scratch(df.sparkSession, f"llm/{name}-{uuid.uuid4().hex}")
        with shuffles_freed(df.sparkSession):
            df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`written` that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def slim(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Only the key and the text, under fixed names, whatever else the table carries."""
    return docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
