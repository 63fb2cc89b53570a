"""Landing-zone readers (JSON lines, CSV) with lineage columns, and landing-format helpers.

Readers declare a schema (no inference pass over 100 TB of text) and keep malformed records in a
``_corrupt_record`` column (PERMISSIVE) instead of failing the batch.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _lineage(df: DataFrame, ingested_at: Column | str | None) -> DataFrame:
    at = F.current_timestamp() if ingested_at is None else (
        F.lit(ingested_at).cast("timestamp") if isinstance(ingested_at, str) else ingested_at)
    return (df.withColumn("_source_file", F.col("_metadata.file_path"))
              .withColumn("_ingested_at", at))


def read_jsonl(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None,
               ingested_at: Column | str | None = None) -> DataFrame:
    """JSON lines -> DataFrame plus ``_source_file`` (from the file metadata column) and ``_ingested_at``.

    With ``schema`` the read is single-pass and malformed lines land in ``_corrupt_record``."""
    r = spark.read.option("mode", "PERMISSIVE")
    if schema is not None:
        if isinstance(schema, str):
            schema = T._parse_datatype_string(schema)
        if "_corrupt_record" not in schema.fieldNames():
            schema = T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", T.StringType())])
        r = r.schema(schema).option("columnNameOfCorruptRecord", "_corrupt_record")
    return _lineage(r.json(path), ingested_at)


def read_csv_strings(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                     ingested_at: Column | str | None = None, multi_line: bool = False) -> DataFrame:
    """CSV with header and ``"`` escape; every column stays a string (Bronze).

    ``columns`` fixes the schema (no header inference job); lineage uses the file's base name. A table whose
    quoted fields hold newlines needs ``multi_line``, which reads each file in one task; others are split."""
    r = (spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
         .option("mode", "PERMISSIVE"))
    if columns is not None:
        r = r.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    df = _lineage(r.csv(path), ingested_at)
    return df.withColumn("_source_file", F.regexp_extract("_source_file", r"([^/]+)$", 1))


#: Landing files are named [source_]table[_dataset].csv.
FILE_NAME = re.compile(r"(?:olist_)?(?P<table>.+?)(?:_dataset)?\.csv$")


def table_name_from_file(path: str) -> str:
    """Landing file name -> table name; a name of another form is the table's name as it is."""
    base = path.rsplit("/", 1)[-1]
    named = FILE_NAME.match(base)
    return named["table"] if named else base


def land_tables(spark: SparkSession, paths: Sequence[str], columns: Mapping[str, Sequence[str]] | None = None,
                ingested_at: Column | str | None = None, multi_line: bool | Collection[str] = True) -> dict[str, DataFrame]:
    """Multi-table landing: one all-string Bronze DataFrame per CSV file, named from the file. Quoted fields may hold
    newlines in all tables (``multi_line``), or only in the tables named: the files of the others are split over tasks."""
    out = {}
    for p in sorted(paths):
        name = table_name_from_file(p)
        lines = multi_line if isinstance(multi_line, bool) else name in multi_line
        out[name] = read_csv_strings(spark, p, (columns or {}).get(name), ingested_at, lines)
    return out


FX_DOC_SCHEMA = "map<string, map<string, double>>"


def flatten_fx(docs: DataFrame, doc_col: str = "rates", base: str = "USD") -> DataFrame:
    """``{date: {currency: rate}}`` JSON documents -> long rows ``(date, base, currency, rate)``:
    ``from_json`` to a nested map and two ``explode`` generators, all inside one stage."""
    m = docs.select(F.explode(F.from_json(doc_col, FX_DOC_SCHEMA)).alias("date", "by_ccy"))
    return m.select(F.col("date"), F.lit(base).alias("base"),
                    F.explode("by_ccy").alias("currency", "rate"))


def completeness(landed: DataFrame, manifest: DataFrame, key: str | Sequence[str],
                 announced: str = "announced") -> DataFrame:
    """Batch completeness: rows landed per batch key vs the announced total from a manifest.

    ``(key..., landed, announced, complete)``; a batch missing on either side is incomplete."""
    keys = [key] if isinstance(key, str) else list(key)
    got = landed.groupBy(*keys).agg(F.count("*").alias("landed"))
    return (got.join(manifest.select(*keys, F.col(announced).alias("announced")), keys, "full")
               .withColumn("landed", F.coalesce("landed", F.lit(0)))
               .withColumn("complete", F.coalesce(F.col("landed") == F.col("announced"), F.lit(False))))
