"""Tables in and out: CSV, JSON, JSON lines, Parquet, workbooks as ZIP, manifests and one-page reports."""

from __future__ import annotations

import json
import re
import zipfile
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A CSV with a header; ``NA`` is a value, an empty field is null, a byte order mark is skipped."""
    reader = spark.read.option("header", True).option("encoding", "UTF-8").option("multiLine", True).option("escape", '"')
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str, optional: bool = False) -> DataFrame:
    """A JSON array file; an optional one that is missing, or whose text does not parse, is an empty table."""
    reader = spark.read.option("multiLine", True)
    if not optional:
        return reader.schema(schema).json(path)
    try:
        files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.get_json_object("value", "$").isNotNull().alias("sound"))
        sound = [r["path"] for r in files.where("sound").select("path").collect()]
    except AnalysisException:
        sound = []
    return reader.schema(schema).json(sound) if sound else spark.createDataFrame([], schema)


def read_cache(spark: SparkSession, path: str, schema: StructType | str, key: str, order: str) -> DataFrame:
    """JSON lines keyed by ``key``; of several lines the last by ``order`` counts."""
    rows = spark.read.schema(schema).json(path)
    last = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))
    return rows.withColumn("__n", last).where("__n = 1").drop("__n")


def read_register(spark: SparkSession, path: str) -> DataFrame:
    """A register kept as CSV or Parquet."""
    return spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else read_csv(spark, path)


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, single: bool = False) -> None:
    """Columns in a fixed order; one file only where a person reads it."""
    out = df.select(*(columns or df.columns))
    (out.coalesce(1) if single else out).write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines; nulls are written."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_once(df: DataFrame, path: str) -> None:
    """A snapshot that is never overwritten."""
    df.write.mode("ignore").parquet(path)


def write_served(df: DataFrame, table: str, by: str, buckets: int = 16) -> None:
    """A table for point lookups: bucketed and sorted by the column it is asked for."""
    df.write.mode("overwrite").bucketBy(buckets, by).sortBy(by).saveAsTable(table)


def append_new(df: DataFrame, path: str, keys: list[str]) -> None:
    """Appends the rows whose keys the table at ``path`` lacks: a restart goes on where the last run stopped."""
    spark = df.sparkSession
    try:
        df = df.join(spark.read.parquet(path).select(*keys), keys, "left_anti")
    except AnalysisException:
        pass  # the first run has nothing to skip
    df.write.mode("append").parquet(path)


def manifest(df: DataFrame, groups: list[str], **extra: str) -> str:
    """A lineage document: row count, counts by group, a digest of the rows that does not depend on their order, and whatever is added."""
    digest = F.sum(F.xxhash64(*(F.col(c) for c in df.columns)).cast("decimal(38,0)"))
    total, mixed = df.agg(F.count("*"), digest).first()
    counts = {g: {str(r[0]): r[1] for r in df.groupBy(g).count().orderBy(g).collect()} for g in groups}
    return json.dumps({"rows": total, "digest": str(mixed), "counts": counts, **extra}, ensure_ascii=False, sort_keys=True)


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256) of the files under ``path``, of at most 2 GB each."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.sha2("content", 256).alias("sha256"))


def probe_workbook(path: str) -> dict:
    """Whether an XLSX is sound: its sheet names, rows of each sheet and formula errors, read as ZIP and XML."""
    with zipfile.ZipFile(path) as archive:
        broken = archive.testzip()
        book = archive.read("xl/workbook.xml").decode()
        sheets = {n: archive.read(n).decode() for n in archive.namelist() if re.fullmatch(r"xl/worksheets/[^/]+\.xml", n)}
    return {
        "broken": broken,
        "sheets": re.findall(r'<sheet [^>]*name="([^"]*)"', book),
        "rows": {n: len(re.findall(r"<row[ >]", x)) for n, x in sheets.items()},
        "errors": sum(len(re.findall(r"#(?:REF!|DIV/0!|VALUE!|NAME\?|N/A)", x)) for x in sheets.values()),
    }


def workbook_tables(summary: DataFrame, pairs: DataFrame, clusters: DataFrame, members: DataFrame, parameters: dict[str, object]) -> dict[str, DataFrame]:
    """The sheets of the result workbook as tables, in order."""
    spark = summary.sparkSession
    known = spark.createDataFrame([(k, str(v)) for k, v in parameters.items()], "parameter string, nilai string")
    return {"Ringkasan": summary, "Pair Relationship": pairs, "Cluster": clusters, "Cluster Members": members, "Parameter dan Batas": known}


def report_page(title: str, summary: DataFrame, limit: int = 5000) -> str:
    """A page with the summary as data; at most ``limit`` rows, as a page is for reading."""
    rows = [json.loads(x[0]) for x in summary.limit(limit).select(F.to_json(F.struct("*"))).collect()]
    payload = json.dumps(rows, ensure_ascii=False).replace("<", "\\u003c")
    return f'<!doctype html><meta charset="utf-8"><title>{title}</title><pre id="out"></pre><script>const rows = {payload}; document.getElementById("out").textContent = rows.map(r => JSON.stringify(r)).join("\\n");</script>'


def save_text(text: str, path: str) -> None:
    Path(path).write_text(text, encoding="utf-8")
