"""File readers with an explicit schema contract."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.operators.quality import schema_issues
from stratus.profile import TIMESTAMP_FORMAT
from stratus.sources.contract import RAW_CONTRACT
from stratus.sources.records import whole_lines


def _csv_reader(spark: SparkSession, schema: T.StructType | None, timestamp_format: str,
                multi_line: bool, corrupt_column: str | None, mode: str,
                check_headers: bool = False):
    reader = (spark.read.option("header", True)
              .option("timestampFormat", timestamp_format)
              .option("escape", '"')
              .option("multiLine", multi_line)
              .option("mode", mode))
    if schema is not None:
        # With a given schema Spark would ignore every file's header and take
        # columns by position; enforceSchema=false makes each task check the
        # header of each file it reads against the schema (names by position),
        # so a file with other columns fails the read instead of being misread.
        reader = reader.option("enforceSchema", not check_headers)
        if corrupt_column:
            schema = T.StructType(schema.fields + [T.StructField(corrupt_column, T.StringType(), True)])
            reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        reader = reader.schema(schema)
    else:
        # Inference costs an extra pass over the input; only for exploration.
        reader = reader.option("inferSchema", True)
    return reader


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = RAW_CONTRACT,
             timestamp_format: str = TIMESTAMP_FORMAT, multi_line: bool = False,
             corrupt_column: str | None = None, mode: str | None = None,
             validate_schema: bool = True, expected: T.StructType | None = None) -> DataFrame:
    """Scan CSV with a header under a schema contract.

    A record that does not fit the schema fails the read, unless a
    ``corrupt_column`` takes it or another ``mode`` is asked for.
    ``multi_line`` is off by default, so that a file can be split; records that
    hold line breaks in quotes need it, or :func:`scan_csv`, which sets them
    aside. A missing path raises FileNotFoundError; when ``validate_schema`` is
    set, a header that lacks a contract field raises ValueError.
    """
    mode = mode or ("PERMISSIVE" if corrupt_column else "FAILFAST")
    reader = _csv_reader(spark, schema, timestamp_format, multi_line, corrupt_column, mode,
                         check_headers=validate_schema)
    try:
        df = reader.csv(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(path) from exc
        raise
    if validate_schema:
        contract = expected or schema or RAW_CONTRACT
        header = _csv_header(spark, path, multi_line)
        missing = [f.name for f in contract.fields if f.name not in header]
        if missing:
            raise ValueError(f"schema check failed for {path}: missing fields {missing}")
        if schema is None:
            issues = [i[:2] for i in schema_issues(df.schema, contract) if i[1] != "extra"]
            if issues:
                raise ValueError(f"schema check failed for {path}: {issues}")
    return df


def _csv_header(spark: SparkSession, path: str, multi_line: bool) -> list[str]:
    """Column names of the header line, read without scanning the data."""
    probe = (spark.read.option("header", True).option("escape", '"')
             .option("multiLine", multi_line).option("inferSchema", False)
             .option("samplingRatio", 0.0001).csv(path))
    return probe.columns


def read_csv_glob(spark: SparkSession, directory: str, pattern: str = "*.csv",
                  schema: T.StructType | None = RAW_CONTRACT,
                  timestamp_format: str = TIMESTAMP_FORMAT, multi_line: bool = False,
                  validate_schema: bool = True, with_source: bool = False) -> DataFrame:
    """All files under ``directory`` (recursively) whose name matches ``pattern``,
    read as one frame under one contract; optionally with the source file.

    With ``validate_schema`` every file's header is checked against the
    contract as the file is read (on the executors, no extra pass), so one
    file with other columns fails any read of its columns (a bare row count
    parses no columns and is unaffected).
    """
    reader = (_csv_reader(spark, schema, timestamp_format, multi_line, None, "FAILFAST",
                          check_headers=validate_schema)
              .option("pathGlobFilter", pattern).option("recursiveFileLookup", True))
    try:
        df = reader.csv(directory)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(directory) from exc
        raise
    if validate_schema and schema is None:
        issues = [i[:2] for i in schema_issues(df.schema, RAW_CONTRACT) if i[1] != "extra"]
        if issues:
            raise ValueError(f"schema check failed for {directory}: {issues}")
    if with_source:
        df = df.withColumn("source_file", F.col("_metadata.file_path"))
    return df


def scan_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_CONTRACT,
             timestamp_format: str = TIMESTAMP_FORMAT, sep: str = ",",
             join_breaks: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, rejected) of CSV files with a header, read line by line.

    With ``join_breaks`` the lines of a record whose quoted fields hold line
    breaks are put together first (:func:`stratus.sources.records.whole_lines`),
    and the files stay splittable; what is never closed, or too long, is read
    line by line as without it.

    Files stay splittable and no line is lost: every line but one header of each
    file is either a record or in ``rejected`` (line, reason). Reasons: 'blank',
    'header' (a header line again in the same file), 'open_quote'
    (an odd number of quotes, as where a quoted field holds a line break),
    'fields' (too few or too many, as between two such lines) and 'value' (a
    field that is not of its type). A file whose first line is not the header
    of the schema has that line rejected as well, as 'fields' or 'value'.
    """
    header = sep.join(f.name for f in schema.fields)
    quoted = sep.join(f'"{f.name}"' for f in schema.fields)
    text = whole_lines(spark, path) if join_breaks else spark.read.text(path).select(
        F.regexp_replace("value", "\\r$", "").alias("line"), F.col("_metadata.file_path").alias("_file"))
    is_header, is_blank = F.col("line").isin(header, quoted), F.col("line") == ""
    lines = text.where(~is_header & ~is_blank)
    # Header lines are alike, so which of a file's was the first does not matter.
    again = (text.where(is_header).groupBy("_file", "line").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("_file").agg(F.max_by("line", "n").alias("line"), F.sum("n").alias("n"))
             .select("line", F.explode(F.expr("if(n > 1, sequence(2, n), array())"))).select("line", F.lit("header").alias("reason")))
    blank = text.where(is_blank).select("line", F.lit("blank").alias("reason"))
    corrupt = "_corrupt"
    full = T.StructType(schema.fields + [T.StructField(corrupt, T.StringType())])
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt,
               "timestampFormat": timestamp_format, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    # Fields are counted by their separators outside quotes.
    bare = F.regexp_replace("line", '"[^"]*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + len(sep)
    quotes = F.length("line") - F.length(F.replace(F.col("line"), F.lit('"'), F.lit("")))
    parsed = lines.select("line", F.from_csv("line", _ddl(full), options).alias("r"))
    reason = (F.when(quotes % 2 == 1, F.lit("open_quote"))
              .when(fields != len(schema.fields) * len(sep), F.lit("fields"))
              .when(F.col(f"r.{corrupt}").isNotNull(), F.lit("value")))
    marked = parsed.withColumn("reason", reason)
    records = marked.where("reason is null").select(*[F.col("r").getField(f.name).alias(f.name) for f in schema.fields])
    rejected = marked.where("reason is not null").select("line", "reason")
    return records, rejected.unionByName(again).unionByName(blank)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan: column pruning, filter pushdown and partition discovery
    come from the reader."""
    return spark.read.parquet(path)
