"""File sinks that keep every value and check what they wrote before it counts.

Each write is one job into a folder beside its target. The row count and an
order-free checksum of what was written are collected by an ``Observation``
riding on that same job; the new files alone are then scanned once under the
options they were written with. A difference raises :class:`VerificationError`
and leaves the target as it was; else the files are moved into place: the whole
folder (overwrite), the partition directories that the frame has (dynamic
overwrite) or each file (append). ``verify=False`` leaves the check to the caller.
"""

from __future__ import annotations

import os
import warnings
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.functions.exprs import row_checksum
from stratus.session import shared_dir
from stratus.sinks import paths

# Text formats of both directions: microseconds are kept.
TIME_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
# One quoting rule on both sides (a quote is doubled), blanks kept.
CSV_OPTIONS = {"quote": '"', "escape": '"', "lineSep": "\n", "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false", **TIME_OPTIONS}

# The reader's name for a field that is empty and not quoted, so that it is told
# apart from a quoted empty text. It is never written.
CSV_NULL = "\x01null"

# Of the compressed text files of a fan-out: one task reads a whole file.
RECORDS_PER_FILE = 500_000


class VerificationError(RuntimeError):
    """The files do not hold what was written."""


@dataclass
class WriteResult:
    """What a write left: where, how to read it, and what must be found there.

    ``options`` are those the files must be read with. ``only``: the directories
    or files of a dynamic overwrite or an append; the check reads these alone.
    """

    path: str
    fmt: str
    schema: T.StructType
    expected_rows: int
    expected_checksum: object
    partition_by: tuple[str, ...] = ()
    metrics: dict | None = None
    options: dict = field(default_factory=dict)
    only: tuple[str, ...] | None = None

    def verification(self, spark: SparkSession) -> DataFrame:
        """expected_rows, actual_rows, expected_columns, actual_columns,
        checksum_match, valid: one scan of the written files."""
        back = read_back(spark, self)
        cols = [f.name for f in self.schema.fields]
        row = back.agg(F.count(F.lit(1)).alias("actual_rows"), _checksum(cols).alias("_sum"))
        expected_sum = F.lit(self.expected_checksum).cast("decimal(38,0)")
        out = row.select(
            F.lit(self.expected_rows).cast("long").alias("expected_rows"),
            F.col("actual_rows"),
            F.lit(len(cols)).alias("expected_columns"),
            F.lit(len(back.columns)).alias("actual_columns"),
            (F.col("_sum") == expected_sum).alias("checksum_match"))
        return out.withColumn("valid", (F.col("expected_rows") == F.col("actual_rows"))
                              & (F.col("expected_columns") == F.col("actual_columns"))
                              & F.col("checksum_match"))

    def check(self, spark: SparkSession) -> WriteResult:
        """Verify now; raise VerificationError on any difference."""
        found = self.verification(spark).first()
        if not found["valid"]:
            raise VerificationError(f"{self.fmt} at {self.path}: {found.asDict()}")
        return self


def _checksum(cols: list[str]) -> Column:
    return F.coalesce(F.sum(row_checksum(cols)), F.lit(0).cast("decimal(30,0)"))


def _observed(df: DataFrame, name: str,
              metrics: dict[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """``df`` with an Observation of its row count, order-free checksum and
    any caller ``metrics`` (aggregate expressions). The node sits at the top
    of the written plan, so it runs in the write's result stage, where Spark
    applies each task's update once even when tasks or stages are re-run."""
    obs = Observation(name)
    extra = [agg.alias(f"m_{k}") for k, agg in (metrics or {}).items()]
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), _checksum(df.columns).alias("checksum"),
                      *extra), obs


def _prepared(df: DataFrame, rebalance: bool | None, partition_by=(), sort_by=()) -> DataFrame:
    """The frame as it is written.

    ``sort_by``: files in that order, one after another, over the whole output
    (within each directory of a partitioned write). Else ``rebalance=None``
    (default): a partitioned write is rebalanced on its partition columns, so
    each directory's rows come from few tasks (not every task writing a small
    file into every directory) and AQE splits a directory holding a large share
    of the rows; an unpartitioned write adds no exchange, its files follow the
    scan splits or the final stage that AQE has already coalesced. ``True``
    forces a plain rebalance (AQE sizes the files), ``False`` never adds one.
    """
    if sort_by:
        return df.orderBy(*partition_by, *sort_by)
    if rebalance is None:
        return df.hint("rebalance", *partition_by) if partition_by else df
    return df.hint("rebalance", *partition_by) if rebalance else df


def _write(df: DataFrame, path: str, fmt: str, write_options: dict, read_options: dict, mode: str,
           prepared: DataFrame, metrics: dict | None, verify: bool | WriteResult, partition_by=(),
           dynamic: bool = False) -> WriteResult:
    """``verify``: hold the files against what this write observed, or against another
    write's observation; False writes an overwrite straight to its target."""
    spark, metrics, path = df.sparkSession, dict(metrics or {}), path.rstrip("/")
    if mode not in ("overwrite", "append", "errorifexists", "error"):
        raise ValueError(f"mode must be 'overwrite', 'append' or 'errorifexists', got {mode!r}")
    if dynamic and mode != "overwrite":
        raise ValueError("dynamic partitions are for mode 'overwrite'")
    if mode in ("errorifexists", "error") and paths.exists(spark, path):
        raise FileExistsError(path)
    dynamic = dynamic and bool(partition_by)
    parts = dynamic or mode == "append"
    staged = verify is not False or parts
    own = {}
    if fmt == "csv":  # a record of several lines must be read by one task; most outputs have none
        texts = [F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        breaks = F.lit(False)
        for c in texts:
            breaks = breaks | F.coalesce(c.rlike("[\\r\\n]"), F.lit(False))
        own["breaks"] = F.count_if(breaks)
    observed, obs = _observed(prepared, fmt, {**metrics, **own})
    target = paths.beside(path, "new") if staged else path
    writer = observed.write.mode("overwrite").options(**write_options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(fmt).save(target)
    got = obs.get
    if got.get("m_breaks"):
        read_options = {**read_options, "multiLine": "true"}
    result = WriteResult(target, fmt, df.schema, int(got["rows"]), got["checksum"], tuple(partition_by),
                         {k: got[f"m_{k}"] for k in metrics}, read_options)
    if isinstance(verify, WriteResult):
        result.expected_rows, result.expected_checksum, result.metrics = (
            verify.expected_rows, verify.expected_checksum, verify.metrics)
    if not staged:
        return result
    try:
        if verify is not False:
            result.check(spark)
        if parts:
            result.only = _into_place(spark, target, path, whole_folders=dynamic)
        else:
            paths.replace(spark, target, path)
    finally:
        paths.remove(spark, target)
    result.path = path
    return result


def _into_place(spark: SparkSession, source: str, target: str, whole_folders: bool) -> tuple[str, ...]:
    """Move the files of ``source`` to the same folders of ``target``, replacing these
    folders or beside what is there; returns what was moved, by its new place."""
    moved = []
    for folder, names in sorted(paths.data_files(spark, source).items()):
        if whole_folders and folder:
            paths.replace(spark, f"{source}/{folder}", f"{target}/{folder}")
            moved.append(f"{target}/{folder}")
            continue
        for name in names:
            place = f"{target}/{folder}/{name}" if folder else f"{target}/{name}"
            paths.move(spark, f"{source}/{folder}/{name}" if folder else f"{source}/{name}", place)
            moved.append(place)
    return tuple(moved)


def _file_options(compression: str | None, max_records_per_file: int | None) -> dict[str, str]:
    options = {"compression": compression} if compression else {}
    return {**options, "maxRecordsPerFile": str(max_records_per_file)} if max_records_per_file else options


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  compression: str = "snappy", mode: str = "overwrite",
                  dynamic_partitions: bool = False, rebalance: bool | None = None,
                  max_records_per_file: int | None = None,
                  metrics: dict[str, Column] | None = None, sort_by: tuple[str, ...] = (),
                  verify: bool | WriteResult = True) -> WriteResult:
    """Write Parquet (optionally hive-partitioned). ``dynamic_partitions``
    replaces only the partitions present in ``df`` (incremental reruns);
    ``metrics`` are extra aggregates observed on the written rows."""
    parts = tuple(partition_by or ())
    return _write(df, path, "parquet", _file_options(compression, max_records_per_file), {}, mode, _prepared(df, rebalance, parts, sort_by),
                  metrics, verify, parts, dynamic_partitions)


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",",
              mode: str = "overwrite", timestamp_format: str | None = None,
              compression: str | None = None, rebalance: bool | None = None,
              metrics: dict[str, Column] | None = None, sort_by: tuple[str, ...] = (),
              verify: bool | WriteResult = True, max_records_per_file: int | None = None) -> WriteResult:
    """Write CSV. Quotes are doubled, blanks and line breaks in texts stay,
    null is an empty field and an empty text a quoted one, times keep their
    microseconds unless ``timestamp_format`` says otherwise. A frame of one
    column cannot hold nulls (its line would be blank); the check raises."""
    options = {**CSV_OPTIONS, "header": str(header).lower(), "sep": sep}
    if timestamp_format:
        options["timestampFormat"] = timestamp_format
    write_options = {**options, **_file_options(compression, max_records_per_file)}
    return _write(df, path, "csv", write_options, {**options, "nullValue": CSV_NULL}, mode, _prepared(df, rebalance, (), sort_by),
                  metrics, verify)


def write_json(df: DataFrame, path: str, mode: str = "overwrite",
               compression: str | None = None, rebalance: bool | None = None,
               metrics: dict[str, Column] | None = None, sort_by: tuple[str, ...] = (),
               verify: bool | WriteResult = True, max_records_per_file: int | None = None) -> WriteResult:
    """JSON Lines; null fields are written so every column survives a read,
    times keep their microseconds."""
    write_options = {**TIME_OPTIONS, "ignoreNullFields": "false", **_file_options(compression, max_records_per_file)}
    return _write(df, path, "json", write_options, dict(TIME_OPTIONS), mode, _prepared(df, rebalance, (), sort_by),
                  metrics, verify)


def read_back(spark: SparkSession, result: WriteResult) -> DataFrame:
    """The written data under the original schema, column order and options."""
    if result.fmt not in WRITERS:
        raise ValueError(f"unknown format {result.fmt!r}")
    reader = spark.read.options(**result.options)
    if result.fmt != "parquet":
        reader = reader.schema(result.schema).option("mode", "FAILFAST")
    if result.only is not None or result.partition_by:
        where = list(result.only) if result.only is not None else [result.path]
        if not where or result.only is None and not paths.data_files(spark, result.path):
            return spark.createDataFrame([], result.schema)
        back = reader.format(result.fmt).option("basePath", result.path).load(where)
    else:
        back = reader.format(result.fmt).load(result.path)
    return back.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in result.schema.fields])


WRITERS = {"parquet": write_parquet, "csv": write_csv, "json": write_json}


def known_formats(formats: tuple[str, ...]) -> list[str]:
    """The formats there is a writer for; warns about others, raises if none is left."""
    known = [f for f in formats if f in WRITERS]
    for f in formats:
        if f not in WRITERS:
            warnings.warn(f"unsupported output format {f!r} is skipped", stacklevel=3)
    if not known:
        raise ValueError(f"no supported output format in {formats!r}; there are {sorted(WRITERS)}")
    return known


def write_multiple_formats(df: DataFrame, base_path: str,
                           formats: tuple[str, ...] = ("parquet", "csv", "json"),
                           metrics: dict[str, Column] | None = None,
                           verify: bool = True, compression: str | None = "gzip") -> dict[str, WriteResult]:
    """Fan one frame out to several formats.

    The frame's plan runs once: with more than one format it is written as Parquet
    beside its target, every other format is written from there, and each is held
    against what was observed on the original. That Parquet is itself the Parquet
    output, or goes when no such output is asked for. Text formats take several
    times the bytes of Parquet: they are compressed by ``compression`` (None: not),
    in files of at most RECORDS_PER_FILE records, since each of them is read whole.
    Unsupported formats are skipped with a warning.
    """
    known = known_formats(formats)
    at = {f: os.path.join(base_path, f"data.{f}") for f in known}
    text = {"compression": compression, "max_records_per_file": RECORDS_PER_FILE}
    own = {f: {} if f == "parquet" else text for f in known}
    if len(known) == 1:
        return {known[0]: WRITERS[known[0]](df, at[known[0]], metrics=metrics, verify=verify, **own[known[0]])}
    spark = df.sparkSession
    stage = paths.beside(at["parquet"], "new") if "parquet" in at else shared_dir(spark, "fan-out")
    try:
        original = write_parquet(df, stage, metrics=metrics, verify=False)
        results = {}
        for f in known:
            if f == "parquet":
                if verify:
                    original.check(spark)
                paths.replace(spark, stage, at[f])
                original.path = at[f]
                results[f] = original
            else:
                results[f] = WRITERS[f](read_back(spark, original), at[f], verify=original if verify else False, **own[f])
    finally:
        paths.remove(spark, stage)
    for result in results.values():
        result.expected_rows, result.expected_checksum, result.metrics = (
            original.expected_rows, original.expected_checksum, original.metrics)
    return results


def load_summary(spark: SparkSession, results: dict[str, WriteResult]) -> DataFrame:
    """format, n_rows, n_columns, n_files, total_bytes of what was written: the
    rows from a scan of the files, the sizes from a file listing (binaryFile
    source; contents are not read)."""
    frames = []
    for fmt, res in results.items():
        back = read_back(spark, res)
        files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*")
                 .option("recursiveFileLookup", True).load(res.path).select("path", "length"))
        rows = back.agg(F.count(F.lit(1)).alias("n_rows")).select(
            "n_rows", F.lit(0).cast("long").alias("n_files"), F.lit(0).cast("long").alias("total_bytes"))
        sizes = files.agg(F.count(F.lit(1)).alias("n_files"),
                          F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("total_bytes")).select(
            F.lit(0).cast("long").alias("n_rows"), "n_files", "total_bytes")
        frames.append(rows.unionByName(sizes).agg(*[F.max(c).alias(c) for c in ("n_rows", "n_files", "total_bytes")])
                      .select(F.lit(fmt).alias("format"), "n_rows", F.lit(len(back.columns)).alias("n_columns"),
                              "n_files", "total_bytes"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
