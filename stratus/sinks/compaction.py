"""Merging of small Parquet files, directory by directory.

The files of a table are listed with their sizes, as a reader lists them. In
each directory the files under ``small_bytes`` are binned first fit, largest
first, into bins of ``target_bytes``; each bin of several files is rewritten
into one, by a job that reads those files alone. The new files are checked
against what the job read (count and checksum) before any old one goes.

Readers skip names that begin with ``_``. A bin's new file stands in its
directory under such a name first; then the bin's old files are renamed to
such names, the new one gets its own, and the old ones are deleted. A
compaction that died between these steps is undone or finished, bin by bin, by
:func:`recover`.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratus.functions.exprs import row_checksum
from stratus.sinks import paths
from stratus.sinks.files import VerificationError

TARGET_FILE_BYTES = 128 << 20
_HIDDEN = re.compile(r"_(merged|replaced)-([0-9a-f]{12}-\d+)(?:-(.*))?")


@dataclass(frozen=True)
class Bin:
    """Files (directory, name) that become one file of ``directory``."""

    directory: str
    files: tuple[tuple[str, str], ...]
    bytes: int


def first_fit(sizes: list[tuple[int, tuple[str, str]]], target: int) -> list[list[tuple[int, tuple[str, str]]]]:
    """Bins of (size, file) of at most ``target`` bytes, first fit with the largest first.

    The first bin with room is found in a tree of largest rooms, so many files
    cost no more than their number times its logarithm."""
    order = sorted(sizes, key=lambda s: (-s[0], s[1]))
    leaves = 1
    while leaves < len(order):
        leaves *= 2
    room = [target] * (2 * leaves)
    bins: list[list] = [[] for _ in order]
    for size, file in order:
        at = 1
        while at < leaves:
            at = 2 * at if room[2 * at] >= size else 2 * at + 1
        bins[at - leaves].append((size, file))
        room[at] -= size
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])
    return [b for b in bins if b]


def plan(spark: SparkSession, path: str, target_bytes: int = TARGET_FILE_BYTES, small_bytes: int | None = None,
         into: Callable[[str], str | None] | None = None) -> list[Bin]:
    """The bins that :func:`compact_files` would rewrite."""
    small, by = small_bytes or target_bytes // 2, {}
    for directory, names in paths.data_files(spark, path, sizes=True).items():
        home = directory if into is None else into(directory)
        if home is not None:
            by.setdefault(home, []).extend((size, (directory, name)) for name, size in names if size < small)
    return [Bin(home, tuple(f for _, f in b), sum(n for n, _ in b)) for home, sizes in sorted(by.items())
            for b in first_fit(sizes, target_bytes) if len(b) > 1]


def compact_files(spark: SparkSession, path: str, target_bytes: int = TARGET_FILE_BYTES, small_bytes: int | None = None,
                  into: Callable[[str], str | None] | None = None) -> DataFrame:
    """Merge the small files of a Parquet table; returns one row per bin: directory,
    files (that it replaced), old_bytes, file (the new one's name).

    ``into`` names the directory into which a directory's files may be merged
    (by default itself; None leaves it alone). Nobody else may write the same
    directories meanwhile; readers that listed the old files may have to list anew.
    """
    path = path.rstrip("/")
    bins = plan(spark, path, target_bytes, small_bytes, into)
    run, schema = uuid.uuid4().hex[:12], "directory string, files int, old_bytes long, file string"
    if not bins:
        return spark.createDataFrame([], schema)
    staged = paths.beside(path, "merged")
    try:
        _rewrite(spark, path, bins, staged)
        for k, b in enumerate(bins):
            home = f"{path}/{b.directory}".rstrip("/")
            (name,) = paths.data_files(spark, f"{staged}/_bin={k}")[""]
            paths.move(spark, f"{staged}/_bin={k}/{name}", f"{home}/_merged-{run}-{k}")
            for directory, old in b.files:
                folder = f"{path}/{directory}".rstrip("/")
                paths.move(spark, f"{folder}/{old}", f"{folder}/_replaced-{run}-{k}-{old}")
            paths.move(spark, f"{home}/_merged-{run}-{k}", f"{home}/{_name(run, k)}")
            for directory, old in b.files:
                paths.remove(spark, f"{path}/{directory}/_replaced-{run}-{k}-{old}")
    finally:
        paths.remove(spark, staged)
    return spark.createDataFrame([(b.directory, len(b.files), b.bytes, _name(run, k)) for k, b in enumerate(bins)], schema)


def _name(run: str, k: int) -> str:
    return f"merged-{run}-{k}.parquet"


def _rewrite(spark: SparkSession, path: str, bins: list[Bin], staged: str) -> None:
    """One file per bin, ``staged``/_bin=<number>/, checked against what was read."""
    at = {paths.key(spark, f"{path}/{d}/{n}" if d else f"{path}/{n}"): k for k, b in enumerate(bins) for d, n in b.files}
    files = [f"{path}/{d}/{n}" if d else f"{path}/{n}" for b in bins for d, n in b.files]
    rows = spark.read.option("mergeSchema", True).parquet(*files)  # no base path: partition columns stay in the names
    columns = rows.columns
    number = spark.createDataFrame(list(at.items()), "_file string, _bin int")
    keyed = rows.withColumn("_file", F.regexp_replace(F.col("_metadata.file_path"), paths.SCHEME, "")).join(number, "_file").drop("_file")
    seen = Observation(f"merge-{staged.rpartition('/')[2]}")
    count, total = F.count(F.lit(1)), F.coalesce(F.sum(row_checksum([f"`{c}`" for c in columns])), F.lit(0).cast("decimal(30,0)"))
    # All rows of a bin come from one task, which writes them to one file.
    (keyed.repartition("_bin").observe(seen, count.alias("rows"), total.alias("checksum"))
     .write.partitionBy("_bin").parquet(staged))
    got = seen.get
    back = spark.read.schema(rows.schema).parquet(*[f"{staged}/_bin={k}" for k in range(len(bins))]).agg(
        count.alias("rows"), total.alias("checksum")).first()
    whole = spark.read.schema(rows.schema).parquet(*files).count()
    if (got["rows"], got["checksum"]) != (back["rows"], back["checksum"]) or whole != got["rows"]:
        raise VerificationError(f"merged files of {path}: {back.asDict()}, written {got}, in the old files {whole}")


def recover(spark: SparkSession, path: str) -> dict[str, int]:
    """Undo or finish what a compaction that died has left; returns how many bins of each.

    A bin whose new file has its name is finished (its old files go); any other is
    undone (its old files get their names back, the new file goes)."""
    path = path.rstrip("/")
    hidden: dict[str, dict[str, list[tuple[str, str]]]] = {}
    todo = [""]
    while todo:
        folder = todo.pop()
        for name, is_folder, _ in paths.listed(spark, f"{path}/{folder}".rstrip("/"), hidden=True):
            place = f"{folder}/{name}".lstrip("/")
            if is_folder:
                todo.append(place)
            elif found := _HIDDEN.fullmatch(name):
                hidden.setdefault(found[2], {}).setdefault(found[1], []).append((folder, place))
    done = {"undone": 0, "finished": 0}
    for own in hidden.values():
        for _, place in own.get("replaced", []):
            if "merged" in own:
                folder, _, name = place.rpartition("/")
                paths.move(spark, f"{path}/{place}", f"{path}/{folder}/{_HIDDEN.fullmatch(name)[3]}")
            else:
                paths.remove(spark, f"{path}/{place}")
        for _, place in own.get("merged", []):
            paths.remove(spark, f"{path}/{place}")
        done["undone" if "merged" in own else "finished"] += 1
    return done
