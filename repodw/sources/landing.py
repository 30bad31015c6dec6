"""The ledger of landed files: which day each raw file belongs to, decided once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repodw import fixed_values as V
from repodw.sources.raw import day_of, of_platform, path_below
from repodw.sources.store import Warehouse


def listed(spark: SparkSession, raw_dir: str, names: str = "*.json") -> DataFrame:
    """file (path below the landing folder) of the platforms' raw files. The folder is listed once, no file is opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", names).load(raw_dir)
    return raw_files(found, raw_dir)


def raw_files(found: DataFrame, raw_dir: str) -> DataFrame:
    """The platforms' raw files among rows of a listing (path, length)."""
    path = path_below(found.sparkSession, F.col("path"), raw_dir)
    return found.filter(F.col("length") >= V.SMALLEST_RAW_FILE).select(path.alias("file")).filter(of_platform(F.col("file")))


def dated(files: DataFrame, ledger: DataFrame, undated_day: str | None = None) -> DataFrame:
    """file, dated, dt: the day in the file's path; else the one the ledger gave it before; else `undated_day`.

    A file that gets none of these has an empty dt.
    """
    given = ledger.filter(~F.col("dated")).select(F.col("file").alias("_file"), F.col("dt").alias("_dt"))
    own = day_of(F.col("file"))
    return files.distinct().join(given, F.col("file") == F.col("_file"), "left").select(
        "file", (own != "").alias("dated"),
        F.when(own != "", own).otherwise(F.coalesce("_dt", F.lit(undated_day or ""))).alias("dt"))


def refuse_undated(files: DataFrame) -> None:
    """An error if a file of dated() has no day."""
    if some := [row["file"] for row in files.filter("dt = ''").limit(5).collect()]:
        raise ValueError(f"raw files that name no day; give the day they belong to, or move them away: {some}")


def files_of(warehouse: Warehouse, files: DataFrame, days: Sequence[str]) -> list[tuple[str, bool, str]]:
    """file, dated and dt of all files of these days: those in the ledger and those of dated(). Names of one load's files,
    which its scan takes as a list."""
    known = warehouse.read_days("landed_files", days).select("file", "dated", "dt")
    rows = known.unionByName(files.filter(F.col("dt").isin(list(days)))).distinct()
    return sorted((r["file"], r["dated"], r["dt"]) for r in rows.collect())
