"""Raw repository files: JSON arrays as landed, and their splittable reading."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repodw import fixed_values as V
from repodw import schemas
from repodw.session import hadoop_path

# Ends a top-level element of an array indented by two spaces. Line breaks inside JSON strings are escaped, so
# the text cannot hold it elsewhere, and the text source can split a file of any size at it.
ELEMENT_END = "\n  }"
_ORDER = ["file_name", "file_block", "pos"]


def read_raw_json(spark: SparkSession, raw_dir: str, schema: T.StructType = schemas.RAW, names: str = "*.json",
                  day: str | None = None, undated: bool = False, files: Sequence[str] | None = None) -> DataFrame:
    """Records of all raw files under `raw_dir`, with `file_name`, `file_block` and `pos` as their order.

    Taken are .json files of at least 10 bytes with a platform name in their path below `raw_dir` and an array
    inside; objects (such as progress files) and empty arrays give nothing. Arrays indented by two spaces, as
    the collectors write them, are split between tasks. Any other array layout is parsed by the task that
    reads its file. Text that is no JSON is an error. With `day` only the files of that day are read (see
    `day_of`); with `undated` also those without any. With `files`, paths below `raw_dir`, exactly these are read and the
    folder isn't listed.

    Values are read as text and cast by rule: whole numbers may be written 5, 5.0 or "5", flags true, 1 or "1".
    A value that fits no rule, or not into its column, is an error. A key that a record lacks gets its default.
    """
    reader = spark.read.option("lineSep", ELEMENT_END)
    if files is None:
        lines = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", names).text(raw_dir)
    else:
        lines = reader.text([f"{raw_dir.rstrip('/')}/{_literal(file)}" for file in files])
    path = path_below(spark, F.col("_metadata.file_path"), raw_dir)
    # Conditions on the file alone come first, so that no line of a foreign file is looked at.
    lines = lines.filter(of_platform(path) & (F.col("_metadata.file_size") >= V.SMALLEST_RAW_FILE))
    if day is not None:
        lines = lines.filter((day_of(path) == day) | (F.lit(undated) & (day_of(path) == "")))
    chunks = lines.select(
        "value",
        path.alias("file_name"),
        F.col("_metadata.file_block_start").alias("file_block"),
        F.monotonically_increasing_id().alias("chunk"),
    )
    element = F.rlike("value", F.lit(r"\A(\[|,)\s*\n  \{\s*\n"))
    whole = F.ltrim("value").startswith("[") & ~element
    text = (
        F.when(element, F.concat(F.lit("["), F.substr("value", F.lit(2)), F.lit(ELEMENT_END + "]")))
        .when(whole, F.col("value"))
    )
    broken = F.raise_error(F.concat(F.lit("not a JSON array of records: "), F.col("file_name")))
    records = F.coalesce(F.from_json("text", "array<map<string,string>>"), broken)
    return (
        chunks.withColumn("text", text)
        .filter(F.col("text").isNotNull())
        .select("file_name", "file_block", "chunk", F.posexplode(records).alias("pos_in_chunk", "record"))
        .select(
            *[_field(field).alias(field.name) for field in schema.fields], "file_name", "file_block",
            F.struct("chunk", "pos_in_chunk").alias("pos"),
        )
    )


def _literal(path: str) -> str:
    """A path in which no sign is taken for a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def file_of(file_name: Column) -> Column:
    """The path below the landing folder as a listing gives it: records carry it URL-encoded."""
    return F.url_decode(F.replace(file_name, F.lit("+"), F.lit("%2B")))


def _field(field: T.StructField) -> Column:
    """A field of a record, cast to its column's type."""
    text = F.col("record")[field.name]
    if field.dataType == T.StringType():
        value = text
    else:
        number = F.expr(f"try_cast(record['{field.name}'] AS DECIMAL(38, 6))")
        if field.dataType == T.BooleanType():
            value = (F.when(F.lower(text).isin("true", "false"), F.lower(text) == "true")
                     .when(number.isin(0, 1), number == 1).when(text == "", F.lit(False)))
        else:
            value = F.when(number == F.floor(number), F.expr(
                f"try_cast(try_cast(record['{field.name}'] AS DECIMAL(38, 6)) AS {field.dataType.simpleString()})"))
        unfit = F.raise_error(F.concat(F.lit(f"{field.name} is no {field.dataType.simpleString()}: "), text))
        value = F.when(text.isNotNull(), F.coalesce(value, unfit.cast(field.dataType)))
    if field.name not in schemas.RAW_DEFAULTS:
        return value
    default = F.lit(schemas.RAW_DEFAULTS[field.name]).cast(field.dataType)
    return F.when(F.map_contains_key("record", F.lit(field.name)), value).otherwise(default)


def path_below(spark: SparkSession, path: Column, folder: str) -> Column:
    """What follows `folder` in a file's path. The folder is cut off at the front, whatever else repeats its name."""
    _, root = hadoop_path(spark, folder)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toUri()
    out = path
    for name in {root.getRawPath(), root.getPath()}:
        front = name.rstrip("/") + "/"
        out = F.when(F.instr(path, front) > 0, F.substr(path, F.instr(path, front) + F.lit(len(front)))).otherwise(out)
    return out


def of_platform(path: Column) -> Column:
    return path.contains("gitee") | path.contains("github")


def day_of(path: Column) -> Column:
    """The day a raw file belongs to: the last _YYYYMMDD in its path; empty where there is none."""
    return F.regexp_replace(F.regexp_extract(path, r"^.*_([0-9]{8})(?![0-9])", 1), "^(....)(..)(..)$", "$1-$2-$3")


def undated_files(spark: SparkSession, raw_dir: str, names: str = "*.json") -> list[str]:
    """Some of the platforms' raw files whose path names no day; only the folder is listed."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", names).load(raw_dir)
    path = path_below(spark, F.col("path"), raw_dir)
    rows = found.filter(F.col("length") >= V.SMALLEST_RAW_FILE).select(path.alias("file")).filter(
        of_platform(F.col("file")) & (day_of(F.col("file")) == ""))
    return [r["file"] for r in rows.limit(5).collect()]


def day_tag(day: str) -> str:
    """How a day is written in the names of raw files."""
    return "_" + day.replace("-", "")


def raw_order() -> list[str]:
    """Columns that order raw records as files and arrays do."""
    return list(_ORDER)


def union_platforms(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; a column some of them lack is null there."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked


def write_raw_dated(df: DataFrame, path: str, day: str) -> None:
    """One output per platform and day, as JSON lines: the splittable landing form."""
    (
        df.withColumn("dt", F.lit(day)).write.mode("overwrite").partitionBy("source_platform", "dt")
        .option("ignoreNullFields", "false").json(path)
    )


def read_raw_dated(spark: SparkSession, path: str, schema: T.StructType = schemas.RAW) -> DataFrame:
    """Read back write_raw_dated, with the platform and day as text columns."""
    with_day = T.StructType([*schema.fields, T.StructField("dt", T.StringType())])
    return spark.read.schema(with_day).json(path)


def write_raw_arrays(df: DataFrame, path: str, day: str, collected_from: Column | None = None, key: str = "repo_id",
                     records_per_file: int = 50_000) -> None:
    """Indented JSON array files below `path`: files={platform}_repos_YYYYMMDD/block=n/part-….

    Records go to files by blocks of the key; a block never mixes platforms (`collected_from`, by default the
    record's own). Within a file they are in key order.
    """
    block = F.floor(F.col(key) / records_per_file).cast("long")
    platform = F.col("source_platform") if collected_from is None else collected_from
    folder = F.concat(platform, F.lit("_repos" + day_tag(day)))
    order = Window.partitionBy("_folder", "block").orderBy(key)
    body = F.to_json(F.struct(*df.columns), {"pretty": "true", "ignoreNullFields": "false"})
    first = F.row_number().over(order) == 1
    last = F.lead(key).over(order).isNull()
    text = F.concat(
        F.when(first, F.lit("[\n")).otherwise(F.lit("")),
        F.lit("  "), F.replace(F.col("_body"), F.lit("\n"), F.lit("\n  ")),
        F.when(last, F.lit("\n]")).otherwise(F.lit(",")),
    )
    (
        df.withColumn("_body", body).withColumn("_folder", folder).withColumn("block", block)
        .select("_folder", "block", key, text.alias("value"))
        .sortWithinPartitions("_folder", "block", key)
        .select("_folder", "block", "value")
        .withColumnRenamed("_folder", "files")
        .write.mode("overwrite").partitionBy("files", "block").text(path)
    )

