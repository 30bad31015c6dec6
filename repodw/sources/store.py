"""Warehouse tables on a path: Parquet, partitioned by day, each day replaced as a whole, all published at once.

Every write makes a new folder, `<table>/version=<run>/...`; none is ever changed, moved or renamed. Which folders make
up a table is written in a list of the table (`_state/<table>/<number>.json`: partition value -> folders), and the root
list (`_state/root/<number>.json`) names the list of every table. A load writes its folders, then the lists of the
tables it changed, and last the next root list. Readers take the newest root list that is complete, so a load that
stops anywhere leaves them on the state before it. The two newest states are kept, what only older ones name is deleted.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repodw import schemas
from repodw.operators.keyed import unseen
from repodw.session import delete_path, hadoop_path

# Folders of rows appended to an unpartitioned table before they are written as one again.
MOST_APPENDS = 16


class Warehouse:
    """Reads and writes the tables of schemas.TABLES below one root folder. One load at a time; any number of readers,
    each with a Warehouse of its own. The object that loads sees its writes at once, others when they are published.

    `buckets` is how many buckets of projects the facts and the project dimension are kept in. With a `collation` (such
    as UNICODE_CI_AI) names of organisations, platforms and languages that are equal under it are one; organisations keep
    the spelling that was loaded first. Both are fixed by the first write of a warehouse.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = schemas.BUCKETS, collation: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self._buckets = buckets
        self._collation = collation
        self._depth = 0
        self._view: dict[str, dict[str, list[str]]] | None = None  # while a load runs: all tables, with its writes
        self._staged: dict[str, dict[str, list[str]]] = {}
        self._seen: tuple[int, dict] = (0, {})

    # Reading

    def read(self, table: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """The table under its fixed schema; without files yet, no rows. With `buckets` only those of a bucketed table
        are read."""
        return self._scan(table, self._folders(table), buckets)

    def partitions(self, table: str) -> list[str]:
        """Partition values in order, from the table's list: no folder is listed and no data file opened."""
        return sorted(value for value in self._folders(table) if value not in ("", "__HIVE_DEFAULT_PARTITION__"))

    def newest_partition(self, table: str) -> str | None:
        return max(self.partitions(table), default=None)

    def read_days(self, table: str, days: Iterable[str]) -> DataFrame:
        """The given partitions alone, however long the history is."""
        folders = self._folders(table)
        return self._scan(table, {day: folders[day] for day in sorted(set(days)) if day in folders})

    def latest(self, table: str) -> DataFrame:
        """The newest partition: what the serving queries of the newest day need to be given."""
        newest = self.newest_partition(table)
        return self.read_days(table, [] if newest is None else [newest])

    def bucket_of(self, key: Column) -> Column:
        """The bucket of a project."""
        return F.pmod(F.xxhash64(key.cast("long")), F.lit(self._state()[1].get("buckets", self._buckets))).cast("int")

    @property
    def collation(self) -> str | None:
        return self._state()[1].get("collation", self._collation)

    # Writing

    @contextmanager
    def loading(self) -> Iterator[None]:
        """All writes of the block are published together at its end, or not at all when it fails."""
        if not self._depth:
            self._seen, self._staged = (0, {}), {}
            self._view = {table: dict(self._list(table)) for table in schemas.TABLES}
        self._depth += 1
        try:
            yield
        finally:
            self._depth -= 1
        if not self._depth:
            self._commit()

    def replace_days(self, table: str, df: DataFrame, days: Sequence[str] = (), rebalance: bool = True,
                     whole: bool = False) -> None:
        """Replace exactly the partitions that occur in `df`; others stay.

        The partitions named in `days` are also emptied when `df` has no rows for them; with `whole` all others are
        removed, so that the table holds nothing but `df`. Before writing, rows
        are rebalanced by the partition column and bucket, or for named days by a key, so that adaptive execution gives
        files of a useful size: a big day is split, small ones are merged. Within a file rows are sorted by
        that key, so that a lookup of a few keys reads a few pages.
        """
        column = schemas.PARTITIONED_BY[table]
        keys, bucket = schemas.SPREAD_BY.get(table, []), schemas.BUCKETED_BY.get(table)
        out = self._fit(table, df)
        by = [column]
        if bucket:
            out, by = out.withColumn("bucket", self.bucket_of(F.col(bucket))), [column, "bucket"]
        if table in schemas.RANGED_BY:
            by = [column, schemas.RANGED_BY[table]]
        if rebalance:
            out = out.hint("rebalance", *[F.col(c) for c in (keys if days and keys and len(by) == 1 else by)])
            if keys:
                out = out.sortWithinPartitions(*by, *keys)
        with self.loading():
            written = self._write(table, out, by)
            kept = {} if whole else {d: f for d, f in self._view[table].items() if d not in days}
            self._view[table] = {**kept, **written}

    def drop_partition(self, table: str, value: str) -> None:
        with self.loading():
            self._view[table].pop(value, None)

    def fill_once(self, table: str, df: DataFrame) -> bool:
        """Write a table that has no rows yet; a filled one is left alone. Says whether it wrote."""
        if not self.read(table).isEmpty():
            return False
        with self.loading():
            self._view[table] = {"": [self._write_whole(table, self._fit(table, df))]}
        return True

    def append_unseen(self, table: str, df: DataFrame) -> None:
        """Insert the rows whose key the table lacks; present rows stay as they are."""
        with self.loading():
            new, added = unseen(self.read(table), self._fit(table, df), schemas.KEYS[table], collation=self.collation), Observation()
            folder = self._write_whole(table, new.observe(added, F.count(F.lit(1)).alias("rows")))
            folders = self._view[table].get("", [])
            if added.get["rows"]:
                folders = [*folders, folder]
            if len(folders) > MOST_APPENDS:
                folders = [self._write_whole(table, self._scan(table, {"": folders}))]
            self._view[table] = {"": folders} if folders else {}

    def stage_buckets(self, table: str, df: DataFrame, changed: Sequence[int]) -> DataFrame:
        """Copy on write: the rows of the `changed` buckets become `df`, other buckets keep their files. Returns the
        table as it then is; readers of this object see it from settle() on."""
        out = self._fit(table, df).withColumn("bucket", self.bucket_of(F.col(schemas.BUCKETED_BY[table])))
        keys = schemas.KEYS[table]
        written = {}
        if changed:
            written = self._write(table, out.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", *keys), ["bucket"])
        kept = {b: f for b, f in self._folders(table).items() if b not in {str(c) for c in changed}}
        self._staged[table] = {**kept, **written}
        return self._scan(table, self._staged[table])

    def settle(self) -> None:
        """Make what is staged part of the load."""
        with self.loading():
            self._view.update(self._staged)
            self._staged = {}

    def _write(self, table: str, df: DataFrame, by: list[str]) -> dict[str, list[str]]:
        """Write a new folder, and return the folders of its partitions by their value."""
        folder = self._new_folder(table)
        df.write.partitionBy(*by).parquet(f"{self.root}/{folder}")
        found = {}
        fs, target = hadoop_path(self.spark, f"{self.root}/{folder}")
        for status in fs.listStatus(target):
            name = status.getPath().getName()
            if name.startswith(f"{by[0]}="):
                found[name.split("=", 1)[1]] = [f"{folder}/{name}"]
        return found

    def _write_whole(self, table: str, df: DataFrame) -> str:
        folder = self._new_folder(table)
        df.write.parquet(f"{self.root}/{folder}")
        return folder

    def _new_folder(self, table: str) -> str:
        return f"{table}/version={self._next()}-{uuid.uuid4().hex[:8]}"

    def _fit(self, table: str, df: DataFrame) -> DataFrame:
        """The columns of the table in its types; absent ones are null, and an unset etl_time is now."""
        columns = []
        for field in schemas.TABLES[table].fields:
            given = F.col(field.name) if field.name in df.columns else F.lit(None)
            if field.name == "etl_time":
                given = F.coalesce(given, F.current_timestamp())
            columns.append(given.cast(field.dataType).alias(field.name))
        return df.select(*columns)

    def _scan(self, table: str, folders: dict[str, list[str]], buckets: Iterable[int] | None = None) -> DataFrame:
        schema, paths = schemas.TABLES[table], [f"{self.root}/{f}" for value in sorted(folders) for f in folders[value]]
        if not paths:
            return self.spark.createDataFrame([], schema)
        stored = schema
        if table in schemas.BUCKETED_BY:
            stored = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
        rows = self.spark.read.schema(stored).option("basePath", f"{self.root}/{table}").parquet(*paths)
        if buckets is not None:
            rows = rows.filter(F.col("bucket").isin(sorted(buckets)))
        return rows.select(*schema.fieldNames())

    # Lists and versions

    def _folders(self, table: str) -> dict[str, list[str]]:
        return self._list(table) if self._view is None else self._view[table]

    def _list(self, table: str) -> dict[str, list[str]]:
        """What the newest state says of a table."""
        number = self._state()[1].get("tables", {}).get(table)
        return {} if number is None else self._json(f"_state/{table}/{number}.json")["folders"]

    def _state(self) -> tuple[int, dict]:
        """Number and content of the newest complete root list. One that a broken run left half-written is passed over."""
        for number in reversed(self._versions()):
            if self._seen[0] != number:
                try:
                    self._seen = (number, self._json(f"_state/root/{number}.json"))
                except ValueError:
                    continue
            return self._seen
        return 0, {}

    def _versions(self) -> list[int]:
        return sorted(int(name[:-5]) for name in self._names("_state/root") if name.endswith(".json"))

    def _next(self) -> int:
        return max(self._versions(), default=0) + 1

    def _commit(self, keep: int = 2) -> None:
        """Publish: the lists of the changed tables, then the root list that names them."""
        view, (_, old) = self._view, self._state()
        number, tables = self._next(), dict(old.get("tables", {}))
        changed = [table for table in schemas.TABLES if view[table] != self._list(table)]
        for table in changed:
            self._put(f"_state/{table}/{number}.json", {"folders": view[table]})
            tables[table] = number
        if changed:
            self._put(f"_state/root/{number}.json", {
                "buckets": old.get("buckets", self._buckets), "collation": old.get("collation", self._collation), "tables": tables})
        self._view = None
        if changed:
            self._clear(self._versions()[-keep:], changed)

    def _clear(self, keep: list[int], tables: list[str]) -> None:
        """Delete the states before those kept, and of the given tables the folders that no kept state names: those of
        former states and of loads that broke off."""
        roots = []
        for number in self._versions():
            if number in keep:
                try:
                    roots.append(self._json(f"_state/root/{number}.json")["tables"])
                except ValueError:
                    continue
            else:
                delete_path(self.spark, f"{self.root}/_state/root/{number}.json")
        for table in tables:
            lists = {f"{root[table]}.json" for root in roots if table in root}
            named = {f for name in lists for found in self._json(f"_state/{table}/{name}")["folders"].values() for f in found}
            for name in self._names(f"_state/{table}"):
                if name not in lists and name.endswith(".json"):
                    before = self._json(f"_state/{table}/{name}")["folders"]
                    for folder in {f for found in before.values() for f in found} - named:
                        delete_path(self.spark, f"{self.root}/{folder}")
                    delete_path(self.spark, f"{self.root}/_state/{table}/{name}")
            versions = {f"{table}/{name}" for name in self._names(table) if name.startswith("version=")}
            for folder in versions - {"/".join(f.split("/")[:2]) for f in named}:
                delete_path(self.spark, f"{self.root}/{folder}")

    def _names(self, path: str) -> list[str]:
        fs, target = hadoop_path(self.spark, f"{self.root}/{path}")
        return [status.getPath().getName() for status in fs.listStatus(target)] if fs.exists(target) else []

    def _json(self, path: str) -> dict:
        fs, target = hadoop_path(self.spark, f"{self.root}/{path}")
        stream = fs.open(target)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _put(self, path: str, content: dict) -> None:
        fs, target = hadoop_path(self.spark, f"{self.root}/{path}")
        stream = fs.create(target, True)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()


def write_clean(df: DataFrame, path: str) -> None:
    """Keep cleaned records, without the helper columns of the profile."""
    df.drop("star_range", "created_year").write.mode("overwrite").parquet(path)


def read_clean(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    return (reader.schema(schema) if schema else reader).parquet(path)
