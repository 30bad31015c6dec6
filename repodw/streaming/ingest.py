"""Incremental ingest: each landed file is seen once, and the days it belongs to are loaded again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from repodw import schemas
from repodw.plans.daily import load_files, refresh_days
from repodw.session import written_for_now
from repodw.sources import landing
from repodw.sources.store import Warehouse

_FILE = "path string, modificationTime timestamp, length long, content binary"


def ingest_new_files(spark: SparkSession, raw_dir: str, warehouse: Warehouse, progress_dir: str, marts: bool = True,
                     schema: T.StructType = schemas.RAW, names: str = "*.json", undated_day: str | None = None) -> StreamingQuery:
    """Load the days of all files that landed since the last run, then stop.

    Files whose path names no day belong to `undated_day` of the run that first sees them, for good. Without it they are
    an error, and the batch stays to be done, so none is passed over.

    The stream only carries file names (contents are not read for it): a day is always loaded from all its files, which
    the ledger knows, so a batch that is repeated after a failure, or a second file for a day, gives the same tables as
    a first load. All days of a batch are loaded and published together.
    """
    landed = (
        spark.readStream.format("binaryFile").schema(_FILE).option("recursiveFileLookup", "true")
        .option("pathGlobFilter", names).load(raw_dir).select("path", "length")
    )

    def load(batch: DataFrame, _batch_id: int) -> None:
        files = landing.dated(landing.raw_files(batch, raw_dir), warehouse.read("landed_files"), undated_day)
        with written_for_now(files, "landed") as files:
            landing.refuse_undated(files)
            # One value per calendar day of the batch: a bounded list.
            days = sorted(row["dt"] for row in files.select("dt").distinct().collect())
            if days:
                with warehouse.loading():
                    load_files(batch.sparkSession, raw_dir, warehouse, files, days, schema)
                    if marts:
                        refresh_days(warehouse, days)

    query = (
        landed.writeStream.foreachBatch(load).option("checkpointLocation", progress_dir)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
