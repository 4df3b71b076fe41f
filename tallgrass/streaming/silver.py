"""Arriving silver rows kept deduplicated. An extension: batch rebuilds stay the reference behaviour.

The rows stand in a ``Store``, in parts by state and month. Snapshots are numbered by the store, and each keeps the last batch of every stream
that wrote to it, by the stream's own id: a batch that runs again finds itself in and changes nothing; a stream with a new checkpoint is another
stream, whose rows are merged with those that are there.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import deduplicate
from ..schema import SILVER, conform
from ..sources.store import Conflict, Snapshot, Store

TABLE = "silver"
#: Tries of a batch against other writers of the same months.
TRIES = 5


def current(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The silver rows of a snapshot, the last one unless told."""
    store = Store(spark, root)
    at = store.snapshot(number)
    return conform(store.read(TABLE, at)) if TABLE in at.tables else spark.createDataFrame([], SILVER)


def merge(store: Store, batch: DataFrame, source: tuple[str, int]) -> Snapshot:
    """Merge a batch of silver rows, number and stream of which ``source`` tells: the latest row of each entity and month wins.

    Only the states' months that the batch brings rows of are read and written again. Of rows with the same time of ingestion, those of the batch win.
    Rows without state or month, which silver cannot hold, are left out.
    """
    rows = conform(batch).filter("state is not null and production_date is not null").withColumn("_new", F.lit(1))
    part = F.concat_ws("-", "state", F.date_format("production_date", "yyyy-MM"))
    for k in range(TRIES):
        base = store.snapshot()
        if base.sources.get(source[0], -1) >= source[1]:
            return base
        touched = [r[0] for r in rows.select(part).distinct().collect()]  # a few thousand at most
        both = rows
        if TABLE in base.tables:
            both = rows.unionByName(conform(store.read(TABLE, base, touched)).withColumn("_new", F.lit(0)))
        merged = deduplicate(both, "_new").drop("_new")
        try:
            return store.commit(base, {TABLE: store.write(TABLE, merged, part)}, source)
        except Conflict:
            if k == TRIES - 1:
                raise
    raise AssertionError


def ingest(spark: SparkSession, arrivals: str, root: str, checkpoint: str) -> StreamingQuery:
    """Merge every new file under ``arrivals`` into the store at ``root``, until all that is there is in."""
    known = threading.Event()
    name: list[str] = []

    def run(batch: DataFrame, number: int) -> None:
        known.wait()
        merge(Store(batch.sparkSession, root), batch, (name[0], number))

    stream = spark.readStream.schema(SILVER).parquet(arrivals)
    query = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    name.append(str(query.id))  # kept in the checkpoint, so restarts have the same
    known.set()
    return query


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Delete snapshots but the last ``keep``, and files that none of those needs; the folders deleted."""
    return Store(spark, root).vacuum(keep)


def monthly_totals(stream: DataFrame, late: str = "62 days") -> DataFrame:
    """Oil and gas by state and month of a stream of silver rows; a month closes once rows ``late`` after it have come."""
    at = stream.withColumn("month", F.col("production_date").cast("timestamp")).withWatermark("month", late)
    return at.groupBy("state", "month").agg(F.sum("oil_bbl").alias("oil"), F.sum("gas_mcf").alias("gas"))
