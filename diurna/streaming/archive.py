"""The incremental archive: a resumable batch driver and its Structured Streaming twin.

Days of a range that the ledger doesn't hold are fetched; each has an outcome. Days with an index or without an edition are done and
go to the ledger, unless they are the open day (as_of or later), whose edition list can still grow; failed ones are tried again
by the next run.
"""

from __future__ import annotations

import logging
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from .. import sinks
from ..operators import index as ix
from ..schemas import DAY_INDEX
from ..sources import files, service

FIRST_DAY = "1917-01-02"
log = logging.getLogger(__name__)


class Run(NamedTuple):
    outcomes: DataFrame
    statistics: dict[str, int]


def fetch_days(days: DataFrame, base: str, transport: service.Transport = service.http, pause: float = 0.5, connections: int = 4, timeout: float = 30.0) -> DataFrame:
    """days (fecha) with status and body (text) of their indexes."""
    requests = days.select("fecha", service.request_url(base, "notas", F.col("fecha")).alias("url")).repartition(connections, "fecha")
    return service.fetch(requests, transport, timeout, pause).withColumn("body", F.decode("body", "UTF-8"))


def update_archive(spark: SparkSession, root: str, ledger: str, as_of: str, first: str = FIRST_DAY, last: str | None = None, base: str = "", transport: service.Transport = service.http, pause: float = 0.5, connections: int = 4, report_every: int = 100) -> Run:
    """Fetch what is missing of a range, write one file a day below root, extend the ledger; the second run of a closed range does nothing.

    Days are taken in steps of ``report_every``, each with its files, its ledger entries and a line in the log; an interrupt ends the run between
    or within steps, and what the steps before it made stays and is reported.
    """
    at = f"{root.rstrip('/')}/_answers"
    # a calendar has some ten thousands of days
    days = [r["fecha"] for r in ix.missing_days(spark, first, last or as_of, files.ledger(spark, ledger)).orderBy("fecha").collect()]
    spark.createDataFrame([], "fecha date, url string, status string, http_status int, body string, error string").write.mode("overwrite").parquet(at)
    done = 0
    try:
        for low in range(0, len(days), report_every):
            step = spark.createDataFrame([(d,) for d in days[low : low + report_every]], "fecha date")
            # the answers are needed three times, and asking again could answer differently
            part = f"{root.rstrip('/')}/_answers/step={low // report_every}"
            fetch_days(step, base, transport, pause, connections).write.mode("overwrite").parquet(part)
            outcomes = spark.read.parquet(part)
            sinks.export_files(sinks.day_files(outcomes.where(F.col("status") == service.OK)), root)
            sinks.append_ledger(ix.closed_days(outcomes.where(F.col("status") != service.RETRY), as_of), ledger)
            done = min(len(days), low + report_every)
            log.info("%s of %s days, up to %s", done, len(days), days[done - 1])
    except KeyboardInterrupt:
        log.warning("interrupted after %s of %s days", done, len(days))
        days = days[:done]
    steps = [f"{at}/step={k}" for k in range(-(-len(days) // report_every))]
    outcomes = spark.read.parquet(*steps) if steps else spark.read.parquet(at)
    return Run(outcomes, ix.run_statistics(outcomes).first().asDict())


def compact(spark: SparkSession, months: str, years: str, year: int) -> None:
    """One file a year from a year's months, replacing that year only; day indexes as rows (fecha, body)."""
    rows = spark.read.schema("fecha date, body string").json(months).where(F.year("fecha") == year)
    sinks.write_days(rows.coalesce(1), years)


def stream_notes(spark: SparkSession, folder: str) -> DataFrame:
    """Notes of day files as they arrive. A file rewritten under its old name isn't read again: an open day comes under a new name each time."""
    days = spark.readStream.schema(DAY_INDEX).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*-notas*.json").json(folder)
    return ix.explode_index(days.withColumn("file", F.col("_metadata.file_path")), "file")


def start(spark: SparkSession, folder: str, table: str, checkpoint: str) -> StreamingQuery:
    """Process all new files, then stop: each micro-batch replaces the days that it holds in a Parquet table partitioned by day."""

    def upsert(batch: DataFrame, epoch: int) -> None:
        dated = batch.where("fecha is not null")
        # of several files of a day in one batch the last by name holds
        newest = dated.groupBy("fecha").agg(F.max("file").alias("file"))
        dated.join(newest, ["fecha", "file"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("fecha").parquet(table)

    return stream_notes(spark, folder).writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class Progress(StreamingQueryListener):
    """Logs each micro-batch's rows."""

    def onQueryStarted(self, event):
        log.info("started %s", event.id)

    def onQueryProgress(self, event):
        log.info("batch %s: %s rows", event.progress.batchId, event.progress.numInputRows)

    def onQueryIdle(self, event):
        log.debug("idle")

    def onQueryTerminated(self, event):
        log.info("ended %s", event.id)
