"""The title dataset of all archives: title records, the organisms' names, and counts."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..operators import index as ix
from ..sources import files

ORDER = ("asset", "member_pos", "list_pos", "note_pos")


class Titles(NamedTuple):
    notes: DataFrame
    names: DataFrame
    counts: DataFrame


def build(spark: SparkSession, archives: str, silver: str) -> Titles:
    """Archives read once into a Parquet table of titled notes; records, names and counts come from it and stay columnar."""
    members = files.archive_members(files.binaries(spark, archives, "*.tgz"))
    ix.drop_untitled(files.archived_notes(members)).write.mode("overwrite").parquet(silver)
    notes = spark.read.parquet(silver)
    return Titles(notes, ix.first_names(notes, *ORDER), ix.counts_with_total(notes, "asset"))


def publish(made: Titles, path: str, names_path: str | None = None) -> dict[str | None, int]:
    """Write the records (gzipped JSON lines) and the names beside them; rows per archive and, under None, of all."""
    sinks.write_titles(made.notes, path)
    folder, _, name = (names_path or f"{path.rstrip('/')}-organigrama.json").rpartition("/")
    sinks.export_files(sinks.names_json(made.names).select(F.lit(name).alias("path"), sinks.pretty_json(F.col("content")).alias("content")), folder or ".")
    return {r["asset"]: r["n"] for r in made.counts.collect()}
