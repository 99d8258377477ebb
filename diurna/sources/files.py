"""Files of the gazette as DataFrames with explicit schemas."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.index import explode_index
from ..schemas import DAY_INDEX, IMAGE_LISTING, NOTE_DETAIL, RELEASE, TITLE_RECORD

CORRUPT = "_corrupt_record"


def _json(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """One JSON document a file; a file that is none keeps its text in _corrupt_record."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])).option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def day_indexes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Saved day indexes, with the file's name."""
    return _json(spark, path, DAY_INDEX).withColumn("file", F.input_file_name())


DETAIL = ["codNota as cod_nota", "titulo", "codEdicion as cod_edicion", "try_to_date(fecha, 'dd-MM-yyyy') as fecha", "codDiario as cod_diario", "pagina", "cadenaContenido as cadena_contenido"]


def note_details(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(cod_nota, titulo, cod_edicion, fecha, cod_diario, pagina, cadena_contenido) of saved notes."""
    return _json(spark, path, NOTE_DETAIL).select("Nota.*").selectExpr(*DETAIL)


def answered_details(answers: DataFrame) -> DataFrame:
    """The same of the service's answers (body)."""
    return answers.where("body is not null").select(F.from_json(F.decode("body", "UTF-8"), NOTE_DETAIL).alias("d")).select("d.Nota.*").where("codNota is not null").selectExpr(*DETAIL)


def answered_index(answers: DataFrame) -> DataFrame:
    """All notes of the day indexes among the service's answers (body)."""
    return explode_index(answers.where("body is not null").select(F.from_json(F.decode("body", "UTF-8"), DAY_INDEX).alias("d")).select("d.*"))


def answered_images(answers: DataFrame) -> DataFrame:
    """(cod_diario, pos, page, nombre_archivo) of the image listings among the service's answers (key, body)."""
    rows = answers.where("body is not null").select(F.col("key").alias("cod_diario"), F.from_json(F.decode("body", "UTF-8"), IMAGE_LISTING).alias("d"))
    return rows.select("cod_diario", F.posexplode("d.imagenesFS").alias("pos", "i")).selectExpr("cod_diario", "pos", "cast(i.pagina as bigint) as page", "i.nombreArchivo as nombre_archivo")


def image_listings(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, pos, cod_imagen, page, nombre_archivo)"""
    rows = _json(spark, path, IMAGE_LISTING).select(F.input_file_name().alias("file"), F.posexplode("imagenesFS").alias("pos", "i"))
    return rows.selectExpr("file", "pos", "i.codImagen as cod_imagen", "cast(i.pagina as bigint) as page", "i.nombreArchivo as nombre_archivo")


def release_assets(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _json(spark, path, RELEASE)


def opaque(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, payload) of documents without a fixed form (edition metadata, indicators), as VARIANT."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.try_parse_json("value").alias("payload"))


def binaries(spark: SparkSession, path: str, suffix: str = "*") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", suffix).load(path)


def _members(content: bytes) -> Iterator[tuple[str, int, str]]:
    with tarfile.open(fileobj=io.BytesIO(content), mode="r:*") as archive:
        for pos, member in enumerate(archive):
            if member.isfile() and member.name.endswith(".json"):
                yield member.name, pos, archive.extractfile(member).read().decode("utf-8")


def archive_members(files: DataFrame) -> DataFrame:
    """(asset, member, member_pos, body) of the JSON files in archives; files: binaryFile rows. Assets come in the order of their names."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                rows = [(path.rsplit("/", 1)[-1], *m) for m in _members(content)]
                yield pd.DataFrame(rows, columns=["asset", "member", "member_pos", "body"])

    return files.where(F.col("path").endswith(".tgz")).select("path", "content").mapInPandas(run, "asset string, member string, member_pos long, body string")


def register_archive_function(spark: SparkSession) -> None:
    """tgz_members(content): a table function over an archive's bytes."""

    @F.udtf(returnType="member string, member_pos long, body string")
    class Members:
        def eval(self, content):
            if content is not None:
                yield from _members(bytes(content))

    spark.udtf.register("tgz_members", Members)


def archived_notes(members: DataFrame) -> DataFrame:
    """All notes of archived day indexes, with asset, member and positions."""
    days = members.select("asset", "member", "member_pos", F.from_json("body", DAY_INDEX).alias("d")).select("asset", "member", "member_pos", "d.*")
    return explode_index(days, "asset", "member", "member_pos")


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """(fecha): completed days, one ISO date a line; blank lines and repetitions don't count, a missing file is empty."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], "fecha date")
    return lines.select(F.trim("value").alias("v")).where("v <> ''").select(F.expr("try_to_date(v, 'yyyy-MM-dd')").alias("fecha")).where("fecha is not null").distinct()


def titles(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Published title records, gzipped JSON lines. One file is one task to read: repartition before heavy work."""
    rows = spark.read.schema(TITLE_RECORD).json(path)
    return rows.selectExpr("codNota as cod_nota", "titulo", "try_to_date(fecha, 'dd-MM-yyyy') as fecha", "codOrgaUno as cod_orga_uno")
