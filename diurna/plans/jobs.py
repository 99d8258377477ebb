"""Jobs against the service: notes by number, their page images and PDFs, and their Markdown by any route.

Each answer of the service is fetched once and kept below ``work``; everything after that is made from there.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import udfs
from ..operators import assets as a
from ..operators import index as ix
from ..sources import files, service
from . import markdown as md


class Service(NamedTuple):
    spark: SparkSession
    base: str
    work: str
    transport: service.Transport = service.http

    def ask(self, keys: DataFrame, endpoint: str) -> DataFrame:
        return service.ask(keys.distinct(), self.base, endpoint, f"{self.work.rstrip('/')}/{endpoint}", self.transport)


def details(at: Service, numbers: list[int]) -> DataFrame:
    """Notes by number. A number that the service doesn't know gives no row."""
    return files.answered_details(at.ask(at.spark.createDataFrame([(n,) for n in numbers], "key long"), "nota"))


def day_notes(at: Service, notes: DataFrame) -> DataFrame:
    """The whole index of all days on which notes (fecha) were published."""
    return files.answered_index(at.ask(notes.select(F.col("fecha").alias("key")).where("key is not null"), "notas"))


def spans(notes: DataFrame, index: DataFrame) -> DataFrame:
    """(cod_nota, cod_edicion, cod_diario, pages): pages by the index entry of each note; a note that isn't in it has its own page."""
    found = ix.index_entries(notes.select("cod_nota", "fecha", "cod_edicion", "cod_diario", "pagina"), ix.page_spans(index).drop("cod_diario", "pagina"))
    return found.select("cod_nota", "cod_edicion", "cod_diario", F.coalesce("entry.pages", F.array(F.col("pagina").cast("bigint"))).alias("pages"))


def images(at: Service, notes: DataFrame, index: DataFrame) -> DataFrame:
    """(cod_nota, pos, nombre_archivo, content, status): the scanned pages of notes; pages without a listed image are missing_page."""
    pages = ix.explode_pages(spans(notes, index))
    listings = files.answered_images(at.ask(pages.select(F.col("cod_diario").alias("key")), "imagenes"))
    found = ix.page_images(pages, listings, ["cod_diario"])
    wanted = found.where("nombre_archivo is not null").select(F.concat_ws("/", "cod_edicion", "nombre_archivo").alias("key"))
    contents = at.ask(wanted, "imagen").select("key", F.col("body").alias("content"), F.when(F.col("status") != service.OK, F.col("status")).alias("failed"))
    joined = found.withColumn("key", F.concat_ws("/", "cod_edicion", "nombre_archivo")).join(contents, "key", "left")
    return joined.select("cod_nota", F.col("page").alias("pos"), "nombre_archivo", "content", F.coalesce("failed", "status").alias("status"))


def pdfs(at: Service, notes: DataFrame, index: DataFrame, split: Callable[[bytes, list[int]], bytes] = md.pypdf_pages) -> DataFrame:
    """(cod_nota, content, status): the notes' own PDFs, cut out of their editions'."""
    found = spans(notes, index)
    editions = at.ask(found.select(F.col("cod_diario").alias("key")), "pdf").select(F.col("key").alias("cod_diario"), F.col("body").alias("content"))
    return md.note_pdfs(found, editions, split)


class Made(NamedTuple):
    notes: DataFrame
    pages: DataFrame | None


def note_markdown(at: Service | None, notes: DataFrame, index: DataFrame | None, factory: Callable[[], md.Engine] | None = None, source: str = "auto", min_confidence: float = 0.6, split: Callable[[bytes, list[int]], bytes] = md.pypdf_pages) -> Made:
    """Markdown of notes by their routes, and the pages that an engine read, with figures. Without a service or an engine only HTML is converted."""
    routes = {r["route"] for r in a.with_route(notes, source).select("route").distinct().collect()}
    if index is None:
        index = day_notes(at, notes) if at is not None else notes.select("*", F.lit(0).alias("note_pos"))
    read = {}
    if at is not None and factory is not None:
        wanted = a.with_route(notes, source)
        for route in routes & {"image", "pdf"}:
            own = wanted.where(F.col("route") == route)
            found = images(at, own, index) if route == "image" else md.pdf_pages(pdfs(at, own, index, split))
            kept = f"{at.work.rstrip('/')}/read-{route}"
            md.ocr_pages(found, factory, stem="nombre_archivo" if route == "image" else None).write.mode("overwrite").parquet(kept)
            read[route] = at.spark.read.parquet(kept)
    made = md.build_markdown(notes, index, source=source, min_confidence=min_confidence, read=read)
    pages = None
    for frame in read.values():
        pages = frame if pages is None else pages.unionByName(frame)
    return Made(made, pages)


def edition_markdown(spark: SparkSession, site: str, date: str, edition: str, work: str, factory: Callable[[], md.Engine] | None, transport: service.Transport = service.http) -> tuple[DataFrame, DataFrame | None]:
    """The site's PDF of an edition as (path, content, status), and its Markdown as (path, content, status, folder, figures) where there is an engine."""
    row = spark.range(1).select(F.to_date(F.lit(date)).alias("fecha"), F.lit(edition).alias("cod_edicion"))
    named = row.select(a.edition_file(F.col("fecha"), F.col("cod_edicion")).alias("path"), a.edition_url(site, F.col("fecha"), F.col("cod_edicion")).alias("url"))
    at = f"{work.rstrip('/')}/edition-{date}-{edition}"
    service.fetch(named, transport, 30.0).write.mode("overwrite").parquet(at)
    found = spark.read.parquet(at)
    checked = a.valid_files(found.where(F.col("status") == service.OK).select("path", F.col("body").alias("content")), "pdf")
    pdf = checked.unionByName(found.where(F.col("status") != service.OK).select("path", F.col("body").alias("content"), "status"))
    if factory is None:
        return pdf, None
    stem = F.regexp_replace("path", r"\.pdf$", "")
    good = pdf.where("status = 'ok'").select(stem.alias("name"), F.lit(0).alias("pos"), "content")
    read = f"{at}-read"
    md.ocr_pages(good, factory, key="name", folder=F.concat(F.col("name"), F.lit("_images"))).write.mode("overwrite").parquet(read)
    pages = spark.read.parquet(read)
    return pdf, pages.select(F.concat("name", F.lit(".md")).alias("path"), udfs.tables_to_md(F.col("markdown")).alias("content"), "status", "folder", "figures")
