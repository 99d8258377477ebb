"""Relational operators over day indexes: explode, filter, neighbour rows, lookups and aggregates.

The flat form of a note has the columns of NOTES; stubs (notes without a title) are kept until drop_untitled(),
since page spans depend on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import EDITIONS

NOTES = [
    "cod_nota", "fecha", "cod_edicion", "titulo", "cod_orga_uno", "nombre_cod_orga_uno", "cod_seccion", "pagina", "cod_diario",
    "orden", "existe_html", "existe_doc", "existe_imagen", "existe_pdf", "list_pos", "note_pos",
]


def has_text(value: Column) -> Column:
    """Neither null nor empty; blanks count as text."""
    return value.isNotNull() & (value != "")


def explode_index(days: DataFrame, *carried: str) -> DataFrame:
    """All notes of day indexes, the three editions after another: one row per note. A null or absent list has none."""
    present = [(k, name, code) for k, (name, code) in enumerate(EDITIONS) if name in days.columns]
    lists = F.array(*[F.struct(F.lit(k).alias("list_pos"), F.lit(code).alias("cod_edicion"), F.col(name).alias("notes")) for k, name, code in present])
    rows = days.select(*carried, F.inline(lists)).select(*carried, "list_pos", "cod_edicion", F.posexplode("notes").alias("note_pos", "n"))
    return rows.select(
        *carried,
        F.col("n.codNota").alias("cod_nota"),
        F.expr("try_to_date(n.fecha, 'dd-MM-yyyy')").alias("fecha"),
        "cod_edicion",
        F.col("n.titulo").alias("titulo"),
        F.col("n.codOrgaUno").alias("cod_orga_uno"),
        F.col("n.nombreCodOrgaUno").alias("nombre_cod_orga_uno"),
        F.col("n.codSeccion").alias("cod_seccion"),
        F.col("n.pagina").alias("pagina"),
        F.col("n.codDiario").alias("cod_diario"),
        F.col("n.orden").alias("orden"),
        F.col("n.existeHtml").alias("existe_html"),
        F.col("n.existeDoc").alias("existe_doc"),
        F.col("n.existeImagen").alias("existe_imagen"),
        F.col("n.existePdf").alias("existe_pdf"),
        "list_pos",
        "note_pos",
    )


def drop_untitled(notes: DataFrame) -> DataFrame:
    """Notes with a title; a title of blanks stays."""
    return notes.where(has_text(F.col("titulo")))


def drop_untitled_nested(days: DataFrame) -> DataFrame:
    """The same on day indexes as they are: each list is filtered, all else is untouched, absent and null lists stay so."""
    lists = {name: F.filter(F.col(name), lambda n: has_text(n["titulo"])) for name, _ in EDITIONS if name in days.columns}
    return days.withColumns(lists)


def title_records(notes: DataFrame) -> DataFrame:
    """The four published fields of titled notes."""
    return drop_untitled(notes).select("cod_nota", "titulo", "fecha", "cod_orga_uno")


def _edition_order(notes: DataFrame):
    # of notes with one number, the earlier in the list counts as the earlier
    return Window.partitionBy("fecha", "cod_edicion").orderBy("cod_nota", *[c for c in ("note_pos",) if c in notes.columns])


def page_spans(notes: DataFrame) -> DataFrame:
    """notes with ``pages``: own page up to the next note's first page, in the order of note numbers within an edition.

    The last note of an edition, and one whose successor starts on the same page, spans its own page only; a successor on an
    earlier page gives no page at all.
    """
    page = F.col("pagina")
    following = F.lead("pagina").over(_edition_order(notes))
    marked = notes.withColumn("_next", following)
    nxt = F.coalesce(F.col("_next"), page)
    pages = F.when(nxt < page, F.array().cast("array<bigint>")).otherwise(F.sequence(page.cast("bigint"), nxt.cast("bigint")))
    return marked.withColumn("pages", pages).drop("_next")


def explode_pages(spans: DataFrame) -> DataFrame:
    return spans.withColumn("page", F.explode("pages")).drop("pages")


def next_titled(notes: DataFrame) -> DataFrame:
    """notes with ``titulo_siguiente``: the title of the next note of the edition that has one, else null."""
    order = ", ".join(["cod_nota", *[c for c in ("note_pos",) if c in notes.columns]])
    return notes.withColumn("titulo_siguiente", F.expr(f"lead(nullif(titulo, '')) ignore nulls over (partition by fecha, cod_edicion order by {order})"))


def page_images(pages: DataFrame, images: DataFrame, keys: list[str], strict: bool = False) -> DataFrame:
    """pages with ``nombre_archivo`` and ``status``: the image of each page; of several, the one listed last (column pos).

    A page without image has status missing_page, or fails the job where strict.
    """
    last = images.groupBy(*keys, "page").agg(F.max_by("nombre_archivo", "pos").alias("nombre_archivo"), F.lit(True).alias("_there"))
    out = pages.join(last, [*keys, "page"], "left")
    missing = F.col("_there").isNull()
    if strict:
        out = out.where(F.when(missing, F.raise_error(F.concat(F.lit("no image of page "), F.col("page").cast("string")))).otherwise(F.lit(True)).cast("boolean"))
    return out.withColumn("status", F.when(missing, "missing_page").otherwise("ok")).drop("_there")


def index_entries(details: DataFrame, notes: DataFrame, strict: bool = False) -> DataFrame:
    """details (cod_nota, fecha, cod_edicion, ..) with their entry in the index as struct ``entry``: of several the first, null without one, which fails the job where strict."""
    keys = ["fecha", "cod_edicion", "cod_nota"]
    order = "note_pos" if "note_pos" in notes.columns else "cod_nota"
    first = notes.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in notes.columns if c not in keys]), order).alias("entry"))
    out = details.join(first, keys, "left")
    if strict:
        absent = F.raise_error(F.concat(F.lit("not in the index: note "), F.col("cod_nota").cast("string")))
        out = out.where(F.when(F.col("entry").isNull(), absent).otherwise(F.lit(True)).cast("boolean"))
    return out


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """(fecha): all days from first to last; none if last comes before first."""
    a, b = F.to_date(F.lit(first)), F.to_date(F.lit(last))
    # a reversed range would make sequence() fail, wherever a filter stands
    days = spark.range(1).select(F.explode(F.sequence(a, F.greatest(a, b), F.expr("interval 1 day"))).alias("fecha"))
    return days.where(F.col("fecha") <= b)


def missing_days(spark: SparkSession, first: str, last: str, done: DataFrame) -> DataFrame:
    """Days of the calendar that the ledger does not hold."""
    return calendar(spark, first, last).join(done.select("fecha"), "fecha", "left_anti")


def first_names(notes: DataFrame, *order: str) -> DataFrame:
    """(cod_orga_uno, nombre): per code the first name that is given, over titled notes; codes that are null are left out."""
    at = F.struct(*[F.col(c) for c in order])
    named = drop_untitled(notes).where(F.col("cod_orga_uno").isNotNull() & has_text(F.col("nombre_cod_orga_uno")))
    return named.groupBy("cod_orga_uno").agg(F.min_by("nombre_cod_orga_uno", at).alias("nombre"))


def with_names(notes: DataFrame, names: DataFrame) -> DataFrame:
    """notes with the organism's name; Spark decides from the table's size whether to broadcast it."""
    return notes.join(names, "cod_orga_uno", "left")


def count_by_edition(notes: DataFrame) -> DataFrame:
    return notes.groupBy(F.year("fecha").alias("anio"), "cod_edicion").agg(F.count(F.lit(1)).alias("n_notas"))


def counts_with_total(rows: DataFrame, key: str) -> DataFrame:
    """Rows per key and, with a null key, of all."""
    return rows.rollup(key).agg(F.count(F.lit(1)).alias("n"))


def run_statistics(outcomes: DataFrame) -> DataFrame:
    """One row: days processed, with an index, without an edition, failed; from column status (ok, no_edition, retry)."""
    return outcomes.agg(
        F.count(F.lit(1)).alias("procesados"),
        F.count_if(F.col("status") == "ok").alias("con_indice"),
        F.count_if(F.col("status") == "no_edition").alias("sin_edicion"),
        F.count_if(F.col("status") == "retry").alias("errores"),
    )


def closed_days(days: DataFrame, as_of: str) -> DataFrame:
    """Days before as_of: the current day can still grow and is never closed."""
    return days.where(F.col("fecha") < F.to_date(F.lit(as_of)))


def join_pages(pages: DataFrame, key: str, pos: str = "pos", text: str = "markdown", between: str = "\n\n") -> DataFrame:
    """One text per key: page texts in order, trimmed, with a blank line between and a line feed at the end."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(text).alias("t"))))
    texts = F.transform(parts, lambda x: F.regexp_replace(F.coalesce(x["t"], F.lit("")), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))
    return pages.groupBy(key).agg(F.concat(F.array_join(texts, between), F.lit("\n")).alias(text))
