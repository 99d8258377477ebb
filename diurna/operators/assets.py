"""Release assets, edition files and note routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .index import has_text

# Signatures of the binary payloads (fixed values)
SIGNATURES = {"pdf": b"%PDF", "jpeg": b"\xff\xd8\xff"}


def archives(release: DataFrame) -> DataFrame:
    """(name, url): the release's assets that are archives."""
    rows = release.select(F.explode("assets").alias("a"))
    return rows.where(F.col("a.name").endswith(".tgz")).select(F.col("a.name").alias("name"), F.col("a.browser_download_url").alias("url"))


def inventory(assets: DataFrame) -> DataFrame:
    """(asset, span, kind, size_mb): year or month that an archive covers, from its name, and its size."""
    year = F.regexp_extract("name", r"(\d{4})(?:-(\d{2}))?", 1)
    month = F.regexp_extract("name", r"(\d{4})(?:-(\d{2}))?", 2)
    of_month = month != ""
    return assets.select(
        F.col("name").alias("asset"),
        F.when(of_month, F.concat(year, F.lit("-"), month)).otherwise(year).alias("span"),
        F.when(of_month, "month").otherwise("year").alias("kind"),
        F.round(F.col("size") / 1e6, 2).alias("size_mb"),
    )


def inventory_summary(assets: DataFrame) -> DataFrame:
    return inventory(assets).agg(
        F.min("span").alias("first_span"),
        F.max("span").alias("last_span"),
        F.count_if(F.col("kind") == "year").alias("n_years"),
        F.count_if(F.col("kind") == "month").alias("n_months"),
        F.round(F.sum("size_mb"), 2).alias("total_mb"),
    )


def last_by_name(assets: DataFrame, n: int = 8) -> DataFrame:
    """The last n assets by name, in the order of names."""
    return inventory(assets).orderBy(F.desc("asset")).limit(n).orderBy("asset")


def edition_file(date: Column, edition: Column) -> Column:
    """Name of an edition's PDF: day, month, year and edition."""
    return F.concat(F.date_format(date, "ddMMyyyy"), F.lit("-"), edition, F.lit(".pdf"))


def edition_url(base: str, date: Column, edition: Column) -> Column:
    """Address of an edition's PDF below the site's download page."""
    return F.concat(F.lit(f"{base}?archivo="), edition_file(date, edition), F.lit("&anio="), F.date_format(date, "yyyy"), F.lit("&repo=repositorio/"))


def has_signature(content: Column, kind: str) -> Column:
    """Whether binary content starts like a pdf or jpeg does; null content doesn't."""
    return F.coalesce(F.startswith(content, F.lit(SIGNATURES[kind])), F.lit(False))


def valid_files(files: DataFrame, kind: str) -> DataFrame:
    """files (path, content) with status: ok, or invalid where the content is something else, as an error page."""
    return files.withColumn("status", F.when(has_signature(F.col("content"), kind), "ok").otherwise("invalid"))


def has_html(content: Column) -> Column:
    """Routing looks at the content itself, not at the index's flag."""
    return has_text(content)


def with_route(details: DataFrame, source: str = "auto", content: str = "cadena_contenido") -> DataFrame:
    """details with ``route``: html, image or pdf; error where html is asked for and there is none."""
    there = has_html(F.col(content))
    routes = {
        "auto": F.when(there, "html").otherwise("image"),
        "html": F.when(there, "html").otherwise("error"),
        "image": F.lit("image"),
        "pdf": F.lit("pdf"),
    }
    if source not in routes:
        raise ValueError(f"source is one of {', '.join(routes)}, not {source!r}")
    return details.withColumn("route", routes[source])


def preview(title: Column, width: int = 80) -> Column:
    """The title, cut after width characters and then marked by an ellipsis."""
    return F.concat(F.substring(title, 1, width), F.when(F.char_length(title) > width, "…").otherwise(""))


def first_with_prefix(notes: DataFrame, prefix: str, *order: str) -> DataFrame:
    """The first note, in the given order, whose title starts so."""
    return notes.where(F.col("titulo").startswith(prefix)).orderBy(*order).limit(1)


# What a rendered page of the site has (fixed values): links to its own list of references, and that list before the end of the main part
CITATION = r'href="#(ref-[^"]+)"'
APPENDIX = r'(?s)\n?<div id="quarto-appendix"[^>]*>.*?</div>\s*(?=</main>)'


def citations_to(html: Column, page: str) -> Column:
    """The page with its citations led to another page's references, and without a list of its own."""
    led = F.regexp_replace(html, CITATION, f'href="{page}#$1"')
    return F.regexp_replace(led, APPENDIX, "\n")
