"""Notes to Markdown: the HTML route, and the routes through page images or PDF and an OCR engine.

An engine is made once per Python worker by a factory and has convert(pages: list[bytes]) -> list[str], the Markdown of
each page; it raises TimeoutError where it gives up. A Markdown that comes with figures is a Page. A splitter cuts pages out of an edition's PDF.
"""

from __future__ import annotations

import importlib.util
import shutil
import subprocess
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import sinks
from ..functions import udfs
from ..operators import assets as a
from ..operators import index as ix


class Page(str):
    """A page's Markdown, with the figures that it links to below images/, by name."""

    figures: dict[str, bytes] = {}

    def __new__(cls, text: str, figures: dict[str, bytes] | None = None):
        page = super().__new__(cls, text)
        page.figures = figures or {}
        return page


class Engine(Protocol):
    def convert(self, pages: list[bytes]) -> list[str]: ...


_engines: dict[Callable, Engine] = {}


def worker_engine(factory: Callable[[], Engine]) -> Engine:
    """The worker's own engine, started at first use and kept."""
    if factory not in _engines:
        _engines[factory] = factory()
    return _engines[factory]


class CommandEngine:
    """An OCR program that writes <out>/<name>/auto/<name>.md for a file; pages go to it one by one."""

    def __init__(self, command: list[str], suffix: str = ".jpg", timeout: float = 3600.0):
        if shutil.which(command[0]) is None:
            raise RuntimeError(f"{command[0]} is not installed: it is needed for notes without HTML")
        self.command, self.suffix, self.timeout = command, suffix, timeout

    def convert(self, pages: list[bytes]) -> list[str]:
        out = []
        for page in pages:
            with tempfile.TemporaryDirectory() as folder:
                source = Path(folder, f"page{self.suffix}")
                source.write_bytes(page)
                try:
                    subprocess.run([*self.command, "-p", str(source), "-o", folder], check=True, timeout=self.timeout, capture_output=True)
                except subprocess.TimeoutExpired as error:
                    raise TimeoutError(f"no result after {self.timeout:g} s") from error
                made = Path(folder, "page", "auto")
                figures = {str(f.relative_to(made / "images")): f.read_bytes() for f in sorted((made / "images").rglob("*")) if f.is_file()}
                out.append(Page((made / "page.md").read_text(encoding="utf-8"), figures))
        return out


class ServerEngine:
    """An OCR program kept running as a server between calls: started once, asked by call(address, page), stopped at the worker's end."""

    def __init__(self, command: Callable[[int], list[str]], healthy: Callable[[str], bool], call: Callable[[str, bytes], str], wait: float = 300.0, grace: float = 15.0):
        import atexit
        import socket
        import time

        with socket.socket() as s:
            s.bind(("127.0.0.1", 0))
            port = s.getsockname()[1]
        self.address, self.call, self.grace = f"http://127.0.0.1:{port}", call, grace
        self.process = subprocess.Popen(command(port))
        atexit.register(self.stop)
        end = time.monotonic() + wait
        while not healthy(self.address):
            if self.process.poll() is not None or time.monotonic() > end:
                self.stop()
                raise RuntimeError("the OCR server did not start")
            time.sleep(1.0)

    def stop(self) -> None:
        if self.process.poll() is None:
            self.process.terminate()
            try:
                self.process.wait(self.grace)
            except subprocess.TimeoutExpired:
                self.process.kill()

    def convert(self, pages: list[bytes]) -> list[str]:
        return [self.call(self.address, page) for page in pages]


FIGURES = "array<struct<name:string,content:binary>>"


def ocr_pages(images: DataFrame, factory: Callable[[], Engine], key: str = "cod_nota", stem: str | None = None, folder: Column | None = None) -> DataFrame:
    """(key, pos, markdown, status, folder, figures) of images (key, pos, content[, status]).

    A page that times out or fails has no Markdown and says so; one without content keeps its status, or is a missing_page. An engine that
    can't be made ends the job, before any page is read. Links to figures are led to ``folder``, nota-<key>_images/<page> unless given; a
    column named ``stem`` names the page, else its position does.
    """
    kind = images.schema[key].dataType.simpleString()
    schema = f"key {kind}, pos long, markdown string, status string, folder string, figures {FIGURES}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engine = None
        for batch in batches:
            rows = []
            for k, pos, content, status, folder in batch.itertuples(index=False, name=None):
                if content is None:
                    rows.append((k, pos, None, status if isinstance(status, str) else "missing_page", None, None))
                    continue
                engine = engine or worker_engine(factory)
                try:
                    made = engine.convert([content])[0]
                except TimeoutError:
                    rows.append((k, pos, None, "timeout", None, None))
                except Exception as error:  # noqa: BLE001  one page must not end the job
                    rows.append((k, pos, None, f"error: {error}", None, None))
                else:
                    figures = [{"name": n, "content": c} for n, c in getattr(made, "figures", {}).items()]
                    rows.append((k, pos, str(made), "ok", folder if figures else None, figures))
            yield pd.DataFrame(rows, columns=["key", "pos", "markdown", "status", "folder", "figures"])

    status = F.when(F.col("status") != "ok", F.col("status")) if "status" in images.columns else F.lit(None).cast("string")
    if folder is None:
        folder = F.concat(F.lit("nota-"), F.col(key).cast("string"), F.lit("_images/"), F.col(stem) if stem else F.col("pos").cast("string"))
    pages = images.select(F.col(key).alias("key"), F.col("pos").cast("long").alias("pos"), "content", status.alias("status"), folder.alias("folder"))
    read = pages.mapInPandas(run, schema)
    linked = F.when(F.col("folder").isNotNull(), sinks.relink_figures(F.col("markdown"), F.col("folder"))).otherwise(F.col("markdown"))
    return read.withColumn("markdown", linked).withColumnRenamed("key", key)


def page_status(pages: DataFrame) -> DataFrame:
    """(cod_nota, status): the status of each note's first page that is not ok, else ok."""
    bad = F.col("status") != "ok"
    return pages.groupBy("cod_nota").agg(F.coalesce(F.min_by(F.when(bad, F.col("status")), F.when(bad, F.col("pos"))), F.lit("ok")).alias("status"))


def from_pages(pages: DataFrame, notes: DataFrame, min_confidence: float = 0.6, tables: bool = True) -> DataFrame:
    """(cod_nota, markdown, full_markdown, status): OCR pages of a note joined in order, HTML tables converted, cut at the titles.

    notes: cod_nota, titulo, titulo_siguiente. A note with a failed page has the first such page's status and no Markdown.
    """
    whole = ix.join_pages(pages, "cod_nota", "pos", "markdown")
    full = udfs.tables_to_md(F.col("markdown")) if tables else F.col("markdown")
    rows = whole.select("cod_nota", full.alias("full_markdown")).join(page_status(pages), "cod_nota").join(notes.select("cod_nota", "titulo", "titulo_siguiente"), "cod_nota")
    cut = udfs.cut_note(F.col("full_markdown"), F.col("titulo"), F.col("titulo_siguiente"), min_confidence)
    return rows.select("cod_nota", F.when(F.col("status") == "ok", cut).alias("markdown"), "full_markdown", "status")


def note_images(notes: DataFrame, listings: DataFrame, contents: DataFrame) -> DataFrame:
    """(cod_nota, pos, nombre_archivo, content, status) of each note's pages.

    notes: the whole index with stubs; listings: (cod_diario, pos, page, nombre_archivo); contents: (nombre_archivo, content).
    """
    pages = ix.explode_pages(ix.page_spans(notes)).select("cod_nota", "cod_diario", "page")
    found = ix.page_images(pages, listings, ["cod_diario"])
    return found.join(contents, "nombre_archivo", "left").select("cod_nota", F.col("page").alias("pos"), "nombre_archivo", "content", F.when(F.col("content").isNull(), "missing_page").otherwise(F.col("status")).alias("status"))


def pypdf_pages(pdf: bytes, pages: list[int]) -> bytes:
    """The pages (counted from 1) of a PDF as one PDF; a page that it doesn't have is an error."""
    import io

    if importlib.util.find_spec("pypdf") is None:
        raise RuntimeError("pypdf is not installed: it is needed to cut notes out of an edition's PDF")
    from pypdf import PdfReader, PdfWriter

    reader, writer = PdfReader(io.BytesIO(pdf)), PdfWriter()
    for page in pages:
        if not 1 <= page <= len(reader.pages):
            raise ValueError(f"the edition has {len(reader.pages)} pages, not page {page}")
        writer.add_page(reader.pages[page - 1])
    out = io.BytesIO()
    writer.write(out)
    return out.getvalue()


def note_pdfs(notes: DataFrame, editions: DataFrame, split: Callable[[bytes, list[int]], bytes] = pypdf_pages) -> DataFrame:
    """(cod_nota, content, status): each note's pages cut out of its edition's PDF.

    notes: the whole index, or (cod_nota, cod_diario, pages) where the pages are known; editions: (cod_diario, content).
    """
    spans = notes if "pages" in notes.columns else ix.page_spans(notes)
    spans = spans.select("cod_nota", "cod_diario", "pages").join(editions, "cod_diario")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for note, pages, content in zip(batch["cod_nota"], batch["pages"], batch["content"], strict=True):
                try:
                    rows.append((note, None, "missing_page") if content is None or not len(pages) else (note, split(content, [int(p) for p in pages]), "ok"))
                except ValueError as error:
                    rows.append((note, None, f"error: {error}"))
            yield pd.DataFrame(rows, columns=["cod_nota", "content", "status"])

    return spans.select("cod_nota", "pages", "content").mapInPandas(run, "cod_nota long, content binary, status string")


def pdf_pages(pdfs: DataFrame) -> DataFrame:
    """(cod_nota, pos, content, status): a note's PDF is read as one page."""
    return pdfs.select("cod_nota", F.lit(0).alias("pos"), "content", "status")


def build_markdown(details: DataFrame, notes: DataFrame, images: DataFrame | None = None, factory: Callable[[], Engine] | None = None, pdfs: DataFrame | None = None, source: str = "auto", min_confidence: float = 0.6, read: dict[str, DataFrame] | None = None) -> DataFrame:
    """(cod_nota, route, markdown, full_markdown, status) of notes.

    details: cod_nota, cadena_contenido; notes: the whole index with stubs; images and pdfs: (cod_nota, pos, content) of the pages. Titles come
    from the index, so that the next one of each note is known. Pages that an engine has read already come by route in ``read``. A note whose route
    has no pages has status missing_pages.
    """
    routed = a.with_route(details, source)
    html = routed.where("route = 'html'").select("cod_nota", "route", udfs.html_to_md(F.col("cadena_contenido")).alias("markdown"), F.lit(None).cast("string").alias("full_markdown"), F.lit("ok").alias("status"))
    failed = routed.where("route = 'error'").select("cod_nota", "route", F.lit(None).cast("string").alias("markdown"), F.lit(None).cast("string").alias("full_markdown"), F.lit("no_html").alias("status"))
    out = html.unionByName(failed)
    titles = ix.next_titled(notes).select("cod_nota", "titulo", "titulo_siguiente")
    for route, pages in (("image", images), ("pdf", pdfs)):
        wanted = routed.where(F.col("route") == route).select("cod_nota", "route")
        known = (read or {}).get(route)
        if known is not None:
            made = from_pages(known.join(wanted.select("cod_nota"), "cod_nota", "left_semi"), titles, min_confidence)
        elif pages is None or factory is None:
            made = wanted.select("cod_nota", F.lit(None).cast("string").alias("markdown"), F.lit(None).cast("string").alias("full_markdown"), F.lit(None).cast("string").alias("status"))
        else:
            made = from_pages(ocr_pages(pages.join(wanted.select("cod_nota"), "cod_nota", "left_semi"), factory), titles, min_confidence)
        rows = wanted.join(made, "cod_nota", "left")
        out = out.unionByName(rows.select("cod_nota", "route", "markdown", "full_markdown", F.coalesce("status", F.lit("missing_pages")).alias("status")))
    return out
