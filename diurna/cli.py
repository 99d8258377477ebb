"""Command line: answers of the service, the archive, titles, notes' pages, and Markdown jobs."""

from __future__ import annotations

import argparse
import datetime as dt
import functools
import json
import shlex
import sys

from pyspark.sql import functions as F

SOURCES = ("auto", "html", "image", "pdf")


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="diurna", description=__doc__)
    jobs = out.add_subparsers(dest="job", required=True)
    day = dt.date.fromisoformat

    fetch = jobs.add_parser("fetch", help="answers of the service, one file a key")
    fetch.add_argument("keys", nargs="+", help="dates (YYYY-MM-DD), numbers, or EDITION/NAME of a page's image")
    fetch.add_argument("--endpoint", choices=["diario", "notas", "indicadores", "nota", "imagenes", "pdf", "imagen"], default="notas")

    note = jobs.add_parser("note", help="notes by number: their JSON where they have HTML, else their page images")
    pages = jobs.add_parser("pages", help="notes by number: their page images, or their PDF")
    pages.add_argument("--kind", choices=["image", "pdf"], default="image")
    for job in (note, pages):
        job.add_argument("numbers", nargs="+", type=int)

    archive = jobs.add_parser("archive", help="fetch the days of a range that the ledger doesn't hold")
    archive.add_argument("--first", type=day, default=day("1917-01-02"))
    archive.add_argument("--last", type=day)
    archive.add_argument("--as-of", type=day, default=dt.date.today())
    archive.add_argument("--pause", type=float, default=0.5)

    titles = jobs.add_parser("titles", help="title dataset from archives")
    titles.add_argument("archives")

    markdown = jobs.add_parser("markdown", help="notes to Markdown files")
    markdown.add_argument("notes", nargs="+", help="saved note files, or numbers to ask the service for")
    markdown.add_argument("--index", help="saved day indexes; without them they are asked for where the service is known")
    markdown.add_argument("--source", choices=SOURCES, default="auto")
    markdown.add_argument("--min-confidence", type=float, default=0.6)
    markdown.add_argument("--keep-pages", action="store_true")

    edition = jobs.add_parser("edition", help="an edition's PDF and its Markdown")
    edition.add_argument("date", type=day)
    edition.add_argument("--edition", choices=["MAT", "VES"], default="MAT")
    edition.add_argument("--site", required=True, help="address of the site's download page")

    tables = jobs.add_parser("tables", help="HTML tables in Markdown files to Markdown tables")
    tables.add_argument("files")

    for job in (fetch, archive, note, pages):
        job.add_argument("--base", required=True, help="address of the service")
    markdown.add_argument("--base", help="address of the service, for numbers and for pages without HTML")
    for job in (markdown, edition):
        job.add_argument("--engine", help="OCR command; it gets -p FILE -o FOLDER")
        job.add_argument("--timeout", type=float, default=3600.0, help="seconds an engine may take for a page")
    for job in jobs.choices.values():
        job.add_argument("--outdir", default=".")
    return out


def _engine(args: argparse.Namespace, suffix: str, given):
    """A factory of engines; one whose program isn't here either ends the job before anything is fetched."""
    from .plans.markdown import CommandEngine

    if given is not None or not args.engine:
        return given
    factory = functools.partial(CommandEngine, shlex.split(args.engine), suffix, args.timeout)
    factory()
    return factory


def _fetch(args, spark, transport) -> int:
    from . import sinks
    from .sources import service

    dated, kind = args.endpoint in service.BY_DATE, service.BINARY.get(args.endpoint)
    keys = spark.createDataFrame([(k,) for k in args.keys], "text string").select("text", (F.to_date("text") if dated else F.col("text")).alias("key"))
    found = service.ask(keys, args.base, args.endpoint, f"{args.outdir}/_work/{args.endpoint}", transport)
    stem = F.date_format("key", "ddMMyyyy") if dated else F.regexp_replace(F.col("key"), "^.*/", "")
    name = F.concat(stem, F.lit({"pdf": ".pdf", "jpeg": ".jpg", None: f"-{args.endpoint}.json"}[kind]))
    good = found.where("status = 'ok'")
    sinks.export_files(good.select(name.alias("path"), F.col("body").alias("content") if kind else sinks.pretty_json(F.decode("body", "UTF-8")).alias("content")), args.outdir)
    failed = found.where("status <> 'ok'").select("text", "status", "error").collect()
    for r in failed:
        print(f"{r.text}: {r.error or r.status}", file=sys.stderr)
    return int(bool(failed))


def _pages(args, spark, transport, split) -> int:
    """Jobs note and pages."""
    from . import sinks
    from .operators import assets
    from .plans import jobs, markdown

    at = jobs.Service(spark, args.base, f"{args.outdir}/_work", transport)
    details = assets.with_route(jobs.details(at, args.numbers), "auto" if args.job == "note" else args.kind)
    known = {r["cod_nota"] for r in details.select("cod_nota").collect()}
    missing = [n for n in args.numbers if n not in known]
    for n in missing:
        print(f"{n}: no such note", file=sys.stderr)
    bad = 0
    html = details.where("route = 'html'")
    if args.job == "note" and not html.isEmpty():
        full = html.select("cod_nota", F.col("cod_nota").alias("codNota"), "titulo", F.col("cod_edicion").alias("codEdicion"), F.date_format("fecha", "dd-MM-yyyy").alias("fecha"), F.col("cod_diario").alias("codDiario"), "pagina", F.col("cadena_contenido").alias("cadenaContenido"))
        sinks.export_files(sinks.note_json(full, full.columns[1:]), args.outdir)
    rest = details.where("route <> 'html'")
    if not rest.isEmpty():
        index = jobs.day_notes(at, rest)
        if args.job == "pages" and args.kind == "pdf":
            found = jobs.pdfs(at, rest, index, split or markdown.pypdf_pages)
            sinks.export_files(sinks.note_pdf_files(found), args.outdir)
        else:
            found = jobs.images(at, rest, index)
            sinks.export_files(sinks.image_files(found.where("content is not null")), args.outdir)
        for r in found.where("status <> 'ok'").select("cod_nota", "status").collect():
            bad += 1
            print(f"{r.cod_nota}: {r.status}", file=sys.stderr)
    return int(bool(missing or bad))


def _markdown(args, spark, transport, engine, split) -> int:
    from . import sinks
    from .operators import index as ix
    from .plans import jobs, markdown
    from .sources import files

    factory = _engine(args, ".pdf" if args.source == "pdf" else ".jpg", engine)
    at = jobs.Service(spark, args.base, f"{args.outdir}/_work", transport) if args.base else None
    numbers = [int(n) for n in args.notes if n.isdigit()]
    if numbers and at is None:
        raise SystemExit("numbers need --base")
    saved = [n for n in args.notes if not n.isdigit()]
    frames = ([jobs.details(at, numbers)] if numbers else []) + ([files.note_details(spark, saved)] if saved else [])
    details = functools.reduce(lambda a, b: a.unionByName(b), frames)
    index = ix.explode_index(files.day_indexes(spark, args.index)) if args.index else None
    made = jobs.note_markdown(at, details, index, factory, args.source, args.min_confidence, split or markdown.pypdf_pages)
    sinks.export_files(sinks.markdown_files(made.notes.where("status = 'ok'"), args.keep_pages), args.outdir)
    if made.pages is not None:
        sinks.export_files(sinks.figure_files(made.pages), args.outdir)
    failed = made.notes.where("status <> 'ok'").select("cod_nota", "route", "status").collect()
    for r in failed:
        print(f"{r.cod_nota} ({r.route}): {r.status}", file=sys.stderr)
    return int(bool(failed))


def _edition(args, spark, transport, engine) -> int:
    from . import sinks
    from .plans import jobs

    pdf, read = jobs.edition_markdown(spark, args.site, args.date.isoformat(), args.edition, f"{args.outdir}/_work", _engine(args, ".pdf", engine), transport)
    sinks.export_files(pdf.where("status = 'ok'"), args.outdir)
    failed = pdf.where("status <> 'ok'").select("path", "status").collect()
    if read is not None:
        sinks.export_files(read.where("status = 'ok'"), args.outdir)
        sinks.export_files(sinks.figure_files(read), args.outdir)
        failed += read.where("status <> 'ok'").select("path", "status").collect()
    for r in failed:
        print(f"{r.path}: {r.status}", file=sys.stderr)
    return int(bool(failed))


def main(argv: list[str] | None = None, transport=None, spark=None, engine=None, split=None) -> int:
    """Transport, engine factory and PDF splitter can be given instead of the built-in ones."""
    args = parser().parse_args(argv)
    from . import sinks
    from .functions import udfs
    from .plans import titles
    from .session import local_session
    from .sources import service
    from .streaming import archive

    spark = spark or local_session()
    transport = transport or service.http
    match args.job:
        case "fetch":
            return _fetch(args, spark, transport)
        case "note" | "pages":
            return _pages(args, spark, transport, split)
        case "markdown":
            return _markdown(args, spark, transport, engine, split)
        case "edition":
            return _edition(args, spark, transport, engine)
        case "archive":
            run = archive.update_archive(spark, args.outdir, f"{args.outdir}/completados", args.as_of.isoformat(), args.first.isoformat(), (args.last or args.as_of).isoformat(), args.base, transport, args.pause)
            print(json.dumps(run.statistics))
        case "titles":
            counts = titles.publish(titles.build(spark, args.archives, f"{args.outdir}/_silver"), f"{args.outdir}/titulos.jsonl.gz")
            print(json.dumps({k or "total": n for k, n in counts.items()}))
        case "tables":
            rows = spark.read.text(args.files, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1).alias("path"), udfs.tables_to_md(F.col("value")).alias("content"))
            sinks.export_files(rows, args.outdir)
    return 0


if __name__ == "__main__":
    sys.exit(main())
