"""What the engine writes: partitioned tables, JSON lines and single files under exact names."""

from __future__ import annotations

import io
import json
import tarfile
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.index import title_records


def day_file(date: Column) -> Column:
    """YYYY/DDMMYYYY-notas.json"""
    return F.concat(F.date_format(date, "yyyy"), F.lit("/"), F.date_format(date, "ddMMyyyy"), F.lit("-notas.json"))


def pretty(text: str) -> str:
    """JSON with two blanks of indent and characters as they are."""
    return json.dumps(json.loads(text), ensure_ascii=False, indent=2)


def pretty_json(column: Column) -> Column:
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else pretty(t))

    return run(column)


def _write(root: str, rows: Iterable) -> None:
    from pyarrow import fs

    system, base = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)
    for row in rows:
        path = f"{base.rstrip('/')}/{row['path']}"
        system.create_dir(path.rpartition("/")[0], recursive=True)
        with system.open_output_stream(path) as out:
            content = row["content"]
            out.write(content.encode("utf-8") if isinstance(content, str) else bytes(content))


def export_files(files: DataFrame, root: str) -> None:
    """Each row (path, content) as one file below root, written by the tasks; root is a path that all of them share."""
    files.select("path", "content").foreachPartition(lambda rows: _write(root, rows))


def day_files(days: DataFrame) -> DataFrame:
    """(path, content) of day indexes (fecha, body), pretty-printed."""
    return days.select(day_file(F.col("fecha")).alias("path"), pretty_json(F.col("body")).alias("content"))


def archive_files(members: DataFrame, key: str) -> DataFrame:
    """(path, content): members (key, member, body) as one gzipped tar archive per key, in the order of their names; a year's day indexes are some hundreds."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        with tarfile.open(fileobj=out, mode="w:gz") as archive:
            for name, body in sorted(zip(rows["member"], rows["body"], strict=True)):
                data = body.encode("utf-8")
                entry = tarfile.TarInfo(name)
                entry.size = len(data)
                archive.addfile(entry, io.BytesIO(data))
        return pd.DataFrame({"path": [f"{rows['key'].iloc[0]}.tgz"], "content": [out.getvalue()]})

    return members.select(F.col(key).alias("key"), "member", "body").groupBy("key").applyInPandas(pack, "path string, content binary")


def write_days(days: DataFrame, root: str) -> None:
    """Day indexes as JSON lines by year. A year is replaced as a whole: days must hold all of each year that it holds any day of."""
    days.withColumn("anio", F.year("fecha")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("anio").json(root)


def write_titles(notes: DataFrame, path: str) -> None:
    """Title records as gzipped JSON lines; absent values are written as null."""
    records = title_records(notes).select(F.col("cod_nota").alias("codNota"), "titulo", F.date_format("fecha", "dd-MM-yyyy").alias("fecha"), F.col("cod_orga_uno").alias("codOrgaUno"))
    records.write.mode("overwrite").option("compression", "gzip").option("ignoreNullFields", False).json(path)


def names_json(names: DataFrame) -> DataFrame:
    """One row: the organisms' names by code as a JSON object, in order of codes. The dimension has a few hundred rows."""
    entries = F.array_sort(F.collect_list(F.struct("cod_orga_uno", "nombre")))
    return names.agg(F.to_json(F.map_from_entries(entries)).alias("content"))


def note_json(notes: DataFrame, columns: list[str]) -> DataFrame:
    """(path, content): notes wrapped as {"Nota": ..}."""
    wrapped = F.to_json(F.struct(F.struct(*columns).alias("Nota")), {"ignoreNullFields": "false"})
    return notes.select(F.concat(F.lit("nota-"), F.col("cod_nota").cast("string"), F.lit(".json")).alias("path"), pretty_json(wrapped).alias("content"))


def markdown_files(notes: DataFrame, keep_pages: bool = False) -> DataFrame:
    """(path, content) of notes (cod_nota, markdown[, full_markdown]); the uncut text beside it where asked for and there."""
    name = F.concat(F.lit("nota-"), F.col("cod_nota").cast("string"))
    out = notes.select(F.concat(name, F.lit(".md")).alias("path"), F.concat(F.col("markdown"), F.lit("\n")).alias("content"))
    if keep_pages:
        out = out.unionByName(notes.where("full_markdown is not null").select(F.concat(name, F.lit(".full.md")).alias("path"), F.col("full_markdown").alias("content")))
    return out


def image_files(images: DataFrame) -> DataFrame:
    """(path, content) of page images (cod_nota, nombre_archivo, content)."""
    return images.select(F.concat(F.lit("nota-"), F.col("cod_nota").cast("string"), F.lit("-"), "nombre_archivo", F.lit(".jpg")).alias("path"), "content")


def note_pdf_files(pdfs: DataFrame) -> DataFrame:
    """(path, content) of notes' own PDFs (cod_nota, content)."""
    return pdfs.where("content is not null").select(F.concat(F.lit("nota-"), F.col("cod_nota").cast("string"), F.lit(".pdf")).alias("path"), "content")


def figure_files(pages: DataFrame) -> DataFrame:
    """(path, content) of the figures that an engine found on pages (folder, figures)."""
    found = pages.where("folder is not null").select("folder", F.explode("figures").alias("f"))
    return found.select(F.concat_ws("/", "folder", "f.name").alias("path"), F.col("f.content").alias("content"))


def relink_figures(markdown: Column, folder: Column) -> Column:
    """Links to the OCR engine's figures, led to the folder they are copied to."""
    return F.replace(markdown, F.lit("](images/"), F.concat(F.lit("]("), folder, F.lit("/")))


def append_ledger(days: DataFrame, path: str) -> None:
    """Completed days, one ISO date a line, added to the ledger's folder."""
    days.select(F.date_format("fecha", "yyyy-MM-dd").alias("value")).write.mode("append").text(path)
