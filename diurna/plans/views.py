"""A view of the driver's documents as gazette notes, deterministic and the same in SQL."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import DAY_INDEX, EDITIONS

NOTES_SQL = """
    select doc_id as cod_nota,
           date '1917-01-02' + cast(doc_id // 40 as integer) as fecha,
           case doc_id % 3 when 0 then 'MAT' when 1 then 'VES' else 'EXT' end as cod_edicion,
           case when doc_id % 6 = 0 then null else substr(split_part(text, chr(10), 1), 1, 200) end as titulo,
           source as cod_orga_uno, lang, n_chars,
           1 + cast(floor(coalesce(sum(n_chars) over (partition by doc_id // 40, doc_id % 3 order by doc_id rows between unbounded preceding and 1 preceding), 0) / 4000.0) as bigint) as pagina
    from documents"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def notes_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir)
    own = d.select(
        F.col("doc_id").alias("cod_nota"),
        F.expr("date_add(date '1917-01-02', cast(floor(doc_id / 40) as int))").alias("fecha"),
        F.when(F.col("doc_id") % 3 == 0, "MAT").when(F.col("doc_id") % 3 == 1, "VES").otherwise("EXT").alias("cod_edicion"),
        F.when(F.col("doc_id") % 6 != 0, F.substring(F.substring_index("text", "\n", 1), 1, 200)).alias("titulo"),
        F.col("source").alias("cod_orga_uno"),
        "lang",
        "n_chars",
    )
    before = Window.partitionBy("fecha", "cod_edicion").orderBy("cod_nota").rowsBetween(Window.unboundedPreceding, -1)
    return own.withColumn("pagina", 1 + F.floor(F.coalesce(F.sum("n_chars").over(before), F.lit(0)) / F.lit(4000.0)).cast("bigint"))


def day_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The notes as the service has them: a row per day with the three lists, and the day itself. A day has at most forty notes."""
    given = {"codNota": F.col("cod_nota"), "titulo": F.col("titulo"), "fecha": F.date_format("fecha", "dd-MM-yyyy"), "codOrgaUno": F.col("cod_orga_uno"), "pagina": F.col("pagina").cast("int")}
    entry_type = DAY_INDEX[EDITIONS[0][0]].dataType.elementType
    entry = F.struct(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in entry_type])
    rows = notes_view(spark, sf_dir).select("fecha", "cod_edicion", "cod_nota", entry.alias("n"))
    days = rows.groupBy("fecha").agg(F.array_sort(F.collect_list(F.struct("cod_nota", "cod_edicion", "n"))).alias("all"))

    def of(code: str):
        return F.transform(F.filter("all", lambda x: x["cod_edicion"] == code), lambda x: x["n"])

    return days.select("fecha", *[of(code).alias(name) for name, code in EDITIONS])


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one that all machines share (spark.checkpoint.dir); a local run without that has one of its own."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/gazette/{name}-{uuid.uuid4().hex}"
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix=f"diurna-{name}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"{folder}/{name}"
