"""Index operators on crafted rows."""

import pytest
from pyspark.sql import functions as F

from diurna.operators import assets as a
from diurna.operators import index as ix
from diurna.schemas import DAY_INDEX


def note(cod, titulo="t", fecha="02-01-1917", pagina=1, **more):
    return {"codNota": cod, "titulo": titulo, "fecha": fecha, "pagina": pagina, **more}


def days(spark, *rows):
    return spark.createDataFrame(list(rows), DAY_INDEX)


def test_explode_and_filters(spark):
    d = days(spark, {"NotasMatutinas": [note(2, None), note(1, ""), note(3, " ")], "NotasVespertinas": None, "NotasExtraordinarias": [note(4, "x", "31-02-2024")]}, {"messageCode": 200, "NotasMatutinas": []})
    notes = ix.explode_index(d)
    assert [(r.cod_nota, r.cod_edicion, r.note_pos) for r in notes.collect()] == [(2, "MAT", 0), (1, "MAT", 1), (3, "MAT", 2), (4, "EXT", 0)]
    assert [(r.cod_nota, r.fecha) for r in ix.drop_untitled(notes).collect()][1] == (4, None)
    assert ix.title_records(notes).columns == ["cod_nota", "titulo", "fecha", "cod_orga_uno"]
    nested = ix.drop_untitled_nested(d).collect()
    assert [n.codNota for n in nested[0].NotasMatutinas] == [3] and nested[0].NotasVespertinas is None and nested[1].messageCode == 200
    assert ix.explode_index(d.drop("NotasExtraordinarias")).count() == 3


def notes(spark, rows):
    return spark.createDataFrame([(c, "2024-01-02", e, p, t, k) for k, (c, e, p, t) in enumerate(rows)], "cod_nota long, fecha string, cod_edicion string, pagina int, titulo string, note_pos int")


def test_page_spans(spark):
    rows = [(5, "MAT", 9, "last"), (1, "MAT", 3, "same"), (2, "MAT", 3, "next page"), (3, "MAT", 4, "far"), (4, "MAT", 12, "back"), (7, "VES", 1, "alone"), (8, "EXT", None, "none")]
    got = {r.cod_nota: r.pages for r in ix.page_spans(notes(spark, rows)).collect()}
    assert got == {1: [3], 2: [3, 4], 3: list(range(4, 13)), 4: [], 5: [9], 7: [1], 8: None}
    assert ix.explode_pages(ix.page_spans(notes(spark, rows))).count() == 1 + 2 + 9 + 0 + 1 + 1


def test_next_titled(spark):
    rows = [(3, "MAT", 1, None), (1, "MAT", 1, "one"), (2, "MAT", 1, ""), (4, "MAT", 1, "four"), (5, "MAT", 1, None), (6, "VES", 1, "six")]
    assert {r.cod_nota: r.titulo_siguiente for r in ix.next_titled(notes(spark, rows)).collect()} == {1: "four", 2: "four", 3: "four", 4: None, 5: None, 6: None}


def test_page_images(spark):
    pages = spark.createDataFrame([(1, 7, 1), (1, 7, 2), (2, 8, 1)], "cod_nota long, cod_diario long, page long")
    images = spark.createDataFrame([(7, 1, "old", 0), (7, 1, "new", 5), (8, 2, "x", 0)], "cod_diario long, page long, nombre_archivo string, pos int")
    got = sorted(map(tuple, ix.page_images(pages, images, ["cod_diario"]).select("cod_nota", "page", "nombre_archivo", "status").collect()), key=str)
    assert got == [(1, 1, "new", "ok"), (1, 2, None, "missing_page"), (2, 1, None, "missing_page")]
    with pytest.raises(Exception, match="no image of page"):
        ix.page_images(pages, images, ["cod_diario"], strict=True).collect()


def test_index_entries(spark):
    n = notes(spark, [(1, "MAT", 3, "later twin"), (2, "MAT", 4, "two")]).unionByName(notes(spark, [(1, "MAT", 9, "x")]).withColumn("note_pos", F.lit(-1)))
    details = spark.createDataFrame([(1, "2024-01-02", "MAT"), (7, "2024-01-02", "MAT")], "cod_nota long, fecha string, cod_edicion string")
    assert {r.cod_nota: r.entry and r.entry.titulo for r in ix.index_entries(details, n).collect()} == {1: "x", 7: None}
    with pytest.raises(Exception, match="not in the index"):
        ix.index_entries(details, n, strict=True).collect()


def test_calendar_and_missing_days(spark):
    done = spark.sql("select date '2024-02-28' as fecha union all select date '2024-02-28'")
    assert [str(r.fecha) for r in ix.missing_days(spark, "2024-02-27", "2024-03-01", done).orderBy("fecha").collect()] == ["2024-02-27", "2024-02-29", "2024-03-01"]
    assert ix.calendar(spark, "2024-03-02", "2024-03-01").count() == 0
    assert ix.closed_days(ix.calendar(spark, "2024-03-01", "2024-03-03"), "2024-03-02").count() == 1


def test_first_names(spark):
    rows = [("b", 0, "A", "second", "t"), ("a", 1, "A", "first", "t"), ("a", 0, "A", "untitled", None), ("a", 0, None, "x", "t"), ("a", 0, "B", "", "t"), ("c", 0, "B", "bee", "t")]
    n = spark.createDataFrame(rows, "asset string, note_pos int, cod_orga_uno string, nombre_cod_orga_uno string, titulo string")
    assert {tuple(r) for r in ix.first_names(n, "asset", "note_pos").collect()} == {("A", "first"), ("B", "bee")}


def test_statistics_and_totals(spark):
    o = spark.createDataFrame([("ok",), ("ok",), ("retry",), ("no_edition",)], "status string")
    assert tuple(ix.run_statistics(o).first()) == (4, 2, 1, 1)
    assert {tuple(r) for r in ix.counts_with_total(o, "status").collect()} == {("ok", 2), ("retry", 1), ("no_edition", 1), (None, 4)}


def test_join_pages(spark):
    p = spark.createDataFrame([(1, 2, " b \n"), (1, 1, " a"), (1, 3, None)], "k int, pos int, markdown string")
    assert ix.join_pages(p, "k").first()["markdown"] == "a\n\nb\n\n\n"


def test_routes_and_signatures(spark):
    d = spark.createDataFrame([(1, "<p>"), (2, ""), (3, None)], "cod_nota int, cadena_contenido string")
    route = lambda source: [r.route for r in a.with_route(d, source).orderBy("cod_nota").collect()]
    assert route("auto") == ["html", "image", "image"] and route("html") == ["html", "error", "error"] and route("pdf") == ["pdf"] * 3
    with pytest.raises(ValueError, match="source"):
        a.with_route(d, "fax")
    f = spark.createDataFrame([(bytearray(b"%PDF-1"),), (bytearray(b"\xff\xd8\xff\xe0"),), (bytearray(b"<html>"),), (None,)], "content binary")
    assert [r.status for r in a.valid_files(f, "pdf").collect()] == ["ok", "invalid", "invalid", "invalid"]
    assert [r.s for r in f.select(a.has_signature(F.col("content"), "jpeg").alias("s")).collect()] == [False, True, False, False]


def test_inventory(spark):
    r = spark.createDataFrame([([("x-2024.tgz", "u1", 1090000), ("x-2026-03.tgz", "u2", 50000), ("notes.txt", "u3", 1)],)], "assets array<struct<name string, browser_download_url string, size bigint>>")
    assert [tuple(x) for x in a.archives(r).collect()] == [("x-2024.tgz", "u1"), ("x-2026-03.tgz", "u2")]
    n = spark.createDataFrame([("x-2024.tgz", 1090000), ("x-2026-03.tgz", 50000)], "name string, size long")
    assert [tuple(x) for x in a.inventory(n).collect()] == [("x-2024.tgz", "2024", "year", 1.09), ("x-2026-03.tgz", "2026-03", "month", 0.05)]
    assert a.last_by_name(n, 1).first()["asset"] == "x-2026-03.tgz"
    assert a.edition_url("b", F.lit("x"), F.lit("y")) is not None
