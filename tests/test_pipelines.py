"""Sources, sinks, the archive in batch and as a stream, titles, routes and the command line."""

import gzip
import io
import json
import tarfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from diurna import cli, sinks
from diurna.functions import udfs
from diurna.operators import index as ix
from diurna.plans import markdown, titles
from diurna.schemas import DAY_INDEX
from diurna.sources import files, service
from diurna.streaming import archive


def entry(cod, titulo="Título", fecha="02-01-2024", **more):
    return {"codNota": cod, "titulo": titulo, "fecha": fecha, "pagina": 1} | more


def index(*notes, **lists):
    return {"messageCode": 200, "response": "OK", "NotasMatutinas": list(notes), "NotasVespertinas": [], "NotasExtraordinarias": []} | lists


def tgz(path: Path, members: dict):
    with tarfile.open(path, "w:gz") as t:
        folder = tarfile.TarInfo("2024")
        folder.type = tarfile.DIRTYPE
        t.addfile(folder)
        for name, body in members.items():
            data = body if isinstance(body, bytes) else json.dumps(body, ensure_ascii=False).encode()
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))


def transport(url, timeout):
    """01: an edition, 02: none, 03: fails, 04: an edition, others: server error"""
    day = url.rsplit("/", 1)[-1]
    if day.startswith("03"):
        raise ConnectionError("down")
    if day.startswith("02"):
        return 404, b""
    if day[:2] in ("01", "04"):
        return 200, json.dumps(index(entry(int(day[:2]), fecha=day)), ensure_ascii=False).encode()
    return 500, b""


def test_archive_in_batch(spark, tmp_path):
    args = (spark, f"{tmp_path}/out", f"{tmp_path}/ledger", "2024-01-04", "2024-01-01", "2024-01-05", "http://s", transport, 0.0)
    run = archive.update_archive(*args)
    assert run.statistics == {"procesados": 5, "con_indice": 2, "sin_edicion": 1, "errores": 2}
    assert {str(r.fecha) for r in files.ledger(spark, f"{tmp_path}/ledger").collect()} == {"2024-01-01", "2024-01-02"}
    saved = (tmp_path / "out/2024/01012024-notas.json").read_text()
    assert json.loads(saved)["NotasMatutinas"][0]["titulo"] == "Título" and saved.startswith('{\n  "') and "Título" in saved
    again = archive.update_archive(*args)
    assert again.statistics["procesados"] == 3
    closed = archive.update_archive(*args[:3], "2024-01-03", "2024-01-01", "2024-01-02", *args[6:])
    assert closed.statistics["procesados"] == 0


def test_stream_equals_batch_and_takes_only_new_files(spark, tmp_path):
    folder, table = tmp_path / "days", str(tmp_path / "table")
    folder.mkdir()
    for d in (1, 2):
        (folder / f"0{d}012024-notas.json").write_text(json.dumps(index(entry(d, fecha=f"0{d}-01-2024"), entry(d + 10, None, fecha=f"0{d}-01-2024"))))

    def drain():
        q = archive.start(spark, str(folder), table, str(tmp_path / "checkpoint"))
        q.awaitTermination()
        return sorted((r.cod_nota, str(r.fecha)) for r in spark.read.parquet(table).collect())

    batch = ix.explode_index(files.day_indexes(spark, str(folder)))
    assert drain() == sorted((r.cod_nota, str(r.fecha)) for r in batch.collect())
    assert len(drain()) == 4
    (folder / "02012024-notas-2.json").write_text(json.dumps(index(entry(99, fecha="02-01-2024"))))
    assert drain() == [(1, "2024-01-01"), (11, "2024-01-01"), (99, "2024-01-02")]


def test_titles(spark, tmp_path):
    tgz(tmp_path / "b-2024.tgz", {"2024/02012024-notas.json": index(entry(2, "dos", codOrgaUno="X", nombreCodOrgaUno="later"), entry(3, None)), "2024/read.me": b"x"})
    tgz(tmp_path / "a-2023.tgz", {"2023/02012023-notas.json": index(entry(1, "uno", None, codOrgaUno="X", nombreCodOrgaUno="Primera")), "2023/x.json": {"messageCode": 404}})
    (tmp_path / "c.txt").write_text("x")
    made = titles.build(spark, str(tmp_path), str(tmp_path / "silver"))
    out = tmp_path / "titulos.jsonl.gz"
    assert titles.publish(made, str(out)) == {"a-2023.tgz": 1, "b-2024.tgz": 1, None: 2}
    lines = [json.loads(x) for p in out.glob("*.json.gz") for x in gzip.open(p, "rt", encoding="utf-8")]
    assert sorted(lines, key=lambda x: x["codNota"]) == [{"codNota": 1, "titulo": "uno", "fecha": None, "codOrgaUno": "X"}, {"codNota": 2, "titulo": "dos", "fecha": "02-01-2024", "codOrgaUno": "X"}]
    assert json.loads((tmp_path / "titulos.jsonl.gz-organigrama.json").read_text()) == {"X": "Primera"}
    assert {r.titulo for r in files.titles(spark, str(out)).collect()} == {"uno", "dos"}


def test_saved_files(spark, tmp_path):
    (tmp_path / "n.json").write_text(json.dumps({"Nota": {"codNota": 7, "titulo": "t", "codEdicion": "MAT", "fecha": "02-01-2024", "cadenaContenido": "<p>x"}}))
    assert files.note_details(spark, f"{tmp_path}/n.json").first()["cadena_contenido"] == "<p>x"
    (tmp_path / "i.json").write_text(json.dumps({"imagenesFS": [{"codImagen": 1, "pagina": 3, "nombreArchivo": "p3"}]}))
    assert files.image_listings(spark, f"{tmp_path}/i.json").select("page", "nombre_archivo").first() == (3, "p3")
    assert files.opaque(spark, f"{tmp_path}/i.json").selectExpr("variant_get(payload, '$.imagenesFS[0].pagina', 'int') as p").first()["p"] == 3
    (tmp_path / "bad.json").write_text("<html>")
    assert files.day_indexes(spark, f"{tmp_path}/bad.json").first()["_corrupt_record"] == "<html>"
    assert files.ledger(spark, f"{tmp_path}/none").count() == 0
    (tmp_path / "ledger").write_text("2024-01-02\n\n 2024-01-02 \n2024-01-03\n")
    assert files.ledger(spark, f"{tmp_path}/ledger").count() == 2
    tgz(tmp_path / "m.tgz", {"a.json": {"x": 1}})
    files.register_archive_function(spark)
    files.binaries(spark, f"{tmp_path}/m.tgz").createOrReplaceTempView("blobs")
    assert [tuple(r) for r in spark.sql("select m.member, m.body from blobs, lateral tgz_members(content) m").collect()] == [("a.json", '{"x": 1}')]


def test_service_source(spark):
    service.register(spark, transport, "gazette_test")
    got = spark.read.format("gazette_test").option("base", "http://s/").option("endpoint", "notas").option("keys", "01-01-2024,02-01-2024,03-01-2024,09-01-2024").load()
    assert {r.key[:2]: r.status for r in got.collect()} == {"01": "ok", "02": "no_edition", "03": "retry", "09": "retry"}
    days = spark.sql("select date '2024-01-02' as d")
    urls = [days.select(service.request_url("http://s/", e, F.col("d") if e in service.BY_DATE else F.lit("MAT/p5" if e == "imagen" else 5))).first()[0] for e in service.PATHS]
    assert urls[:3] == ["http://s/diarios/porFecha/02-01-2024", "http://s/notas/02-01-2024", "http://s/indicadores/02-01-2024"]
    assert urls[3:] == ["http://s/notas/nota/5", "http://s/imagenesFsRecurso/obtieneImagenesFS/5", "http://s/documentos/pdf/5", "http://s/copiaCertificada/MAT/p5.jpg"]
    with pytest.raises(ValueError, match="endpoint"):
        service.request_url("b", "x", F.lit(1))


class FakeEngine:
    def convert(self, pages):
        if pages[0] == b"slow":
            raise TimeoutError
        return [p.decode() for p in pages]


def test_markdown_routes(spark):
    details = spark.createDataFrame([(1, "<p>html <b>note</b></p>"), (2, ""), (3, None), (4, "")], "cod_nota long, cadena_contenido string")
    rows = [(1, "Aviso uno"), (2, "Aviso dos"), (3, None), (4, "Aviso cuatro"), (5, "Aviso cinco")]
    notes = spark.createDataFrame([(c, "2024-01-02", "MAT", c, t, c, 70) for c, t in rows], "cod_nota long, fecha string, cod_edicion string, pagina int, titulo string, note_pos int, cod_diario long")
    listings = spark.createDataFrame([(70, k, k, f"p{k}") for k in range(1, 6)], "cod_diario long, pos int, page long, nombre_archivo string")
    bodies = {1: b"x", 2: b"tail\n# Aviso dos\nbody", 3: b"more <table><tr><td>a</td></tr></table>", 4: b"# Aviso cuatro\nfour", 5: b"slow"}
    contents = spark.createDataFrame([(f"p{k}", bytearray(b)) for k, b in bodies.items()], "nombre_archivo string, content binary")
    images = markdown.note_images(notes, listings, contents)
    assert images.where("cod_nota = 2").count() == 2
    made = {r.cod_nota: r for r in markdown.build_markdown(details, notes, images.where("cod_nota <> 3"), FakeEngine).collect()}
    assert (made[1].route, made[1].markdown) == ("html", "html **note**")
    assert made[2].markdown == "# Aviso dos\nbody\n\nmore \n\n| a |\n|---|" and made[2].full_markdown.startswith("tail")
    assert made[3].status == "missing_pages" and made[4].status == "timeout" and made[4].markdown is None
    assert {r.status for r in markdown.build_markdown(details, notes, source="html").collect()} == {"ok", "no_html"}
    names = [r.path for r in sinks.markdown_files(markdown.build_markdown(details, notes, images, FakeEngine).where("cod_nota = 2"), keep_pages=True).collect()]
    assert sorted(names) == ["nota-2.full.md", "nota-2.md"]
    assert sinks.image_files(images.where("cod_nota = 1")).first()["path"] == "nota-1-p1.jpg"
    assert spark.range(1).select(sinks.relink_figures(F.lit("![](images/a.png)"), F.lit("n_images"))).first()[0] == "![](n_images/a.png)"


def test_note_pdfs(spark):
    notes = spark.createDataFrame([(1, "d", "MAT", 1, 1, 7), (2, "d", "MAT", 2, 2, 7), (3, "d", "MAT", 9, 3, 7)], "cod_nota long, fecha string, cod_edicion string, pagina int, note_pos int, cod_diario long")
    editions = spark.createDataFrame([(7, bytearray(b"%PDF"))], "cod_diario long, content binary")

    def split(pdf, pages):
        if max(pages, default=0) > 8:
            raise ValueError("no such page")
        return pdf + str(pages).encode()

    got = {r.cod_nota: (bytes(r.content) if r.content else None, r.status) for r in markdown.note_pdfs(notes, editions, split).collect()}
    assert got[1] == (b"%PDF[1, 2]", "ok") and got[2][1].startswith("error") and got[3][1].startswith("error")


class FigureEngine:
    def convert(self, pages):
        return [markdown.Page(f"{p[3:].decode()}\n![](images/f.png)", {"f.png": p}) for p in pages]


def whole_service(url, timeout):
    """Notes 1 (HTML), 2 and 3 (pages only) of one edition; images of pages 1 to 3, the last of them broken; editions 70 and 71 as PDF, the second broken."""
    answers = {
        "notas/02-01-2024": index(*[entry(c, f"Aviso {c}", pagina=c, codDiario=70) for c in (1, 2, 3)]),
        "imagenesFsRecurso/obtieneImagenesFS/70": {"imagenesFS": [{"codImagen": k, "pagina": k, "nombreArchivo": f"p{k}"} for k in (1, 2, 3)]},
        "documentos/pdf/70": b"%PDF whole",
        "documentos/pdf/71": b"<html>",
        "copiaCertificada/MAT/p1.jpg": b"\xff\xd8\xff# Aviso 1",
        "copiaCertificada/MAT/p2.jpg": b"\xff\xd8\xffend of one\n## Aviso 2\nbody of two",
        "copiaCertificada/MAT/p3.jpg": b"<html>",
        "pdf?archivo=02012024-MAT.pdf&anio=2024&repo=repositorio/": b"%PDF <table><tr><td>a</td></tr></table>",
    }
    for c in (1, 2, 3):
        answers[f"notas/nota/{c}"] = {"Nota": {"codNota": c, "titulo": f"Aviso {c}", "codEdicion": "MAT", "fecha": "02-01-2024", "codDiario": 70, "pagina": c, "cadenaContenido": "<p>x" if c == 1 else ""}}
    found = answers.get(url.removeprefix("http://s/"))
    return (404, b"") if found is None else (200, found if isinstance(found, bytes) else json.dumps(found).encode())


def cut_pages(pdf, pages):
    if not pdf.startswith(b"%PDF") or max(pages) > 2:
        raise ValueError("no such page")
    return b"%PD" + f"lead\n## Aviso {pages[0]}\nfrom pages {pages}".encode()


def test_notes_from_all_three_sources_by_command_line(spark, tmp_path, capsys):
    def run(*args):
        return cli.main([*args, "--outdir", str(tmp_path)], whole_service, spark, FigureEngine, cut_pages)

    assert run("markdown", "1", "2", "--base", "http://s", "--keep-pages") == 1  # the third page of note 2 is broken
    assert (tmp_path / "nota-1.md").read_text() == "x\n" and "2 (image): invalid" in capsys.readouterr().err
    assert run("markdown", "1", "--base", "http://s", "--source", "image", "--keep-pages") == 0
    assert (tmp_path / "nota-1.md").read_text() == "# Aviso 1\n![](nota-1_images/p1/f.png)\n\nend of one\n"
    assert "## Aviso 2" in (tmp_path / "nota-1.full.md").read_text()
    assert (tmp_path / "nota-1_images/p2/f.png").read_bytes().startswith(b"\xff\xd8\xffend")
    assert run("markdown", "1", "2", "--base", "http://s", "--source", "pdf") == 1
    assert (tmp_path / "nota-1.md").read_text().startswith("## Aviso 1\nfrom pages [1, 2]\n![](nota-1_images/0/f.png)")
    assert "2 (pdf): error: no such page" in capsys.readouterr().err
    assert run("note", "1", "2", "9", "--base", "http://s") == 1
    assert json.loads((tmp_path / "nota-1.json").read_text())["Nota"]["cadenaContenido"] == "<p>x"
    assert (tmp_path / "nota-2-p2.jpg").exists() and not (tmp_path / "nota-2-p3.jpg").exists() and "9: no such note" in capsys.readouterr().err
    assert run("pages", "1", "--kind", "pdf", "--base", "http://s") == 0 and (tmp_path / "nota-1.pdf").read_bytes().startswith(b"%PDlead")
    assert run("fetch", "70", "71", "--endpoint", "pdf", "--base", "http://s") == 1
    assert (tmp_path / "70.pdf").exists() and not (tmp_path / "71.pdf").exists()
    assert run("fetch", "MAT/p1", "--endpoint", "imagen", "--base", "http://s") == 0 and (tmp_path / "p1.jpg").exists()
    assert run("edition", "2024-01-02", "--site", "http://s/pdf") == 0
    assert (tmp_path / "02012024-MAT.pdf").exists() and "| a |" in (tmp_path / "02012024-MAT.md").read_text()
    assert (tmp_path / "02012024-MAT_images/f.png").exists()
    with pytest.raises(RuntimeError, match="not installed"):
        cli.main(["markdown", "1", "--base", "http://s", "--engine", "no-such-program"], whole_service, spark)
    with pytest.raises(SystemExit):
        cli.main(["markdown", "1"], whole_service, spark)


class DeadEngine:
    made = 0

    def __init__(self):
        raise RuntimeError("the OCR server did not start")


def test_an_engine_that_cannot_be_made_ends_the_job(spark):
    pages = spark.createDataFrame([(1, 1, bytearray(b"x")), (2, 1, bytearray(b"y"))], "cod_nota long, pos int, content binary")
    with pytest.raises(Exception, match="did not start"):
        markdown.ocr_pages(pages, DeadEngine).collect()
    empty = spark.createDataFrame([(1, 1, None, "invalid"), (2, 1, None, None)], "cod_nota long, pos int, content binary, status string")
    assert {r.cod_nota: r.status for r in markdown.ocr_pages(empty, DeadEngine).collect()} == {1: "invalid", 2: "missing_page"}


def test_an_interrupted_archive_keeps_what_is_done(spark, tmp_path, monkeypatch, caplog):
    plain, steps = sinks.append_ledger, []

    def append(days, path):
        if steps:
            raise KeyboardInterrupt
        steps.append(1)
        plain(days, path)

    monkeypatch.setattr(archive.sinks, "append_ledger", append)
    args = (spark, f"{tmp_path}/out", f"{tmp_path}/ledger", "2024-02-01", "2024-01-01", "2024-01-05", "http://s", transport, 0.0)
    run = archive.update_archive(*args, report_every=2)
    assert run.statistics["procesados"] == 2 and files.ledger(spark, f"{tmp_path}/ledger").count() == 2
    monkeypatch.undo()
    assert archive.update_archive(*args, report_every=2).statistics == {"procesados": 3, "con_indice": 1, "sin_edicion": 0, "errores": 2}


def test_engines(tmp_path):
    with pytest.raises(RuntimeError, match="not installed"):
        markdown.CommandEngine(["no-such-program"])
    script = tmp_path / "ocr"
    script.write_text('#!/bin/sh\nmkdir -p "$4/page/auto" && printf "# read" > "$4/page/auto/page.md"\n')
    script.chmod(0o755)
    assert markdown.CommandEngine([str(script)]).convert([b"x"]) == ["# read"]
    script.write_text('#!/bin/sh\nmkdir -p "$4/page/auto/images" && printf f > "$4/page/auto/images/a.png" && printf "![](images/a.png)" > "$4/page/auto/page.md"\n')
    assert markdown.CommandEngine([str(script)]).convert([b"x"])[0].figures == {"a.png": b"f"}
    slow = tmp_path / "slow"
    slow.write_text("#!/bin/sh\nexec sleep 5\n")
    slow.chmod(0o755)
    with pytest.raises(TimeoutError):
        markdown.CommandEngine([str(slow)], timeout=0.2).convert([b"x"])
    server = markdown.ServerEngine(lambda port: ["sleep", "60"], lambda address: True, lambda address, page: page.decode())
    assert server.convert([b"a"]) == ["a"] and server.process.poll() is None
    server.stop()
    assert server.process.poll() is not None
    with pytest.raises(RuntimeError, match="did not start"):
        markdown.ServerEngine(lambda port: ["false"], lambda address: False, None)


def test_sql_functions(spark):
    udfs.register(spark)
    row = spark.sql("select html_to_md('<p>a') a, tables_to_md('x') b, fold_text('Á') c, cut_note('t\nx', 't', null) d, locate_title('ab t', 't', null).start e, html_blocks('<p>q')[0].kind f").first()
    assert tuple(row) == ("a", "x", "a", "t\nx", 3, "paragraph")


def test_compaction(spark, tmp_path):
    months = spark.sql("select date '2024-01-02' fecha, '{}' body union all select date '2023-01-02', '{}'")
    months.write.json(f"{tmp_path}/months")
    archive.compact(spark, f"{tmp_path}/months", f"{tmp_path}/years", 2024)
    assert [p.name for p in (tmp_path / "years").glob("anio=*")] == ["anio=2024"]


def test_command_line(spark, tmp_path, capsys):
    assert cli.main(["fetch", "2024-01-01", "--base", "http://s", "--outdir", str(tmp_path)], transport, spark) == 0
    assert json.loads((tmp_path / "01012024-notas.json").read_text())["messageCode"] == 200
    assert cli.main(["fetch", "2024-01-03", "--base", "http://s", "--outdir", str(tmp_path)], transport, spark) == 1
    assert cli.main(["archive", "--base", "http://s", "--first", "2024-01-01", "--last", "2024-01-02", "--as-of", "2024-02-01", "--pause", "0", "--outdir", str(tmp_path / "a")], transport, spark) == 0
    assert '"procesados": 2' in capsys.readouterr().out
    (tmp_path / "n.json").write_text(json.dumps({"Nota": {"codNota": 7, "titulo": "t", "codEdicion": "MAT", "fecha": "02-01-2024", "cadenaContenido": "<p>x"}}))
    assert cli.main(["markdown", str(tmp_path / "n.json"), "--outdir", str(tmp_path)], None, spark) == 0
    assert (tmp_path / "nota-7.md").read_text() == "x\n"
    (tmp_path / "t.md").write_text("<table><tr><td>a</td></tr></table>")
    assert cli.main(["tables", str(tmp_path / "t.md"), "--outdir", str(tmp_path / "o")], None, spark) == 0
    assert "| a |" in (tmp_path / "o/t.md").read_text()
    with pytest.raises(SystemExit):
        cli.main(["markdown", "x", "--source", "fax"])


def test_note_json(spark):
    n = spark.createDataFrame([(5, "é", None)], "cod_nota long, titulo string, fecha string")
    row = sinks.note_json(n, ["cod_nota", "titulo", "fecha"]).first()
    assert row.path == "nota-5.json" and json.loads(row.content) == {"Nota": {"cod_nota": 5, "titulo": "é", "fecha": None}} and "é" in row.content
    assert DAY_INDEX.fieldNames()[2] == "NotasMatutinas"
