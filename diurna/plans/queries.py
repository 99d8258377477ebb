"""Queries over the operators of the gazette engine, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..functions import udfs
from ..operators import assets as a
from ..operators import index as ix
from ..sources import files, service
from . import markdown as md
from .views import NOTES_SQL, day_indexes, documents, notes_view, scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
BASE = "https://gazette.example/pdf"


def query(sql: str | None = None, dated: bool = False):
    """Register a query under its function's name; its SQL can use the notes view. A date column is given as ISO text."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = function(spark, sf_dir)
            return out.withColumn("fecha", F.date_format("fecha", "yyyy-MM-dd")) if dated else out

        QUERIES[function.__name__] = run
        if sql:
            text = f"with notes as ({NOTES_SQL}) {sql}"
            ORACLE_SQL[function.__name__] = f"select * replace (strftime(fecha, '%Y-%m-%d') as fecha) from ({text})" if dated else text
        return function

    return register


SPANS = """, lined as (select *, lead(pagina) over (partition by fecha, cod_edicion order by cod_nota) as q from notes),
    spans as (select *, unnest(case when q is null or q = pagina then [pagina] else generate_series(pagina, q) end) as page from lined) """
IMAGES = """, images as (select fecha, cod_edicion, page, concat(cod_edicion, '-', page) as nombre_archivo
    from (select fecha, cod_edicion, unnest(generate_series(1, m)) as page from (select fecha, cod_edicion, max(pagina) as m from notes group by all)) where page % 5 <> 0) """
ASSETS = """, assets as (select case when n_nationkey % 3 = 0 then concat('archive-', 1990 + n_nationkey, '-', lpad(cast(1 + n_nationkey % 12 as varchar), 2, '0'), '.tgz')
    else concat('archive-', 1990 + n_nationkey, '.tgz') end as name, 10007 * (n_nationkey + 1) * length(n_name) as size from nation) """
INVENTORY = """, inventory as (select name as asset,
    case when regexp_extract(name, '(\\d{4})-(\\d{2})', 2) <> '' then regexp_extract(name, '(\\d{4}-\\d{2})', 1) else regexp_extract(name, '(\\d{4})', 1) end as span,
    case when regexp_extract(name, '(\\d{4})-(\\d{2})', 2) <> '' then 'month' else 'year' end as kind,
    round(size / 1e6, 2) as size_mb from assets) """


LISTED = """, listed as (select cod_nota, fecha, cod_edicion, titulo, cod_orga_uno, pagina, cod_nota % 3 as list_pos,
    row_number() over (partition by fecha, cod_edicion order by cod_nota) - 1 as note_pos from notes) """


@query(LISTED + "select * from listed", dated=True)
def notes_index(spark, sf_dir):
    """Day indexes with their three lists, taken apart: one row per note, stubs included."""
    notes = ix.explode_index(day_indexes(spark, sf_dir))
    return notes.select("cod_nota", "fecha", "cod_edicion", "titulo", "cod_orga_uno", F.col("pagina").cast("bigint").alias("pagina"), F.col("list_pos").cast("bigint").alias("list_pos"), F.col("note_pos").cast("bigint").alias("note_pos"))


@query("select cod_nota, titulo, fecha, cod_orga_uno from notes where titulo is not null and titulo <> ''", dated=True)
def titled_notes(spark, sf_dir):
    return ix.title_records(notes_view(spark, sf_dir))


@query("select fecha, cod_edicion, count(*) filter (where titulo is not null and titulo <> '') as n from notes group by all", dated=True)
def titled_lists(spark, sf_dir):
    """Day indexes filtered as they are, lists and all; titled notes per list."""
    notes = ix.drop_untitled_nested(day_indexes(spark, sf_dir))
    lists = F.array(*[F.struct(F.lit(code).alias("cod_edicion"), F.size(name).cast("bigint").alias("n"), F.size(F.col(f"all_{name}")).alias("all")) for name, code in ix.EDITIONS])
    sizes = day_indexes(spark, sf_dir).select("fecha", *[F.col(name).alias(f"all_{name}") for name, _ in ix.EDITIONS])
    return notes.join(sizes, "fecha").select("fecha", F.inline(lists)).where("all > 0").drop("all")


@query("select n.cod_nota, p.titulo as first_title, p.cod_nota is not null as found from notes n left join notes p on p.cod_nota = n.cod_nota and p.cod_nota % 5 <> 0")
def note_entries(spark, sf_dir):
    """Notes with their entry in an index that lacks every fifth one."""
    notes = notes_view(spark, sf_dir)
    index = notes.where("cod_nota % 5 <> 0").select("cod_nota", "fecha", "cod_edicion", "titulo")
    return ix.index_entries(notes.select("cod_nota", "fecha", "cod_edicion"), index).select("cod_nota", F.col("entry.titulo").alias("first_title"), F.col("entry").isNotNull().alias("found"))


@query(SPANS + "select cod_nota, fecha, cod_edicion, page from spans", dated=True)
def page_span(spark, sf_dir):
    return ix.explode_pages(ix.page_spans(notes_view(spark, sf_dir))).select("cod_nota", "fecha", "cod_edicion", "page")


@query("select cod_nota, lead(nullif(titulo, '') ignore nulls) over (partition by fecha, cod_edicion order by cod_nota) as titulo_siguiente from notes")
def next_titled(spark, sf_dir):
    return ix.next_titled(notes_view(spark, sf_dir)).select("cod_nota", "titulo_siguiente")


@query(SPANS + IMAGES + """select s.cod_nota, s.page, i.nombre_archivo, case when i.page is null then 'missing_page' else 'ok' end as status
    from spans s left join images i using (fecha, cod_edicion, page)""")
def span_images(spark, sf_dir):
    """Images of each note's pages; every fifth page has none."""
    notes = notes_view(spark, sf_dir)
    last = notes.groupBy("fecha", "cod_edicion").agg(F.max("pagina").alias("m"))
    images = last.select("fecha", "cod_edicion", F.explode(F.sequence(F.lit(1).cast("bigint"), "m")).alias("page")).where("page % 5 <> 0")
    images = images.withColumn("nombre_archivo", F.concat_ws("-", "cod_edicion", F.col("page").cast("string"))).withColumn("pos", F.lit(0))
    pages = ix.explode_pages(ix.page_spans(notes))
    return ix.page_images(pages, images, ["fecha", "cod_edicion"]).select("cod_nota", "page", "nombre_archivo", "status")


@query("""select cast(d as date) as fecha from generate_series(timestamp '1917-01-02', timestamp '1918-12-31', interval 1 day) t(d)
    where cast(d as date) not in (select fecha from notes where cod_nota % 7 = 0)""", dated=True)
def missing_days(spark, sf_dir):
    """Days of a range without an entry in the ledger (here: days with a note whose number is divisible by 7)."""
    done = notes_view(spark, sf_dir).where("cod_nota % 7 = 0").select("fecha")
    return ix.missing_days(spark, "1917-01-02", "1918-12-31", done)


@query("""select cod_orga_uno, arg_min(concat(cod_orga_uno, ' ', lang), cod_nota) as nombre from notes
    where titulo is not null and titulo <> '' and cod_orga_uno is not null group by cod_orga_uno""")
def organism_dim(spark, sf_dir):
    notes = notes_view(spark, sf_dir).withColumn("nombre_cod_orga_uno", F.concat_ws(" ", "cod_orga_uno", "lang"))
    return ix.first_names(notes, "cod_nota")


@query("""select n.cod_nota, d.nombre from notes n left join (select cod_orga_uno, arg_min(concat(cod_orga_uno, ' ', lang), cod_nota) as nombre from notes
    where titulo is not null and titulo <> '' group by cod_orga_uno) d using (cod_orga_uno)""")
def notes_with_names(spark, sf_dir):
    return ix.with_names(notes_view(spark, sf_dir), organism_dim(spark, sf_dir)).select("cod_nota", "nombre")


@query("select year(fecha) as anio, cod_edicion, count(*) as n_notas from notes group by all")
def notes_by_year_edition(spark, sf_dir):
    return ix.count_by_edition(notes_view(spark, sf_dir)).select(F.col("anio").cast("bigint").alias("anio"), "cod_edicion", "n_notas")


@query("select cod_edicion, count(*) as n from (select * from notes where cod_edicion = 'MAT' union all select * from notes where cod_edicion = 'VES' union all select * from notes where cod_edicion = 'EXT') group by rollup (cod_edicion)")
def edition_union_counts(spark, sf_dir):
    """Notes of the three lists of all days together, per edition and in all; the union of the lists is one scan."""
    return ix.counts_with_total(ix.explode_index(day_indexes(spark, sf_dir)), "cod_edicion")


@query("""select count(*) as procesados, count(*) filter (where s = 0) as con_indice, count(*) filter (where s = 1) as sin_edicion, count(*) filter (where s = 2) as errores
    from (select case when cod_nota % 10 = 0 then 2 when cod_nota % 4 = 0 then 1 else 0 end as s from notes)""")
def run_stats(spark, sf_dir):
    status = F.when(F.col("cod_nota") % 10 == 0, "retry").when(F.col("cod_nota") % 4 == 0, "no_edition").otherwise("ok")
    return ix.run_statistics(notes_view(spark, sf_dir).withColumn("status", status))


@query("select distinct fecha from notes where fecha < date '1917-01-20'", dated=True)
def closed_days(spark, sf_dir):
    return ix.closed_days(notes_view(spark, sf_dir).select("fecha").distinct(), "1917-01-20")


def _assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = spark.read.parquet(f"{sf_dir}/nation.parquet")
    month = F.concat(F.lit("-"), F.lpad((1 + F.col("n_nationkey") % 12).cast("string"), 2, "0"))
    name = F.concat(F.lit("archive-"), (1990 + F.col("n_nationkey")).cast("string"), F.when(F.col("n_nationkey") % 3 == 0, month).otherwise(""), F.lit(".tgz"))
    return n.select(name.alias("name"), (10007 * (F.col("n_nationkey") + 1) * F.char_length("n_name")).cast("bigint").alias("size"))


@query(ASSETS + INVENTORY + "select * from inventory")
def asset_inventory(spark, sf_dir):
    return a.inventory(_assets(spark, sf_dir))


@query(ASSETS + INVENTORY + """select min(span) as first_span, max(span) as last_span, count(*) filter (where kind = 'year') as n_years,
    count(*) filter (where kind = 'month') as n_months, round(sum(size_mb), 2) as total_mb from inventory""")
def asset_summary(spark, sf_dir):
    return a.inventory_summary(_assets(spark, sf_dir))


@query(ASSETS + INVENTORY + "select * from (select * from inventory order by asset desc limit 8) order by asset")
def asset_tail8(spark, sf_dir):
    return a.last_by_name(_assets(spark, sf_dir))


@query(ASSETS + "select name, 'https://gazette.example/' || name as url from assets order by name limit 8")
def asset_head8(spark, sf_dir):
    """The first archives of a release that lists other files as well."""
    names = _assets(spark, sf_dir).select("name").unionByName(spark.createDataFrame([("notes.md",), ("archive-0.tgz.sig",), ("a.zip",)], "name string"))
    assets = F.collect_list(F.struct("name", F.concat(F.lit("https://gazette.example/"), "name").alias("browser_download_url"), F.lit(1).cast("bigint").alias("size")))
    # a release has a hundred-odd assets; this one as many as nations and three more
    return a.archives(names.agg(assets.alias("assets"))).orderBy("name").limit(8)


@query("select cod_nota, substr(titulo, 1, 80) || case when length(titulo) > 80 then '…' else '' end as vista from notes where titulo is not null and titulo <> ''")
def title_preview(spark, sf_dir):
    return ix.drop_untitled(notes_view(spark, sf_dir)).select("cod_nota", a.preview(F.col("titulo")).alias("vista"))


@query("select * from notes where starts_with(titulo, 'The') order by cod_nota limit 1", dated=True)
def prefix_search(spark, sf_dir):
    return a.first_with_prefix(notes_view(spark, sf_dir), "The", "cod_nota")


@query("""select source, route, count(*) as n from (
    select s.source, case s.source when 'auto' then case when cod_nota % 4 = 0 then 'image' else 'html' end when 'html' then case when cod_nota % 4 = 0 then 'error' else 'html' end else s.source end as route
    from notes cross join (values ('auto'), ('html'), ('image'), ('pdf')) s(source)) group by all""")
def route_counts(spark, sf_dir):
    """Notes by route, for each way to ask; here every fourth note has no HTML."""
    details = notes_view(spark, sf_dir).withColumn("cadena_contenido", F.when(F.col("cod_nota") % 4 == 0, "").otherwise("<p>x</p>"))
    counts = [a.with_route(details, source).groupBy("route").agg(F.count(F.lit(1)).alias("n")).withColumn("source", F.lit(source)) for source in ("auto", "html", "image", "pdf")]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


@query(f"""select distinct fecha, cod_edicion, concat(strftime(fecha, '%d%m%Y'), '-', cod_edicion, '.pdf') as archivo,
    concat('{BASE}?archivo=', strftime(fecha, '%d%m%Y'), '-', cod_edicion, '.pdf&anio=', strftime(fecha, '%Y'), '&repo=repositorio/') as url from notes""", dated=True)
def edition_urls(spark, sf_dir):
    editions = notes_view(spark, sf_dir).select("fecha", "cod_edicion").distinct()
    return editions.withColumns({"archivo": a.edition_file(F.col("fecha"), F.col("cod_edicion")), "url": a.edition_url(BASE, F.col("fecha"), F.col("cod_edicion"))})


@query("""select doc_id, regexp_replace(lower(strip_accents(regexp_replace(translate(text, '#*|\\>_`~[]', ''), '\\s+', ' ', 'g'))), '^ | $', '', 'g') as folded
    from documents where text is not null""")
def fold_text(spark, sf_dir):
    """Whole texts folded for matching."""
    return documents(spark, sf_dir).where("text is not null").select("doc_id", F.trim(udfs.fold_text(F.col("text"))).alias("folded"))


@query("""select doc_id, pos, coalesce(sum(length(line) + 1) over (partition by doc_id order by pos rows between unbounded preceding and 1 preceding), 0)::bigint as start,
    not regexp_matches(line, '\\S') or regexp_matches(line, '^\\s*#{1,6}\\s+\\S') as leads, line
    from (select doc_id, unnest(l) as line, generate_subscripts(l, 1) - 1 as pos from (select doc_id, string_split(text, chr(10)) as l from documents))""")
def doc_lines(spark, sf_dir):
    """Lines as slicing sees them: where each starts, and whether it only leads to what follows."""
    return documents(spark, sf_dir).select("doc_id", F.inline(udfs.text_lines(F.col("text"))))


@query("""select strftime(fecha, '%Y-%m-%d') || cod_edicion as edition, string_agg(regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g'), chr(10) || chr(10) order by cod_nota) || chr(10) as markdown
    from notes join documents on doc_id = cod_nota group by all""")
def joined_pages(spark, sf_dir):
    """An edition's texts in order, with blank lines between."""
    notes = notes_view(spark, sf_dir).select("cod_nota", F.concat(F.date_format("fecha", "yyyy-MM-dd"), "cod_edicion").alias("edition"))
    texts = notes.join(documents(spark, sf_dir).select(F.col("doc_id").alias("cod_nota"), "text"), "cod_nota")
    return ix.join_pages(texts, "edition", "cod_nota", "text").withColumnRenamed("text", "markdown")


@query()
def pages_markdown(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", udfs.html_to_md(F.col("html")).alias("markdown"))


@query()
def page_blocks(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", F.posexplode(udfs.html_blocks(F.col("html"))).alias("pos", "b")).select("page_id", "pos", "b.kind", "b.text")


def _customer_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(c_custkey, html): customers as notes in HTML with a title, emphasis, a spanned table and things to leave out."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    text = F.format_string(
        "<html><head><title>t</title><style>p{}</style></head><body><script>x()</script><div class=\"Titulo_1 x\">Customer  %d</div><h2> </h2><div><p>Status <b>%s </b><span style=\"FONT-WEIGHT: bold\">now</span><br>by&nbsp;<i>%s</i> &amp; co</p>loose<h3>Part<br>two</h3></div>"
        "<table><tr><th rowspan=\"2\">a|b</th><th colspan=\"2\">c</th></tr><tr><td><b>%s</b></td><td>e<br>f</td></tr></table><ul><li>one</li><li>two</li></ul></body></html>",
        "c_custkey", "c_mktsegment", "c_name", "c_mktsegment",
    )
    # parsing costs far more than reading: one small file is not one task
    return c.select("c_custkey", text.alias("html")).repartition(spark.sparkContext.defaultParallelism, "c_custkey")


@query("""select c_custkey, '# Customer ' || c_custkey || chr(10) || chr(10) || 'Status **' || c_mktsegment || ' now**' || chr(10) || 'by *' || c_name || '* & co' || chr(10) || chr(10)
    || 'loose' || chr(10) || chr(10) || '### Part two' || chr(10) || chr(10) || '| a\\|b | c |  |' || chr(10) || '|---|---|---|' || chr(10) || '|  | **' || c_mktsegment || '** | e f |'
    || chr(10) || chr(10) || 'onetwo' as markdown from customer""")
def customer_markdown(spark, sf_dir):
    """HTML notes to Markdown, rule by rule."""
    return _customer_html(spark, sf_dir).select("c_custkey", udfs.html_to_md(F.col("html")).alias("markdown"))


@query("""select c_custkey, unnest(['heading', 'paragraph', 'text', 'heading', 'table', 'paragraph']) as kind, unnest([0, 1, 2, 3, 4, 5]) as pos, unnest([length('# Customer ' || c_custkey),
    length('Status **' || c_mktsegment || ' now**' || chr(10) || 'by *' || c_name || '* & co'), 5, 12, length('| a\\|b | c |  |' || chr(10) || '|---|---|---|' || chr(10) || '|  | **' || c_mktsegment || '** | e f |'), 6]) as n_chars from customer""")
def customer_blocks(spark, sf_dir):
    """The same notes block by block."""
    rows = _customer_html(spark, sf_dir).select("c_custkey", F.posexplode(udfs.html_blocks(F.col("html"))).alias("pos", "b"))
    return rows.select("c_custkey", "pos", "b.kind", F.char_length("b.text").cast("bigint").alias("n_chars"))


@query("""select l_orderkey, 'before' || chr(10) || chr(10) || '| line | part | flag |' || chr(10) || '|---|---|---|' || chr(10)
    || string_agg('| ' || l_linenumber || ' | ' || l_partkey || ' |  |', chr(10) order by l_linenumber, l_partkey) || chr(10) || chr(10) || 'after <table>' as markdown from lineitem group by l_orderkey""")
def tables_markdown(spark, sf_dir):
    """Lines of each order as an HTML table inside a text, converted."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    row = F.format_string("<tr><td>%d</td><td colspan=\"2\"> %d\n</td></tr>", "l_linenumber", "l_partkey")
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", row.alias("r")))), lambda x: x["r"]), "\n\n\n")
    text = F.concat(F.lit("before<TABLE class='x'><tr><th>line</th><th>part</th><th>flag</th></tr>"), rows, F.lit("</table>\n\n\n\nafter <table>"))
    return lines.groupBy("l_orderkey").agg(text.alias("text")).select("l_orderkey", udfs.tables_to_md(F.col("text")).alias("markdown"))


def _paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cod_nota, text, titulo, titulo_siguiente): each note's text with the end of another one before it and the next one's beginning after it.

    Titles are printed with accents, marks and a line break that the index doesn't have.
    """
    notes = notes_view(spark, sf_dir).withColumn("titulo", F.format_string("Acuerdo numero %d del dia %s", "cod_nota", F.date_format("fecha", "yyyy-MM-dd")))
    notes = ix.next_titled(notes).select("cod_nota", "fecha", "titulo", "titulo_siguiente")
    joined = documents(spark, sf_dir).select(F.col("doc_id").alias("cod_nota"), F.coalesce("text", F.lit("")).alias("text")).join(notes, "cod_nota")
    own = F.concat(F.lit("tail of the note before\n\n# MINISTRY\n\n## ACUERDO  número **"), F.col("cod_nota").cast("string"), F.lit("**\ndel día "), F.date_format("fecha", "yyyy-MM-dd"), F.lit("\n"), F.col("text"), F.lit("\nlast line"))
    after = F.concat(F.lit("\n\n# ORGANISM\n\n### "), F.upper("titulo_siguiente"), F.lit("\nnext body"))
    # texts are few and long, and slicing costs by the character
    return joined.select("cod_nota", F.concat(own, F.coalesce(after, F.lit(""))).alias("text"), "titulo", "titulo_siguiente").repartition(spark.sparkContext.defaultParallelism * 3, "cod_nota")


PAGED = """, titled as (select cod_nota, fecha, lead(cod_nota) over (partition by fecha, cod_edicion order by cod_nota) as next from notes),
    paged as (select t.*, 'ACUERDO  número **' || cod_nota || '**' || chr(10) || 'del día ' || strftime(fecha, '%Y-%m-%d') as printed, coalesce(text, '') as text,
        length('acuerdo numero ' || cod_nota || ' del dia 1917-01-02') as own_length, length('acuerdo numero ' || next || ' del dia 1917-01-02') as next_length
        from titled t join documents on doc_id = cod_nota) """


@query(PAGED + "select cod_nota, '## ' || printed || chr(10) || text || chr(10) || 'last line' as markdown from paged")
def cut_note(spark, sf_dir):
    p = _paged(spark, sf_dir)
    return p.select("cod_nota", udfs.cut_note(F.col("text"), F.col("titulo"), F.col("titulo_siguiente")).alias("markdown"))


@query(PAGED + """select cod_nota, length('tail of the note before##  # MINISTRY## ') as start, 1.0::double as start_confidence, own_length as start_longest,
    case when next is not null then length('tail of the note before##  # MINISTRY## ') + length(printed) + 1 + length(text) + length('#last line##  # ORGANISM### ') end as "end",
    case when next is null then 0.0::double else 1.0::double end as end_confidence, coalesce(next_length, 0) as end_longest from paged""")
def locate_title(spark, sf_dir):
    p = _paged(spark, sf_dir)
    return p.select("cod_nota", udfs.locate_title(F.col("text"), F.col("titulo"), F.col("titulo_siguiente")).alias("b")).select("cod_nota", "b.*")


@query("""select fecha, 'https://g.example/api/' || unnest(['diarios/porFecha/', 'notas/', 'indicadores/']) || strftime(fecha, '%d-%m-%Y') as url from (select distinct fecha from notes)
    union all select fecha, 'https://g.example/api/' || unnest(['notas/nota/', 'imagenesFsRecurso/obtieneImagenesFS/', 'documentos/pdf/']) || cod_nota as url from notes where cod_nota % 50 = 0""", dated=True)
def request_urls(spark, sf_dir):
    """Addresses of the service's endpoints, by day and by number."""
    notes = notes_view(spark, sf_dir)
    url = lambda endpoint, key: service.request_url("https://g.example/api/", endpoint, F.col(key)).alias("url")
    days = notes.select("fecha").distinct().select("fecha", F.explode(F.array(*[url(e, "fecha") for e in ("diario", "notas", "indicadores")])).alias("url"))
    return days.unionByName(notes.where("cod_nota % 50 = 0").select("fecha", F.explode(F.array(*[url(e, "cod_nota") for e in ("nota", "imagenes", "pdf")])).alias("url")))


@query("select strftime(fecha, '%Y') || '/' || strftime(fecha, '%d%m%Y') || '-notas.json' as path, count(*) as n from notes group by all")
def day_files(spark, sf_dir):
    """Day indexes written as files of their own names and read again: notes per file."""
    at = scratch(spark, "days")
    sinks.export_files(sinks.day_files(day_indexes(spark, sf_dir).select("fecha", F.to_json(F.struct(*[n for n, _ in ix.EDITIONS])).alias("body"))), at)
    notes = ix.explode_index(files.day_indexes(spark, f"{at}/*/*-notas.json"), "file")
    return notes.groupBy(F.regexp_extract("file", r"(\d{4}/[^/]+)$", 1).alias("path")).agg(F.count(F.lit(1)).alias("n"))


@query("select cod_nota, titulo, cod_orga_uno, strftime(fecha, '%Y') || '.tgz' as asset, strftime(fecha, '%d%m%Y') || '-notas.json' as member from notes")
def archived_notes(spark, sf_dir):
    """Day indexes packed into an archive per year, and read from there."""
    at = scratch(spark, "archives")
    days = day_indexes(spark, sf_dir).select(F.date_format("fecha", "yyyy").alias("anio"), F.concat(F.date_format("fecha", "ddMMyyyy"), F.lit("-notas.json")).alias("member"), F.to_json(F.struct(*[n for n, _ in ix.EDITIONS])).alias("body"))
    sinks.export_files(sinks.archive_files(days, "anio"), at)
    notes = files.archived_notes(files.archive_members(files.binaries(spark, at, "*.tgz")))
    return notes.select("cod_nota", "titulo", "cod_orga_uno", "asset", "member")


@query("select cod_nota, titulo, fecha, cod_orga_uno from notes where titulo is not null and titulo <> ''", dated=True)
def published_titles(spark, sf_dir):
    """Title records written as gzipped JSON lines and read again."""
    at = scratch(spark, "titles")
    sinks.write_titles(notes_view(spark, sf_dir), at)
    return files.titles(spark, at)


@query("select distinct fecha from notes", dated=True)
def ledger_days(spark, sf_dir):
    """A ledger that was extended twice with the same days."""
    at = scratch(spark, "ledger")
    days = notes_view(spark, sf_dir).select("fecha").distinct()
    sinks.append_ledger(days.where("day(fecha) < 20"), at)
    sinks.append_ledger(days, at)
    return files.ledger(spark, at)


@query("""select '{' || string_agg('"' || cod_orga_uno || '":"' || nombre || '"', ',' order by cod_orga_uno) || '}' as content from (select cod_orga_uno, arg_min(concat(cod_orga_uno, ' ', lang), cod_nota) as nombre from notes
    where titulo is not null and titulo <> '' and cod_orga_uno is not null group by cod_orga_uno)""")
def organism_map(spark, sf_dir):
    return sinks.names_json(organism_dim(spark, sf_dir))


@query("""select 'nota-' || cod_nota || '.json' as path, '{' || chr(10) || '  "Nota": {' || chr(10) || '    "codNota": ' || cod_nota || ',' || chr(10) || '    "codEdicion": "' || cod_edicion || '",' || chr(10)
    || '    "nada": null' || chr(10) || '  }' || chr(10) || '}' as content from notes""")
def note_files(spark, sf_dir):
    notes = notes_view(spark, sf_dir).select("cod_nota", F.col("cod_nota").alias("codNota"), F.col("cod_edicion").alias("codEdicion"), F.lit(None).cast("string").alias("nada"))
    return sinks.note_json(notes, ["codNota", "codEdicion", "nada"])


@query("""select 'nota-' || cod_nota || '.md' as path, titulo || chr(10) as content from notes where titulo is not null
    union all select 'nota-' || cod_nota || '.full.md', lang from notes where titulo is not null and lang is not null and cod_nota % 2 = 0""")
def markdown_files(spark, sf_dir):
    """Markdown files, and the uncut text of every second note."""
    notes = notes_view(spark, sf_dir).where("titulo is not null").select("cod_nota", F.col("titulo").alias("markdown"), F.expr("if(cod_nota % 2 = 0, lang, null)").alias("full_markdown"))
    return sinks.markdown_files(notes, keep_pages=True)


@query("select 'nota-' || cod_nota || '-' || cod_edicion || '.jpg' as path, case when cod_nota % 3 = 0 then 'ok' else 'invalid' end as status from notes")
def image_files(spark, sf_dir):
    """Page images under their names, checked by their first bytes; two of three are something else."""
    head = F.when(F.col("cod_nota") % 3 == 0, F.unhex(F.lit("FFD8FFE0"))).otherwise(F.encode(F.lit("<html>"), "UTF-8"))
    images = notes_view(spark, sf_dir).select("cod_nota", F.col("cod_edicion").alias("nombre_archivo"), head.alias("content"))
    return a.valid_files(sinks.image_files(images), "jpeg").select("path", "status")


@query("select doc_id, replace(coalesce(text, '') || '![f](images/x.jpg)', '](images/', '](nota-' || doc_id || '_images/') as markdown from documents")
def relinked_figures(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.lit("![f](images/x.jpg)")).alias("markdown"))
    return d.select("doc_id", sinks.relink_figures(F.col("markdown"), F.concat(F.lit("nota-"), F.col("doc_id").cast("string"), F.lit("_images"))).alias("markdown"))


@query("""select doc_id, '<main><a href="references.html#ref-' || coalesce(source, 'x') || '">s</a> <a href="#top">t</a><p>' || doc_id || '</p>' || chr(10) || '</main>' as html from documents""")
def site_citations(spark, sf_dir):
    """Rendered pages whose citations are led to the page of references."""
    link = F.concat(F.lit('<main><a href="#ref-'), F.coalesce("source", F.lit("x")), F.lit('">s</a> <a href="#top">t</a><p>'), F.col("doc_id").cast("string"))
    html = F.concat(link, F.lit('</p>\n<div id="quarto-appendix" class="default"><section>refs\n</section></div>\n\n</main>'))
    return documents(spark, sf_dir).select("doc_id", a.citations_to(html, "references.html").alias("html"))


@query(SPANS + """select cod_nota, case when bool_or(page % 7 = 0) then 'missing_page' else 'ok' end as status,
    case when not bool_or(page % 7 = 0) then string_agg('page ' || page || ' of ' || cod_edicion, chr(10) || chr(10) order by page) || chr(10) end as markdown from spans where pagina < 400 group by cod_nota""")
def pages_by_engine(spark, sf_dir):
    """Notes read page by page by an engine, from images of which every seventh is missing."""
    notes = notes_view(spark, sf_dir).withColumn("cod_diario", F.concat(F.date_format("fecha", "yyyyMMdd"), "cod_edicion"))
    last = notes.groupBy("cod_diario", "cod_edicion").agg(F.max("pagina").alias("m"))
    listed = last.select("cod_diario", "cod_edicion", F.explode(F.sequence(F.lit(1).cast("bigint"), "m")).alias("page")).where("page % 7 <> 0")
    listed = listed.withColumn("nombre_archivo", F.concat_ws("-", "cod_diario", F.col("page").cast("string"))).withColumn("pos", F.col("page"))
    contents = listed.select("nombre_archivo", F.encode(F.concat(F.lit("page "), F.col("page").cast("string"), F.lit(" of "), "cod_edicion"), "UTF-8").alias("content"))
    images = md.note_images(notes, listed.drop("cod_edicion"), contents)
    wanted = images.join(notes.where("pagina < 400").select("cod_nota"), "cod_nota", "left_semi")
    read = md.ocr_pages(wanted, _Reader)
    whole = ix.join_pages(read, "cod_nota", "pos", "markdown")
    return md.page_status(read).join(whole, "cod_nota").select("cod_nota", "status", F.when(F.col("status") == "ok", F.col("markdown")).alias("markdown"))


class _Reader:
    """An engine whose pages are texts already."""

    def convert(self, pages: list[bytes]) -> list[str]:
        return [bytes(p).decode("utf-8") for p in pages]
