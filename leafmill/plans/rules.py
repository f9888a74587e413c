"""The small rules of the catalogue over rows that show their cases, so that each can be compared with SQL, and over the tables where they have the columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions import dates, geometry, records, text
from leafmill.functions.names import source_key
from leafmill.operators import gates, matching
from leafmill.plans.catalogue import KEY
from leafmill.storage import table

QUERIES: dict = {}
SQL: dict[str, str] = {}
SHA = "nullif(regexp_extract(lower(sha256), '[0-9a-f]{64}'), '')"
WHITE = r"[ \t\n\x0B\f\r]"


def query(sql: str | None = None):
    def note(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return note


def _rows(spark: SparkSession, rows: str, names: str) -> DataFrame:
    return spark.sql(f"select * from values {rows} as t({names})")


# -- contents


@query(f"select doc_id, 'store/' || left(s, 2) || '/' || s[3:4] || '/' || s || '.pdf' as path from (select doc_id, {SHA} as s from documents) where s is not null")
def shard_paths(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "documents").select("doc_id", F.nullif(F.regexp_extract(F.lower("sha256"), "[0-9a-f]{64}", 0), F.lit("")).alias("s")).filter("s is not null")
    return x.select("doc_id", records.shard_path("store", F.col("s")).alias("path"))


@query("select doc_id, sha256(text) as sha from documents where text is not null")
def text_hashes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter("text is not null").select("doc_id", F.sha2("text", 256).alias("sha"))


_HEADS = "(1, '%PDF-1.4 x'), (2, '   %PDF-1.7'), (3, 'x %PDF-1.4'), (4, ''), (5, null), (6, '%pdf-1.4'), (7, '%PDF')"


@query(f"select id, coalesce(regexp_matches(head, '^{WHITE}*%PDF-'), false) as pdf from (values {_HEADS}) t(id, head)")
def magic_bytes(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, _HEADS, "id, head").select("id", records.is_pdf(F.col("head").cast("binary")).alias("pdf"))


# -- addresses and names


@query("select doc_id, regexp_replace(url, '^http://', 'https://') as url from documents")
def https_urls(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", records.https(F.col("url")).alias("url"))


_URLS = "(1, 'https://a.example/x'), (2, 'https://b.a.example/x'), (3, 'http://a.example/x'), (4, 'https://aa.example/x'), (5, 'no'), (6, null), (7, 'HTTPS://A.example/y'), (8, 'https://b.example/z')"


@query(rf"with u as (select id, lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) as s, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]+)', 1)) as h from (values {_URLS}) t(id, url)) select id, coalesce(s = 'https' and (h in ('a.example', 'b.example') or h like '%.a.example' or h like '%.b.example'), false) as ok from u")
def host_guards(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, _URLS, "id, url").select("id", records.allowed(F.col("url"), ["a.example", "b.example"]).alias("ok"))


@query("select doc_id, regexp_replace(lower(coalesce(source_id, '')), '[^a-z0-9]+', '', 'g') as bare from documents")
def bare_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", records.bare(F.col("source_id")).alias("bare"))


@query("""with x as (select doc_id, regexp_replace(lower(coalesce(source_id, '')), '[^a-z0-9]+', '', 'g') as b from documents), y as (select distinct left(b, 6) as o from x where length(b) >= 6 and doc_id % 7 = 0)
    select doc_id from x where length(b) >= 4 and exists (select 1 from y where starts_with(b, o) or starts_with(o, b))""")
def either_prefix_ids(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose id begins as one of the listed short ids (here the first six characters of every seventh id), or the other way round."""
    docs = table(spark, d, "documents").select("doc_id", "source_id")
    listed = docs.filter("doc_id % 7 = 0").select(F.substring(records.bare(F.col("source_id")), 1, 6).alias("id")).filter("length(id) >= 6").distinct()
    return matching.either_prefix(docs, "source_id", listed).select("doc_id")


_FILES = "(1, 'Primary document.pdf'), (2, 'Public notes.pdf'), (3, 'cover letter to the public'), (4, null), (5, 'annual report')"


@query(f"select id, case when regexp_matches(n, 'primary') then 50 else 0 end + case when regexp_matches(n, 'public') then 30 else 0 end - case when regexp_matches(n, 'notes') then 100 else 0 end - case when regexp_matches(n, 'letter') then 80 else 0 end as score from (select id, lower(coalesce(name, '')) as n from (values {_FILES}) t(id, name))")
def role_scores(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, _FILES, "id, name").select("id", records.role_score(F.col("name"), {"primary": 50, "public": 30, "notes": -100, "letter": -80}).alias("score"))


_RULES = "(1, '/private/*', '/private/a/b', true), (2, '/a*c', '/abbc/d', true), (3, '/a*c', '/abb', false), (4, '/x.y', '/xzy', false), (5, '/x.y', '/x.y/z', true), (6, '/(a)', '/(a)b', true), (7, '/', '/any', true)"


@query(f"select id, want as hit from (values {_RULES}) t(id, rule, path, want)")
def robots_rules(spark: SparkSession, d: str) -> DataFrame:
    x = _rows(spark, _RULES, "id, rule, path, want").withColumn("pattern", text.robots_pattern(F.col("rule")))
    return x.select("id", F.expr("path rlike pattern").alias("hit"))


# -- texts


_TEXTS = "(1, ' first ;  second   part ; '), (2, 'one'), (3, ' ; ; '), (4, null), (5, 'a;b ;c  d')"


@query(f"select id, list_filter(list_transform(string_split(t, ';'), lambda x: trim(regexp_replace(x, '{WHITE}+', ' ', 'g'))), lambda x: x <> '')[-1] as tail from (values {_TEXTS}) v(id, t)")
def section_tails(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, _TEXTS, "id, t").select("id", text.last_section(F.col("t")).alias("tail"))


_TITLES = "(1, 'Aspirin 100 [ACME]'), (2, 'Aspirin'), (3, 'A [x] B [Y & Z] '), (4, '[only]'), (5, null)"


@query(rf"select id, trim(regexp_replace(t, '{WHITE}*\[[^\]]*\]{WHITE}*$', '')) as product, nullif(regexp_extract(t, '\[([^\]]*)\]{WHITE}*$', 1), '') as labeller from (values {_TITLES}) v(id, t)")
def labelled_titles(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, _TITLES, "id, t").select("id", records.labelled_title(F.col("t")).alias("x")).select("id", "x.*")


_HTML = "(1, '<p>a &amp; b</p><br>c'), (2, 'x &lt;y&gt;'), (3, null), (4, '  plain   text '), (5, '<td>1</td><td>&nbsp;2</td>'), (6, '&amp;lt;')"


@query(rf"select id, trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(t, '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&nbsp;', ' '), '&amp;', '&'), '{WHITE}+', ' ', 'g')) as plain from (values {_HTML}) v(id, t)")
def html_texts(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, _HTML, "id, t").select("id", text.html_text(F.col("t")).alias("plain"))


_SIZES = "(1, '12KB'), (2, '3.5 MB'), (3, '1 gb'), (4, 'none'), (5, null), (6, '(820 KB)'), (7, '7 bytes')"


@query(r"select id, (regexp_extract(s, '(?i)([0-9.]+)\s*([KMG])B', 1)::double * case upper(regexp_extract(s, '(?i)([0-9.]+)\s*([KMG])B', 2)) when 'K' then 1024 when 'M' then 1048576 else 1073741824 end)::bigint as size from (values " + _SIZES + ") v(id, s) where regexp_matches(s, '(?i)([0-9.]+)\\s*([KMG])B') union all select id, null from (values " + _SIZES + ") v(id, s) where s is null or not regexp_matches(s, '(?i)([0-9.]+)\\s*([KMG])B')")
def size_hints(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, _SIZES, "id, s").select("id", text.size_in_bytes(F.col("s")).alias("size"))


@query("select doc_id, list_max(list_transform(regexp_extract_all(coalesce(text, ''), '(?:18|19|20)[0-9]{2}'), lambda x: x::int)) as year from documents")
def latest_years(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.latest_year(F.coalesce("text", F.lit(""))).alias("year"))


@query("select id, nfc_normalize(t) as t from (values (1, 'e' || chr(769)), (2, 'plain'), (3, null), (4, 'A' || chr(778) || 'b')) v(id, t)")
def normalised(spark: SparkSession, d: str) -> DataFrame:
    x = spark.createDataFrame([(1, "e\u0301"), (2, "plain"), (3, None), (4, "A\u030ab")], "id int, t string")
    return x.select("id", records.nfc("t").alias("t"))


_SEARCHES = "(1, '((title:(A) AND  b))', 'title:(a) and b'), (2, '(a) OR (b)', '(a) or (b)'), (3, 'x &amp; Y', 'x & y'), (4, null, null), (5, '()', '')"


@query(f"select id, want as plain from (values {_SEARCHES}) v(id, q, want)")
def plain_searches(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, _SEARCHES, "id, q, want").select("id", records.plain_query("q").alias("plain"))


# -- numbers, lists and dates


_NUMBERS = "(1, ' 12 '), (2, '1x'), (3, null), (4, '-7'), (5, '99999999999'), (6, '')"


@query(f"select id, try_cast(trim(t) as bigint) as n from (values {_NUMBERS}) v(id, t)")
def whole_numbers(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, _NUMBERS, "id, t").select("id", records.whole_number(F.col("t")).alias("n"))


_RANGES = "(1, '0-2, 9', '0,1,2,9'), (2, 'x', ''), (3, '5-3,1', '1'), (4, '7', '7'), (5, '1-3,2-4', '1,2,3,2,3,4')"


@query(f"select id, want as pages from (values {_RANGES}) v(id, t, want)")
def page_ranges(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, _RANGES, "id, t, want").select("id", F.array_join(records.page_ranges(F.col("t")), ",").alias("pages"))


@query("select doc_id, page_no, printf('%05d.pdf', page_no) as file from pages where page_no is not null group by all")
def page_files(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").filter("page_no is not null").select("doc_id", "page_no").distinct().withColumn("file", records.page_file(F.col("page_no")))


_LISTS = "(1, array(cast(null as string), ' ', 'a', 'b')), (2, array('x')), (3, array(' ')), (4, cast(null as array<string>))"


@query("select id, list_filter(l, lambda x: trim(coalesce(x, '')) <> '')[1] as first from (values (1, [null, ' ', 'a', 'b']), (2, ['x']), (3, [' ']), (4, null)) v(id, l)")
def first_texts(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, _LISTS, "id, l").select("id", records.first_text(F.col("l")).alias("first"))


_DATES = "(1, '2024-02-29'), (2, '2023-02-29'), (3, '2024-2-1'), (4, null), (5, '2024-12-31 '), (6, '1999-01-01')"


@query(f"select id, case when regexp_matches(t, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') then try_cast(t as date) end as day from (values {_DATES}) v(id, t)")
def strict_dates(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, _DATES, "id, t").select("id", records.strict_date(F.col("t")).alias("day"))


_STAMPS = "(1, '01/03/2024 08:00'), (2, 'Mar 5, 2024'), (3, 'soon'), (4, null), (5, '31/12/2023 23:59')"


@query(f"select id, strftime(coalesce(try_strptime(t, '%d/%m/%Y %H:%M') - interval 8 hour, try_strptime(t, '%b %d, %Y')), '%Y-%m-%d %H:%M') as at from (values {_STAMPS}) v(id, t)")
def stamps(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, _STAMPS, "id, t").select("id", F.date_format(records.stamp(F.col("t")), "yyyy-MM-dd HH:mm").alias("at"))


@query("select greatest(m::date, date '2023-02-14') as start, least((m + interval 1 month)::date - 1, date '2023-06-10') as end from range(date '2023-02-01', date '2023-06-11', interval 1 month) t(m)")
def month_windows_closed(spark: SparkSession, d: str) -> DataFrame:
    return dates.months(spark, "2023-02-14", "2023-06-10")


@query("select greatest(make_date(y::int, 1, 1), date '2019-05-02') as start, least(make_date(y::int + 1, 1, 1), date '2025-06-11') as end from range(2019, 2026) t(y)")
def year_windows_open(spark: SparkSession, d: str) -> DataFrame:
    return dates.years_half_open(spark, "2019-05-02", "2025-06-10")


# -- gates


@query("select doc_id, n_pages from pdf_documents where n_pages is null or n_pages between 5 and 60")
def page_range_gate(spark: SparkSession, d: str) -> DataFrame:
    """Documents of 5 to 60 pages; those whose number isn't known pass."""
    return table(spark, d, "pdf_documents").filter(gates.within(F.col("n_pages"), 5, 60)).select("doc_id", "n_pages")


@query("select doc_id from pdf_documents where n_pages is null or n_pages >= 12")
def least_pages_gate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pdf_documents").filter(gates.within(F.col("n_pages"), 12, None)).select("doc_id")


_TABLES = "(1, 4, 3, 10.0, 0.5, false, false), (2, 4, 3, 29.0, 0.5, false, false), (3, 3, 3, 5.0, 0.5, false, true), (4, 10, 4, 12.0, 0.1, false, false), (5, 2, 2, 40.0, 0.0, false, true), (6, 2, 2, 8.0, 0.0, false, true), (7, 8, 3, 20.0, 0.2, true, false), (8, 1, 9, 3.0, 1.0, false, false), (9, 4, 2, 30.0, 0.3, true, true)"
_TABLE = "id, n_rows, n_cols, mean_cell_chars, numeric_ratio, borderless, spanned"


@query(f"""select id, n_rows >= 4 and n_cols >= 3 and mean_cell_chars <= 28 and numeric_ratio >= 0.15 as real, n_rows >= 2 and n_cols >= 2 and not (n_rows < 4 and n_cols < 3 and mean_cell_chars > 28) as ruled,
    n_rows * n_cols >= 40 or n_cols >= 6 or (spanned and (n_rows >= 4 or n_cols >= 3)) or (borderless and n_rows >= 8) as complex from (values {_TABLES}) v({_TABLE})""")
def table_gates(spark: SparkSession, d: str) -> DataFrame:
    t = F.struct(*(F.col(c) for c in _TABLE.split(", ")[1:]))
    x = _rows(spark, _TABLES, _TABLE).select("id", t.alias("t"))
    return x.select("id", geometry.is_real_table(F.col("t")).alias("real"), geometry.is_ruled_table(F.col("t")).alias("ruled"), geometry.is_complex_table(F.col("t")).alias("complex"))


# -- geometry


_CELLS = """(1, '[["a","b","1"],["x",null,"2,5"],["y","","(3)"],["z","4%","5"]]', '["a","b","c"]'), (2, '[]', null), (3, '[["1","2"],["3","4"]]', '["year",""]'), (4, '[["p","q"]]', '["",""]')"""


@query(rf"""with c as (select id, cells::json::varchar[][] as c, header::json::varchar[] as h from (values {_CELLS}) v(id, cells, header)),
    f as (select id, c, h, list_filter(list_transform(flatten(c), lambda x: trim(coalesce(x, ''))), lambda x: x <> '') as flat from c)
    select id, len(c) as n_rows, coalesce(list_max(list_transform(c, lambda r: len(r))), 0) as n_cols, len(flat) as n_filled,
        coalesce(len(list_filter(flat, lambda x: regexp_matches(x, '^[\s(\[]*[-+$€£¥]?\s*[0-9][0-9,.\s]*\s*[%)\]a-zA-Z]{{0,3}}\s*$')))::double / nullif(len(flat), 0), 0) as numeric_ratio,
        coalesce(list_sum(list_transform(flat, lambda x: length(x)))::double / nullif(len(flat), 0), 0) as mean_cell_chars,
        coalesce(list_bool_or(list_transform(flatten(c), lambda x: x is null)), false) or (len(list_filter(coalesce(h, []), lambda x: trim(coalesce(x, '')) <> '')) between 1 and coalesce(list_max(list_transform(c, lambda r: len(r))), 0) - 1) as spanned from f""")
def cell_measures(spark: SparkSession, d: str) -> DataFrame:
    x = _rows(spark, _CELLS, "id, cells, header").select("id", F.from_json("cells", "array<array<string>>").alias("c"), F.from_json("header", "array<string>").alias("h"))
    return x.select("id", geometry.cell_facts(F.col("c")).alias("f"), geometry.is_spanned(F.col("c"), F.col("h")).alias("spanned")).select("id", "f.*", "spanned")


_BOXES = "(1, 0.0, 0.0, 10.0, 10.0), (2, 0.0, 0.0, 10.0, 9.0), (3, 5.0, 5.0, 15.0, 15.0), (4, 50.0, 50.0, 60.0, 60.0), (5, 2.0, 2.0, 3.0, 3.0), (6, 1.0, 1.0, 1.0, 8.0)"
_OTHER = "0.0, 0.0, 10.0, 10.0"


@query(f"""with x as (select id, greatest(0, least(x1, 10) - greatest(x0, 0)) * greatest(0, least(y1, 10) - greatest(y0, 0)) as i, abs((x1 - x0) * (y1 - y0)) as a from (values {_BOXES}) v(id, x0, y0, x1, y1))
    select id, coalesce(i / nullif(a + 100 - i, 0), 0)::double as overlap, coalesce(i / nullif(a, 0), 0)::double as contained from x""")
def box_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """Of boxes the overlap with one of ten by ten points, and the part that lies in it."""
    names = ("x0", "y0", "x1", "y1")
    own = F.struct(*(F.col(c).cast("double").alias(c) for c in names))
    other = F.struct(*(F.lit(float(v)).alias(c) for c, v in zip(names, _OTHER.split(", "))))
    x = _rows(spark, _BOXES, "id, x0, y0, x1, y1").select("id", own.alias("a"), other.alias("b"))
    return x.select("id", geometry.overlap(F.col("a"), F.col("b")).alias("overlap"), geometry.contained(F.col("a"), F.col("b")).alias("contained"))


_FACTS = """(1, '[{"n_rows":4,"n_cols":9,"complex":true,"borderless":false,"spanned":true},{"n_rows":10,"n_cols":3,"complex":true,"borderless":true,"spanned":false}]', '[{"kind":"pie"},{"kind":"bar"},{"kind":"bar"}]'), (2, '[]', '[]'), (3, '[{"n_rows":2,"n_cols":2,"complex":false,"borderless":false,"spanned":false}]', '[{"kind":"line"}]')"""


@query(f"""with x as (select id, json_transform(tables, '[{{"n_rows":"INTEGER","n_cols":"INTEGER","complex":"BOOLEAN","borderless":"BOOLEAN","spanned":"BOOLEAN"}}]') as t, json_transform(charts, '[{{"kind":"VARCHAR"}}]') as c from (values {_FACTS}) v(id, tables, charts))
    select id, len(t) as n_tables, len(list_filter(t, lambda x: x.complex)) as n_complex_tables, len(list_filter(t, lambda x: x.borderless)) as n_borderless_tables, len(list_filter(t, lambda x: x.spanned)) as n_spanned_tables,
        coalesce(list_max(list_transform(t, lambda x: x.n_rows * x.n_cols)), 0) as max_table_cells, len(c) as n_charts, nullif(array_to_string(list_sort(list_distinct(list_transform(c, lambda x: x.kind))), ','), '') as chart_kinds from x""")
def density_rows(spark: SparkSession, d: str) -> DataFrame:
    x = _rows(spark, _FACTS, "id, tables, charts").select("id", F.from_json("tables", "array<struct<n_rows:int,n_cols:int,complex:boolean,borderless:boolean,spanned:boolean>>").alias("t"), F.from_json("charts", "array<struct<kind:string>>").alias("c"))
    return x.select("id", geometry.density_row(F.col("t"), F.col("c")).alias("r")).select("id", "r.*")


@query("""select doc_id, page_no, bool_or(n_images = 1 and s > 0.8) as covered, bool_or(s between 0.05 and 0.8) as figure, bool_or((n_drawings < 8 and s > 0.8) or (n_drawings = 0 and n_images > 0)) as rasterised
    from (select *, (coalesce(text_chars, 0) % 100) / 100.0::double as s from pages) group by 1, 2""")
def image_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages that are one image, have a figure or were rasterised; the share of the page that its largest image takes is made from the number of characters here."""
    share = F.pmod(F.coalesce("text_chars", F.lit(0)), F.lit(100)) / F.lit(100.0)
    n, m = F.col("n_images"), F.col("n_drawings")
    return table(spark, d, "pages").groupBy("doc_id", "page_no").agg(F.bool_or(geometry.covered_by_one_image(n, share)).alias("covered"), F.bool_or(geometry.raster_figure(share)).alias("figure"), F.bool_or(geometry.is_rasterised(m, n, share)).alias("rasterised"))


@query("select id, kind from (values (1, 'bar'), (2, ''), (3, 'line'), (4, 'pie'), (5, '')) v(id, kind)")
def chart_kinds(spark: SparkSession, d: str) -> DataFrame:
    """What is found on drawn pages: bars, a grid of cells (no chart), a line, a pie, and too few shapes."""
    shape = lambda x0, y0, x1, y1, fill=None, lines=0, curves=0, diagonals=0: (float(x0), float(y0), float(x1), float(y1), fill, 1, lines, curves, diagonals)
    label = lambda y: [(100.0 + 20 * i, float(y), 108.0 + 20 * i, y + 8.0, "12") for i in range(5)]
    red, blue, green = [1.0, 0.0, 0.0], [0.0, 0.0, 1.0], [0.0, 1.0, 0.0]
    bars = [shape(100 + 22 * i, 300 - h, 112 + 22 * i, 300, red if i % 2 else blue) for i, h in enumerate([20, 60, 110, 40, 90, 150, 30, 70, 120])]
    grid = [shape(100 + 40 * c, 100 + 20 * r, 138 + 40 * c, 118 + 20 * r, red) for r in range(5) for c in range(4)]
    line = [shape(100, 100, 300, 250, None, 12, 0, 10), *[shape(100, 110 + 12 * i, 300, 111 + 12 * i) for i in range(9)]]
    pie = [shape(175 - r * (i % 2), 175 - r * (i // 2 % 2), 175 + r * (1 - i % 2), 175 + r * (1 - i // 2 % 2), (red, blue, green)[i % 3], 0, 2) for i, r in enumerate((75, 40, 60, 30, 70, 35, 55, 28))]
    rows = [(1, 1, 600.0, 800.0, bars, label(310)), (2, 1, 600.0, 800.0, grid, label(310)), (3, 1, 600.0, 800.0, line, label(255)), (4, 1, 600.0, 800.0, pie, label(255)), (5, 1, 600.0, 800.0, bars[:3], label(310))]
    df = spark.createDataFrame(rows, f"doc_id long, page_no int, width double, height double, shapes {geometry.SHAPES}, words {geometry.WORDS}")
    return geometry.page_charts(df).select(F.col("doc_id").alias("id"), F.array_join(F.transform("charts", lambda c: c.kind), ",").alias("kind"))


# -- fetching and records


_ANSWERS = "('sec_edgar', 200, 'application/pdf', false, 0), ('sec_edgar', 200, 'text/html', false, 0), ('sec_edgar', 200, 'text/html', true, 0), ('sec_edgar', 403, null, false, 0), ('edinet', 200, 'application/json', false, 404), ('edinet', 200, 'application/json', false, 500), ('edinet', 200, 'application/pdf', false, 0), ('eurlex', 404, null, false, 0), ('eurlex', 200, 'application/pdf', false, 0), ('fraser', 410, null, false, 0), ('un_digital_library', 202, null, true, 0), ('un_digital_library', 202, null, false, 0), ('state_bills', 404, null, false, 0), ('state_bills', 429, null, false, 0), ('state_bills', 503, null, false, 0), ('municipal_acfr', 200, 'text/html', false, 0), ('bis', 200, 'text/html', false, 0), ('dailymed', 500, null, false, 0), ('arxiv', 200, 'application/pdf', null, null)"
_ANSWER = "source, status, kind, refused, body"


@query(f"""with x as (select *, coalesce(kind, '') like '%pdf%' as pdf, coalesce(refused, false) as r from (values {_ANSWERS}) v({_ANSWER})),
    y as (select *, case when r or status in (202, 403, 406, 408, 425, 429) or status >= 500 then 'transient' when status = 200 and pdf then 'ok' else 'permanent' end as shared from x)
    select {_ANSWER}, case when source = 'un_digital_library' and status = 202 then case when r then 'transient' else 'permanent' end
        when source in ('sec_edgar', 'municipal_acfr', 'un_digital_library') and status = 200 and not pdf and not r then 'permanent'
        when source = 'edinet' and status = 200 and not pdf then case when body in (400, 404) then 'permanent' else 'transient' end
        when source in ('eurlex', 'fraser') and shared = 'permanent' then 'second' else shared end as outcome from y""")
def fetch_outcomes(spark: SparkSession, d: str) -> DataFrame:
    x = _rows(spark, _ANSWERS, _ANSWER)
    return x.withColumn("outcome", records.outcome_of(F.col("source"), F.col("status"), F.col("kind"), F.col("refused"), F.col("body")))


@query(f"""with x as (select doc_id, {KEY} as s, extra, source_id, nullif(extra->>'title', '') as t, nullif(extra->>'search_title', '') as u from documents),
    f as (select *, lambda_ from (select *, case s when 'edinet' then concat_ws(' · ', nullif(extra->>'filer_name', ''), nullif(extra->>'doc_description', ''))
        when 'sec_edgar' then concat_ws(' · ', nullif(extra->>'company_name', ''), nullif(extra->>'form_type', ''), nullif(extra->>'filing_date', ''))
        when 'municipal_acfr' then concat_ws(' · ', nullif(extra->>'entity', ''), nullif(extra->>'entity_type', ''), nullif(extra->>'fiscal_year', ''))
        when 'bis' then concat_ws(' · ', nullif(extra->>'institution', ''), nullif(extra->>'series', ''), nullif(extra->>'doc_id', ''))
        when 'courtlistener' then coalesce(nullif(extra->>'case_name', ''), nullif(extra->>'description', ''), '') when 'govdocs1' then coalesce(extra->>'zip_member', '') when 'safedocs_ccmain' then coalesce(extra->>'file_name', '')
        else coalesce(t, u, '') end as lambda_ from x))
    select doc_id, left(coalesce(nullif(lambda_, ''), source_id), 160) as title from f""")
def display_titles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", records.title_of(source_key(F.col("source")), F.col("extra"), F.col("source_id")).alias("title"))


_PICKS = "(1, array(3, 1, 3, 9, 0), 5), (2, array(7), 5), (3, array(2, 1), null), (4, array(1, 2, 3), 3)"


@query("select id, coalesce(list_sort(list_distinct(list_filter(p, lambda x: x >= 1 and x <= n))), []) as pages from (values (1, [3, 1, 3, 9, 0], 5), (2, [7], 5), (3, [2, 1], null), (4, [1, 2, 3], 3)) v(id, p, n)")
def clamped_selection(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, _PICKS, "id, p, n").select("id", records.clamped_pages(F.col("p"), F.col("n")).alias("pages"))


@query(r"""select doc_id, url from documents where regexp_matches(lower(coalesce(discovery_query, '')), 'form|application|permit|claim|tax|questionnaire|survey|registration') and status = 'stored'""")
def form_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Stored documents whose search names a kind of form."""
    return table(spark, d, "documents").filter("status = 'stored'").filter(F.lower(F.coalesce("discovery_query", F.lit(""))).rlike("form|application|permit|claim|tax|questionnaire|survey|registration")).select("doc_id", "url")


@query("""with used as (select doc_id from subject_labels union select doc_id from fetch_attempts where not ok) select doc_id from documents where status = 'stored' and discovered_at >= timestamptz '2025-03-20 00:00:00+00' and doc_id not in (select doc_id from used where doc_id is not null)""")
def unused_since(spark: SparkSession, d: str) -> DataFrame:
    """Stored documents of a time on that none of the lists of used ones has; nulls in a list don't matter."""
    used = table(spark, d, "subject_labels").select("doc_id").union(table(spark, d, "fetch_attempts").filter("not ok").select("doc_id")).filter("doc_id is not null").distinct()
    return table(spark, d, "documents").filter("status = 'stored' and discovered_at >= timestamp'2025-03-20 00:00:00'").select("doc_id").join(used, "doc_id", "left_anti")


@query("select doc_id, coalesce(d.status, p.status) as status, coalesce(n_chars, 0) + coalesce(n_pages, 0) as size, coalesce(d.error, p.error) as error from documents d left join pdf_documents p using (doc_id)")
def facts_overlay(spark: SparkSession, d: str) -> DataFrame:
    """What the catalogue says of a document wins over what was read from its file."""
    docs, pdf = table(spark, d, "documents").select("doc_id", "status", "n_chars", "error"), table(spark, d, "pdf_documents").select("doc_id", F.col("status").alias("pdf_status"), "n_pages", F.col("error").alias("pdf_error"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return docs.join(pdf, "doc_id", "left").select("doc_id", F.coalesce("status", "pdf_status").alias("status"), (zero("n_chars") + zero("n_pages")).alias("size"), F.coalesce("error", "pdf_error").alias("error"))


@query("select slices.name, count(doc_id) as editions, max(n_chars) as longest from slices left join documents on discovery_query = slices.name group by slices.name")
def works_and_editions(spark: SparkSession, d: str) -> DataFrame:
    """The documents found for each slice's name, also where there are none."""
    docs = table(spark, d, "documents").select(F.col("discovery_query").alias("name"), "doc_id", "n_chars")
    return table(spark, d, "slices").select("name").join(docs, "name", "left").groupBy("name").agg(F.count("doc_id").alias("editions"), F.max("n_chars").alias("longest"))


@query("select source, greatest(1, trunc(sum(target) * 0.15::double)::bigint) as family_cap, trunc(sum(target) * 0.4::double)::bigint as language_cap from (select distinct source, name, target from slices where target is not null) group by source")
def share_caps(spark: SparkSession, d: str) -> DataFrame:
    """Caps as whole parts of a share of the target, a family's at least one."""
    s = table(spark, d, "slices").filter("target is not null").select("source", "name", "target").distinct().groupBy("source").agg(F.sum("target").alias("t"))
    return s.select("source", F.greatest(F.lit(1), (F.col("t") * 0.15).cast("long")).alias("family_cap"), (F.col("t") * 0.4).cast("long").alias("language_cap"))
