"""Reports over the catalogue: counts, roll-ups of page measurements, and the index of documents and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill.functions import licences
from leafmill.functions.names import source_key
from leafmill.functions.pages import FILTERS, page_filter, table_score
from leafmill.operators import rollups
from leafmill.storage import table

QUERIES: dict = {}
SQL: dict[str, str] = {}

#: The key of a source, and views that several texts share.
KEY = r"regexp_replace(lower(regexp_replace(source, '^[\s ]+|[\s ]+$', '', 'g')), '[\s _-]+', '_', 'g')"
DENSITY = """
    density as (
        select doc_id, count(*) as pages_measured, count(*) filter (not m) as pages_opaque, count(*) filter (is_table_page) as table_pages, count(*) filter (is_chart_page) as chart_pages,
               count(*) filter (not coalesce(chart_measurable, false)) as chart_blind_pages, count(*) filter (m and dense) as dense_pages,
               count(*) filter (possible_raster_figure) as raster_figure_pages, coalesce(max(max_table_cells), 0) as max_table_cells,
               count(*) filter (n_borderless_tables > 0) as borderless_pages
        from (select *, coalesce(table_measurable, false) or coalesce(chart_measurable, false) as m, coalesce(is_table_page, false) or coalesce(is_chart_page, false) as dense
              from (select doc_id, page_no, bool_or(table_measurable) as table_measurable, bool_or(chart_measurable) as chart_measurable, bool_or(is_table_page) as is_table_page, bool_or(is_chart_page) as is_chart_page,
                           bool_or(possible_raster_figure) as possible_raster_figure, max(max_table_cells) as max_table_cells, max(n_borderless_tables) as n_borderless_tables from page_density group by doc_id, page_no))
        group by doc_id)"""
ONCE = "(select * from (select *, row_number() over (partition by doc_id, page_no order by id) as delivery from pages) where delivery = 1)"
ROLLUP = f"""
    rollup_ as (
        select doc_id, count(*) filter (not has_text_layer or covered_by_one_image) as scanned, count(*) filter (n_widgets > 0) as forms,
               count(*) filter (rotation <> 0 or (text_angle is not null and text_angle <> 0)) as rotated from {ONCE} group by doc_id)"""


def query(sql: str | None = None):
    def note(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return note


def _n(condition: Column | str) -> Column:
    return F.count_if(F.expr(condition) if isinstance(condition, str) else condition)


@query("select status, count(*) as n from documents group by status")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("status").agg(F.count("*").alias("n"))


@query(f"select {KEY} as source, status, count(*) as n, coalesce(sum(n_bytes), 0)::bigint as n_bytes from documents group by 1, 2")
def bytes_by_source(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy(source_key(F.col("source")).alias("source"), "status").agg(F.count("*").alias("n"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n_bytes"))


@query("select doc_id, count(*) as attempts, min(ts) as first_ts, max(ts) as last_ts, count(*) filter (not ok) as failed from (select distinct * from fetch_attempts) group by doc_id")
def attempt_profile(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "fetch_attempts").distinct().groupBy("doc_id").agg(F.count("*").alias("attempts"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), _n("not ok").alias("failed"))


@query(f"with {ROLLUP} select * from rollup_")
def page_rollup(spark: SparkSession, d: str) -> DataFrame:
    return rollups.page_rollup(table(spark, d, "pages"))


@query(f"""
    select 'pdf_' || coalesce(status, 'null') as measure, count(*) as n from pdf_documents group by 1
    union all select * from (select unnest(['pages', 'text_layer', 'covered', 'form', 'rotated', 'rendered']) as measure,
        unnest([count(*), count(*) filter (has_text_layer), count(*) filter (covered_by_one_image), count(*) filter (n_widgets > 0), count(*) filter (rotation <> 0 or text_angle <> 0), count(render_sha256)]) as n from {ONCE})""")
def preprocess_summary(spark: SparkSession, d: str) -> DataFrame:
    status = table(spark, d, "pdf_documents").groupBy(F.concat(F.lit("pdf_"), F.coalesce("status", F.lit("null"))).alias("measure")).agg(F.count("*").alias("n"))
    once = rollups.once(table(spark, d, "pages"), ["has_text_layer", "covered_by_one_image", "n_widgets", "rotation", "text_angle", "render_sha256"])
    one = once.agg(F.count("*").alias("pages"), _n("has_text_layer").alias("text_layer"), _n("covered_by_one_image").alias("covered"), _n("n_widgets > 0").alias("form"), _n("rotation <> 0 or text_angle <> 0").alias("rotated"), F.count("render_sha256").alias("rendered"))
    return status.unionByName(one.unpivot([], one.columns, "measure", "n"))


@query(f"""with {DENSITY} select *, case when pages_measured > pages_opaque then dense_pages::double / (pages_measured - pages_opaque) else 0 end as dense_share,
    pages_measured > pages_opaque and dense_pages::double / nullif(pages_measured - pages_opaque, 0) >= 0.33 as is_dense_doc from density""")
def document_density(spark: SparkSession, d: str) -> DataFrame:
    return rollups.document_density(table(spark, d, "page_density"))


@query(f"""with {DENSITY}, x as (select *, pages_measured > pages_opaque and dense_pages::double / nullif(pages_measured - pages_opaque, 0) >= 0.33 as is_dense from density)
    select {KEY} as source, count(*) as docs, count(x.doc_id) as measured, count(*) filter (is_dense) as dense_docs, count(*) filter (pages_measured = pages_opaque) as opaque_docs,
        count(*) filter (x.doc_id is null) as unmeasured, sum(table_pages)::bigint as table_pages, sum(chart_pages)::bigint as chart_pages, sum(borderless_pages)::bigint as borderless_pages
    from documents d left join x using (doc_id) where status = 'stored' group by 1""")
def yield_by_source(spark: SparkSession, d: str) -> DataFrame:
    """Per source the stored documents that are measured, dense, opaque and, apart from these, not measured."""
    density = rollups.document_density(table(spark, d, "page_density"))
    docs = table(spark, d, "documents").filter("status = 'stored'").select("doc_id", source_key(F.col("source")).alias("source"))
    return rollups.yield_by(docs, density, "source")


@query(f"""with {DENSITY} select count(*) as docs, sum(pages_measured)::bigint as pages, sum(pages_opaque)::bigint as opaque, sum(table_pages)::bigint as table_pages, sum(chart_pages)::bigint as chart_pages,
    count(*) filter (pages_measured > pages_opaque and dense_pages::double / nullif(pages_measured - pages_opaque, 0) >= 0.33) as dense_docs from density""")
def corpus_totals(spark: SparkSession, d: str) -> DataFrame:
    x = rollups.document_density(table(spark, d, "page_density"))
    return x.agg(F.count("*").alias("docs"), F.sum("pages_measured").alias("pages"), F.sum("pages_opaque").alias("opaque"), F.sum("table_pages").alias("table_pages"), F.sum("chart_pages").alias("chart_pages"), _n("is_dense_doc").alias("dense_docs"))


_PROGRESS = f"""{DENSITY}, x as (select *, pages_measured > pages_opaque and dense_pages::double / nullif(pages_measured - pages_opaque, 0) >= 0.33 as is_dense from density),
    progress as (select {KEY} as source, count(*) filter (status = 'stored') as stored, count(x.doc_id) filter (status = 'stored') as measured, count(*) filter (is_dense and status = 'stored') as dense,
        count(*) filter (pages_measured = pages_opaque and status = 'stored') as opaque_docs from documents left join x using (doc_id) group by 1)"""


@query(f"with {_PROGRESS} select * from progress")
def campaign_progress(spark: SparkSession, d: str) -> DataFrame:
    return rollups.progress(table(spark, d, "documents"), rollups.document_density(table(spark, d, "page_density")))


@query(f"""with {_PROGRESS}, s as (select distinct {KEY} as source from slices where lower(trim(bucket)) = 'dense')
    select sum(stored)::bigint as stored, sum(measured)::bigint as measured, sum(dense)::bigint as dense, sum(dense)::double / nullif(sum(measured), 0) as low,
        least(1, (sum(dense) + sum(case when s.source is not null then opaque_docs else 0 end))::double / nullif(sum(measured), 0)) as high from progress left join s using (source)""")
def campaign_range(spark: SparkSession, d: str) -> DataFrame:
    """The share of dense documents as a range: opaque documents of sources planned as dense widen it, they don't move it."""
    progress = campaign_progress(spark, d)
    dense = table(spark, d, "slices").filter("lower(trim(bucket)) = 'dense'").select(source_key(F.col("source")).alias("source")).distinct().withColumn("planned", F.lit(True))
    both = progress.join(dense, "source", "left").agg(F.sum("stored").alias("stored"), F.sum("measured").alias("measured"), F.sum("dense").alias("dense"), F.sum(F.when(F.col("planned"), F.col("opaque_docs")).otherwise(0)).alias("open"))
    return both.select("stored", "measured", "dense", F.try_divide("dense", "measured").alias("low"), F.least(F.lit(1.0), F.try_divide(F.col("dense") + F.col("open"), F.col("measured"))).alias("high"))


_SLICES = f"(select distinct {KEY} as source, name, target, lower(trim(bucket)) as bucket, expected_dense, mostly_opaque from slices where target is not null)"


def _slices(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "slices").filter("target is not null").select(source_key(F.col("source")).alias("source"), "name", "target", F.lower(F.trim("bucket")).alias("bucket"), "expected_dense", "mostly_opaque").distinct()


@query(f"""select count(*) as slices, sum(target)::bigint as planned, (sum(target) filter (bucket = 'dense'))::bigint as dense, (sum(target) filter (bucket = 'varied'))::bigint as varied,
    (sum(target) filter (mostly_opaque))::bigint as opaque, round(sum(target * expected_dense), 6) as expected_dense from {_SLICES}""")
def plan_totals(spark: SparkSession, d: str) -> DataFrame:
    t = lambda c: F.sum(F.when(F.expr(c), F.col("target")))
    return _slices(spark, d).agg(F.count("*").alias("slices"), F.sum("target").alias("planned"), t("bucket = 'dense'").alias("dense"), t("bucket = 'varied'").alias("varied"), t("mostly_opaque").alias("opaque"), F.round(F.sum(F.col("target") * F.col("expected_dense")), 6).alias("expected_dense"))


@query(f"select source, round(sum(target * expected_dense) / nullif(sum(target), 0), 9) as expected from {_SLICES} where not isnan(expected_dense) group by source")
def weighted_yield(spark: SparkSession, d: str) -> DataFrame:
    return _slices(spark, d).filter("not isnan(expected_dense)").groupBy("source").agg(F.round(F.try_divide(F.sum(F.col("target") * F.col("expected_dense")), F.sum("target")), 9).alias("expected"))


@query(f"""with {_PROGRESS}, e as (select source, sum(target * expected_dense) / nullif(sum(target), 0) as expected from {_SLICES} where not isnan(expected_dense) group by source),
    j as (select source, measured - opaque_docs as judged, dense::double / (measured - opaque_docs) as yield_, expected from progress join e using (source) where measured - opaque_docs >= 20)
    select source, judged, round(yield_ - expected, 9) as drift, case when round(yield_ - expected, 9) <= -0.20 then 'under' when round(yield_ - expected, 9) >= 0.15 then 'over' else 'as planned' end as verdict from j""")
def yield_drift(spark: SparkSession, d: str) -> DataFrame:
    """How far the yield of a source with 20 judged documents or more is from what was planned."""
    judged = campaign_progress(spark, d).withColumn("judged", F.col("measured") - F.col("opaque_docs")).filter("judged >= 20")
    x = judged.join(_slices(spark, d).filter("not isnan(expected_dense)").groupBy("source").agg(F.try_divide(F.sum(F.col("target") * F.col("expected_dense")), F.sum("target")).alias("expected")), "source")
    drift = F.round(F.col("dense") / F.col("judged") - F.col("expected"), 9)
    return x.select("source", "judged", drift.alias("drift"), F.when(drift <= -0.20, "under").when(drift >= 0.15, "over").otherwise("as planned").alias("verdict"))


@query(f"""with s as {_SLICES}, k as (select {KEY} as source, discovery_query as name, count(*) as done from documents where status = 'stored' group by 1, 2)
    select source, name, target, coalesce(done, 0) as done, greatest(0, round_even(target * 1.1, 0)::bigint - coalesce(done, 0)) as remaining from s left join k using (source, name)""")
def slice_remaining(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "documents").filter("status = 'stored'").groupBy(source_key(F.col("source")).alias("source"), F.col("discovery_query").alias("name")).agg(F.count("*").alias("done"))
    x = _slices(spark, d).join(done, ["source", "name"], "left")
    n = F.coalesce("done", F.lit(0))
    return x.select("source", "name", "target", n.alias("done"), F.greatest(F.lit(0), F.bround(F.col("target") * F.lit(1.1), 0).cast("long") - n).alias("remaining"))


@query(f"select {licences.tier_sql('license')} as tier, count(*) as docs from documents where status = 'stored' group by 1")
def licence_split(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter("status = 'stored'").groupBy(licences.licence_tier(F.col("license")).alias("tier")).agg(F.count("*").alias("docs"))


@query(f"""with {ROLLUP}, {DENSITY} select d.doc_id, {KEY} as source, p.n_pages, p.status as pdf_status, case when pages_measured > pages_opaque then dense_pages::double / (pages_measured - pages_opaque) when pages_measured is not null then 0 end as dense_share,
    table_pages, chart_pages, pages_measured, pages_opaque, borderless_pages, max_table_cells, scanned, forms, rotated
    from documents d left join pdf_documents p using (doc_id) left join density using (doc_id) left join rollup_ using (doc_id) where d.status = 'stored' and stored_path is not null""")
def document_index(spark: SparkSession, d: str) -> DataFrame:
    """Stored documents with their facts, measurements and page counts; each side is aggregated before the join."""
    docs = table(spark, d, "documents").filter("status = 'stored' and stored_path is not null").select("doc_id", source_key(F.col("source")).alias("source"))
    pdf = table(spark, d, "pdf_documents").select("doc_id", "n_pages", F.col("status").alias("pdf_status"))
    density = rollups.document_density(table(spark, d, "page_density")).select("doc_id", "dense_share", "table_pages", "chart_pages", "pages_measured", "pages_opaque", "borderless_pages", "max_table_cells")
    return docs.join(pdf, "doc_id", "left").join(density, "doc_id", "left").join(rollups.page_rollup(table(spark, d, "pages")), "doc_id", "left")


_PAGES = """
    once as (select * from (select *, row_number() over (partition by doc_id, page_no order by id) as k from pages) where k = 1),
    best as (select doc_id, page_no, bool_or(is_table_page) as is_table_page, bool_or(is_chart_page) as is_chart_page, max(n_borderless_tables) as n_borderless_tables from page_density group by 1, 2)"""


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages once each, in their delivery of the smallest id, with what was measured on them."""
    cols = ["doc_id", "page_no", "id", "width_pt", "height_pt", "rotation", "text_chars", "has_text_layer", "n_widgets", "text_angle", "covered_by_one_image"]
    once = table(spark, d, "pages").select(*cols).groupBy("doc_id", "page_no").agg(F.min_by(F.struct(*cols[2:]), "id").alias("x")).select("doc_id", "page_no", "x.*")
    best = table(spark, d, "page_density").groupBy("doc_id", "page_no").agg(F.bool_or("is_table_page").alias("is_table_page"), F.bool_or("is_chart_page").alias("is_chart_page"), F.max("n_borderless_tables").alias("n_borderless_tables"))
    return once.join(best, ["doc_id", "page_no"], "left")


@query(f"""with {_PAGES}, hit as (select doc_id, page_no, n_borderless_tables from once left join best using (doc_id, page_no) where {FILTERS['table']} and {FILTERS['borderless']})
    select doc_id, page_no, n_borderless_tables, (select count(*) from hit) as total from hit order by doc_id, page_no limit 200 offset 200""")
def find_pages_page2(spark: SparkSession, d: str) -> DataFrame:
    """The second result page of 200, with the number of all hits; the limit is the feature."""
    hit = _pages(spark, d).filter(page_filter(["table", "borderless"])).select("doc_id", "page_no", "n_borderless_tables")
    return hit.orderBy("doc_id", "page_no").offset(200).limit(200).withColumn("total", F.lit(hit.count()))


@query(f"""with {_PAGES}, j as (select * from once left join best using (doc_id, page_no))
    select unnest({sorted(FILTERS)!r}) as name, unnest([{', '.join(f"count(*) filter ({FILTERS[k]})" for k in sorted(FILTERS))}]) as pages from j""")
def filter_counts(spark: SparkSession, d: str) -> DataFrame:
    one = _pages(spark, d).agg(*(F.count_if(page_filter([k])).alias(k) for k in sorted(FILTERS)))
    return one.unpivot([], one.columns, "name", "pages")


@query(f"with {_PAGES} select doc_id, page_no, rotation, text_chars, n_widgets, is_table_page, is_chart_page, n_borderless_tables from once left join best using (doc_id, page_no)")
def page_signals(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d).select("doc_id", "page_no", "rotation", "text_chars", "n_widgets", "is_table_page", "is_chart_page", "n_borderless_tables")


@query("select doc_id from documents d where status = 'stored' and not exists (select 1 from page_density p where p.doc_id = d.doc_id)")
def unmeasured(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter("status = 'stored'").select("doc_id").join(table(spark, d, "page_density").select("doc_id"), "doc_id", "left_anti")


@query("select doc_id, count(*) as rows_left from page_density p where exists (select 1 from documents d where d.doc_id = p.doc_id) group by doc_id")
def cascade_delete(spark: SparkSession, d: str) -> DataFrame:
    """Rows of measurements that remain once those of deleted documents are gone."""
    kept = rollups.cascade(table(spark, d, "page_density").select("doc_id"), table(spark, d, "documents"), "doc_id")
    return kept.groupBy("doc_id").agg(F.count("*").alias("rows_left"))


@query(f"""with k as (select doc_id, lower(trim(unnest(string_split(chart_kinds, ',')))) as kind from page_density)
    select {KEY} as source, string_agg(distinct nullif(kind, ''), ',' order by nullif(kind, '')) as kinds from documents left join k using (doc_id) group by 1""")
def kinds_by_source(spark: SparkSession, d: str) -> DataFrame:
    kinds = table(spark, d, "page_density").select("doc_id", F.explode(F.split("chart_kinds", ",")).alias("kind")).select("doc_id", F.nullif(F.lower(F.trim("kind")), F.lit("")).alias("kind")).distinct()
    joined = table(spark, d, "documents").select("doc_id", source_key(F.col("source")).alias("source")).join(kinds, "doc_id", "left")
    return joined.groupBy("source").agg(F.nullif(F.array_join(F.array_sort(F.collect_set("kind")), ","), F.lit("")).alias("kinds"))


@query(f"""with a as (select doc_id, text_angle, sum(text_chars)::bigint as chars, min(page_no) as first_page from {ONCE} where text_angle is not null group by 1, 2)
    select doc_id, text_angle, chars from (select *, row_number() over (partition by doc_id order by chars desc nulls last, first_page, text_angle) as k from a) where k = 1""")
def weighted_mode(spark: SparkSession, d: str) -> DataFrame:
    """The text angle that holds most characters of a document; ties go to the angle seen first."""
    angles = rollups.once(table(spark, d, "pages"), ["text_angle", "text_chars"]).filter("text_angle is not null").groupBy("doc_id", "text_angle").agg(F.sum("text_chars").alias("chars"), F.min("page_no").alias("first_page"))
    best = F.max_by(F.struct("text_angle", "chars"), F.struct(F.coalesce("chars", F.lit(-1)), -F.col("first_page"), -F.col("text_angle")))
    return angles.groupBy("doc_id").agg(best.alias("b")).select("doc_id", "b.*")


@query(f"select doc_id, count(*) as pages, coalesce(round(stddev_pop(width_pt::double) / nullif(avg(width_pt::double), 0), 4), -1) as variation from {ONCE} group by doc_id")
def width_variation(spark: SparkSession, d: str) -> DataFrame:
    w = F.col("width_pt").cast("double")
    return rollups.once(table(spark, d, "pages"), ["width_pt"]).groupBy("doc_id").agg(F.count("*").alias("pages"), F.coalesce(F.round(F.try_divide(F.stddev_pop(w), F.avg(w)), 4), F.lit(-1)).alias("variation"))


@query(f"select {KEY} as source, count(*) as docs, coalesce(sum(n_pages), 0)::bigint as pages from documents d left join pdf_documents p using (doc_id) where d.status = 'stored' group by 1")
def index_summary(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").filter("status = 'stored'").select("doc_id", source_key(F.col("source")).alias("source"))
    return docs.join(table(spark, d, "pdf_documents").select("doc_id", "n_pages"), "doc_id", "left").groupBy("source").agg(F.count("*").alias("docs"), F.coalesce(F.sum("n_pages"), F.lit(0)).alias("pages"))


_CANDIDATES = """
    b as (select doc_id, page_no, max(n_complex_tables) as c, max(n_borderless_tables) as b, max(n_spanned_tables) as s, max(max_table_cells) as m from page_density where is_table_page and not coalesce(possible_raster_figure, false) group by 1, 2),
    once as (select doc_id, page_no, width_pt, height_pt, has_text_layer, covered_by_one_image from (select *, row_number() over (partition by doc_id, page_no order by id) as k from pages) where k = 1),
    score as (select doc_id, page_no, 2 * coalesce(c, 0) + 2 * coalesce(b, 0) + 2 * coalesce(s, 0) + least(coalesce(m, 0) / 100.0::double, 3) + case when coalesce(width_pt, 0) > coalesce(height_pt, 1) then 1 else 0 end as score
              from b join once using (doc_id, page_no) join documents d using (doc_id) join pdf_documents p using (doc_id) where d.status = 'stored' and has_text_layer and not coalesce(covered_by_one_image, false))"""


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    measured = table(spark, d, "page_density").filter("is_table_page and not coalesce(possible_raster_figure, false)")
    measured = measured.groupBy("doc_id", "page_no").agg(F.max("n_complex_tables").alias("c"), F.max("n_borderless_tables").alias("b"), F.max("n_spanned_tables").alias("s"), F.max("max_table_cells").alias("m"))
    page = table(spark, d, "pages").groupBy("doc_id", "page_no").agg(F.min_by(F.struct("width_pt", "height_pt", "has_text_layer", "covered_by_one_image"), "id").alias("x")).select("doc_id", "page_no", "x.*").filter("has_text_layer and not coalesce(covered_by_one_image, false)")
    docs = table(spark, d, "documents").filter("status = 'stored'").select("doc_id").join(table(spark, d, "pdf_documents").select("doc_id"), "doc_id")
    joined = measured.join(page, ["doc_id", "page_no"]).join(docs, "doc_id")
    return joined.select("doc_id", "page_no", table_score(*map(F.col, ["c", "b", "s", "m", "width_pt", "height_pt"])).cast("double").alias("score"))


@query(f"with {_CANDIDATES} select doc_id, page_no, round(score, 6) as score from score")
def candidate_table_pages(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d).withColumn("score", F.round("score", 6))


@query(f"with {_CANDIDATES} select doc_id, page_no from (select *, row_number() over (partition by doc_id order by score desc, page_no) as k from score) where k <= 2")
def best_two_per_document(spark: SparkSession, d: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("score"), "page_no"))
    return _candidates(spark, d).withColumn("k", place).filter("k <= 2").select("doc_id", "page_no")


@query(f"""with {_CANDIDATES}, two as (select doc_id, page_no from (select *, row_number() over (partition by doc_id order by score desc, page_no) as k from score) where k <= 2)
    select nullif(regexp_extract(lower(sha256), '[0-9a-f]{{64}}'), '') as sha, list_sort(list(distinct page_no)) as pages from two join documents using (doc_id) where nullif(regexp_extract(lower(sha256), '[0-9a-f]{{64}}'), '') is not null group by 1""")
def selected_map(spark: SparkSession, d: str) -> DataFrame:
    """The selected pages (the best two of each document) by content: different pages in order, so that copies of a content don't lengthen the list."""
    sha = F.nullif(F.regexp_extract(F.lower("sha256"), "[0-9a-f]{64}", 0), F.lit(""))
    docs = table(spark, d, "documents").select("doc_id", sha.alias("sha")).filter("sha is not null")
    return best_two_per_document(spark, d).join(docs, "doc_id").groupBy("sha").agg(F.array_sort(F.collect_set("page_no")).alias("pages"))
