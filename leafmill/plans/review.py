"""Lists, records and counts for review: gates with reasons, sorted lists, full records, families."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill.functions.names import host, source_key
from leafmill.functions.records import decade
from leafmill.operators import gates, rollups
from leafmill.plans.catalogue import DENSITY, KEY
from leafmill.plans.selection import HOST
from leafmill.storage import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def note(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return note


@query("""select coalesce(reason, 'kept') as reason, count(*) as n from (
        select case when page_no > n_pages then 'out of range' when coalesce(status, '') not in ('ok', 'repaired') then 'unreadable' when covered_by_one_image then 'scan'
            when text_chars < 40 and coalesce(n_widgets, 0) = 0 then 'no text' when text_chars > 6000 and coalesce(n_widgets, 0) = 0 then 'prose' end as reason
        from pages left join pdf_documents using (doc_id)) group by 1""")
def page_gates(spark: SparkSession, d: str) -> DataFrame:
    """Every delivered page by the first gate that rejects it."""
    x = table(spark, d, "pages").select("doc_id", "page_no", "covered_by_one_image", "text_chars", "n_widgets").join(table(spark, d, "pdf_documents").select("doc_id", "n_pages", "status"), "doc_id", "left")
    plain = F.coalesce("n_widgets", F.lit(0)) == 0
    return gates.tally(x, [("out of range", F.col("page_no") > F.col("n_pages")), ("unreadable", ~F.coalesce("status", F.lit("")).isin("ok", "repaired")), ("scan", F.col("covered_by_one_image")), ("no text", (F.col("text_chars") < 40) & plain), ("prose", (F.col("text_chars") > 6000) & plain)])


@query(f"""with {DENSITY} select d.doc_id, n_pages, row_number() over (order by coalesce(case when pages_measured > pages_opaque then dense_pages::double / (pages_measured - pages_opaque) when pages_measured is not null then 0 end, -1) desc, d.doc_id) as place
    from documents d left join pdf_documents p using (doc_id) left join density using (doc_id) where d.status = 'stored' and coalesce(n_pages, 0) between 0 and 400 order by place limit 100""")
def document_list(spark: SparkSession, d: str) -> DataFrame:
    """The first hundred stored documents of at most 400 pages by share of dense pages, the unmeasured ones last; the limit is the feature."""
    density = rollups.document_density(table(spark, d, "page_density")).select("doc_id", "dense_share")
    x = table(spark, d, "documents").filter("status = 'stored'").select("doc_id").join(table(spark, d, "pdf_documents").select("doc_id", "n_pages"), "doc_id", "left").join(density, "doc_id", "left")
    top = x.filter("coalesce(n_pages, 0) between 0 and 400").orderBy(F.desc_nulls_last("dense_share"), "doc_id").limit(100)
    return top.select("doc_id", "n_pages", F.row_number().over(Window.orderBy(F.desc_nulls_last("dense_share"), "doc_id")).alias("place"))


@query("""with a as (select doc_id, count(*) as attempts, count(*) filter (not ok) as failed, max(ts) as last_ts from (select distinct * from fetch_attempts) group by doc_id)
    select doc_id, d.status, p.status as pdf_status, coalesce(attempts, 0) as attempts, coalesce(failed, 0) as failed, last_ts, coalesce(n_pages, 0) as n_pages from documents d left join a using (doc_id) left join pdf_documents p using (doc_id)""")
def document_records(spark: SparkSession, d: str) -> DataFrame:
    """Every document with its attempts and facts."""
    a = table(spark, d, "fetch_attempts").distinct().groupBy("doc_id").agg(F.count("*").alias("attempts"), F.count_if(~F.col("ok")).alias("failed"), F.max("ts").alias("last_ts"))
    p = table(spark, d, "pdf_documents").select("doc_id", F.col("status").alias("pdf_status"), "n_pages")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return table(spark, d, "documents").select("doc_id", "status").join(a, "doc_id", "left").join(p, "doc_id", "left").select("doc_id", "status", "pdf_status", zero("attempts"), zero("failed"), "last_ts", zero("n_pages"))


@query("select status, count(*) as docs, round(sum(n_bytes) / pow(1024, 3), 9) as gib from documents group by status")
def status_report(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("status").agg(F.count("*").alias("docs"), F.round(F.sum("n_bytes") / F.pow(F.lit(1024), F.lit(3)), 9).alias("gib"))


@query(r"""select case when regexp_matches(y, '^[0-9]{4}') then left(y, 3) || '0s' else 'undated' end as family, count(*) as docs
    from (select coalesce(regexp_extract(extra->>'title', '((18|19|20)[0-9]{2})', 1), '') as y from documents) group by 1""")
def decade_families(spark: SparkSession, d: str) -> DataFrame:
    """Documents by the decade named in their title."""
    year = F.coalesce(F.regexp_extract(F.get_json_object("extra", "$.title"), "((18|19|20)[0-9]{2})", 1), F.lit(""))
    return table(spark, d, "documents").groupBy(decade(year).alias("family")).agg(F.count("*").alias("docs"))


@query(f"""select family, count(*) as docs, count(distinct lang_) as languages from (select case when {KEY} = 'safedocs_ccmain' then coalesce({HOST}, '') else {KEY} end as family,
    case when lower(lang) in ('en', 'eng') then 'en' when lower(lang) in ('fr', 'fra') then 'fr' when lower(lang) in ('de', 'deu') then 'de' when lower(lang) in ('es', 'spa') then 'es' else 'und' end as lang_ from documents) group by family""")
def families(spark: SparkSession, d: str) -> DataFrame:
    """Families of documents: the source, or the host for what was crawled from the web."""
    source = source_key(F.col("source"))
    lang = F.lower("lang")
    code = F.when(lang.isin("en", "eng"), "en").when(lang.isin("fr", "fra"), "fr").when(lang.isin("de", "deu"), "de").when(lang.isin("es", "spa"), "es").otherwise("und")
    family = F.when(source == "safedocs_ccmain", F.coalesce(host(F.col("domain"), F.col("url")), F.lit(""))).otherwise(source)
    return table(spark, d, "documents").select(family.alias("family"), code.alias("l")).groupBy("family").agg(F.count("*").alias("docs"), F.count_distinct("l").alias("languages"))


@query("select producer, count(*) as n from pdf_documents where producer is not null group by 1 order by n desc, producer limit 5")
def common_producers(spark: SparkSession, d: str) -> DataFrame:
    """The five most common producers; the limit is the feature."""
    return table(spark, d, "pdf_documents").filter("producer is not null").groupBy("producer").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "producer").limit(5)


@query("""with s as (select distinct source, name, target, expected_dense from slices where target is not null and not isnan(expected_dense))
    select source, name, round_even(target / greatest(expected_dense, 0.05), 0)::bigint as to_collect from s""")
def overshoot(spark: SparkSession, d: str) -> DataFrame:
    """How many documents to collect so that the target is met at the expected yield (0.05 at least)."""
    s = table(spark, d, "slices").filter("target is not null and not isnan(expected_dense)").select("source", "name", "target", "expected_dense").distinct()
    return s.select("source", "name", F.bround(F.col("target") / F.greatest("expected_dense", F.lit(0.05)), 0).cast("long").alias("to_collect"))


@query("""with t as (select doc_id, page_no, has_text_layer, row_number() over (partition by doc_id, coalesce(has_text_layer, false) order by page_no, id) as k from (select * from (select *, row_number() over (partition by doc_id, page_no order by id) as r from pages) where r = 1))
    select doc_id, page_no, coalesce(has_text_layer, false) as born_digital from t where k <= case when coalesce(has_text_layer, false) then 3 else 1 end""")
def two_populations(spark: SparkSession, d: str) -> DataFrame:
    """Per document up to three pages with a text layer and one without: a cap for each of two populations."""
    once = table(spark, d, "pages").groupBy("doc_id", "page_no").agg(F.min_by(F.struct("has_text_layer", "id"), "id").alias("x")).select("doc_id", "page_no", F.coalesce("x.has_text_layer", F.lit(False)).alias("born_digital"), "x.id")
    place = F.row_number().over(Window.partitionBy("doc_id", "born_digital").orderBy("page_no", "id"))
    return once.withColumn("k", place).filter("k <= 3").filter("k <= case when born_digital then 3 else 1 end").select("doc_id", "page_no", "born_digital")
