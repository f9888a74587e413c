"""The queries of the operators for training data over the project's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions.names import host, source_key
from leafmill.storage import cut, table

from . import caps, diverse, history, mixing, packing, quotas, subjects, tokens, topn


def _stored(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter("status = 'stored'")


# 1 -- a varied subset


KNOWN_KINDS = ["bar", "line", "pie", "mixed"]


def kind_names(column):
    """The chart kinds named in a list by comma."""
    return F.filter(F.transform(F.split(F.lower(F.coalesce(column, F.lit(""))), ","), lambda x: F.trim(x)), lambda x: x != "")


def further_kinds(df: DataFrame, column: str, most: int = 58) -> list[str]:
    """Kinds that occur besides the known ones, in order; an error if there are more than have a bit."""
    names = df.select(column).distinct().select(F.explode(kind_names(F.col(column))).alias("name")).filter(~F.col("name").isin(KNOWN_KINDS))
    found = sorted(r["name"] for r in names.distinct().limit(most + 1).collect())
    if len(found) > most:
        raise ValueError(f"more than {most} chart kinds besides {', '.join(KNOWN_KINDS)}")
    return found


def kind_bits(column, further: list[str]):
    """A set of chart kinds as bits: the known kinds come first, then the further ones that occur, each with a bit of its own."""
    own = F.array(*map(F.lit, KNOWN_KINDS + further))
    places = F.transform(kind_names(column), lambda x: F.array_position(own, x) - 1)
    # sum of powers of two over distinct places
    return F.aggregate(F.array_distinct(places), F.lit(0).cast("long"), lambda a, x: a + F.pow(F.lit(2.0), x).cast("long"))


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """Measured pages, each in one measurement, with the number and kinds of what is on them."""
    measured = table(spark, d, "page_density").filter("error is null and n_borderless_tables is not null and (coalesce(table_measurable, true) or coalesce(chart_measurable, true))")
    rows = measured.select("doc_id", "page_no", F.struct("n_borderless_tables", F.coalesce("chart_kinds", F.lit("")).alias("chart_kinds")).alias("x"))
    return rows.groupBy("doc_id", "page_no").agg(F.max("x").alias("x")).select("doc_id", "page_no", F.col("x.n_borderless_tables").alias("number"), kind_bits(F.col("x.chart_kinds"), further_kinds(measured, "chart_kinds")).alias("kinds"))


def _items(spark: SparkSession, d: str) -> DataFrame:
    source = table(spark, d, "documents").select("doc_id", F.xxhash64(source_key(F.col("source"))).alias("group"))
    return _pages(spark, d).join(source, "doc_id", "left")


def varied_pages(spark: SparkSession, d: str, size: int = 300) -> DataFrame:
    chosen = diverse.varied_subset(_items(spark, d), size)
    return chosen.select("doc_id", "page_no", "kinds", F.col("number").alias("n_borderless_tables"), F.round("gain", 6).alias("gain"), "place")


def varied_coverage(spark: SparkSession, d: str, size: int = 300) -> DataFrame:
    """Every measured page with the chosen page that is most like it."""
    items = _items(spark, d)
    return diverse.coverage(items, cut(diverse.varied_subset(items, size)))


# 2 -- a sample in target proportions


def _sample(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    slices = table(spark, d, "slices").select("source", "name", "target", F.lower(F.trim("bucket")).alias("bucket")).distinct()
    plan = slices.select(source_key(F.col("source")).alias("source"), "name", "target", "bucket")
    docs = _stored(spark, d).select(F.col("doc_id").alias("id"), source_key(F.col("source")).alias("source"), F.col("discovery_query").alias("name"))
    chosen, report = quotas.quota_sample(docs, plan, docs.count() / 5)
    return chosen, report, slices


def sampled(spark: SparkSession, d: str) -> DataFrame:
    return _sample(spark, d)[0].withColumnRenamed("id", "doc_id")


def sample_report(spark: SparkSession, d: str) -> DataFrame:
    return _sample(spark, d)[1].withColumn("wanted", F.round("wanted", 6))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """The slices that the drawn sample reports as short, as spelled in the plan."""
    _, report, slices = _sample(spark, d)
    short = report.filter("short").select(F.col("source").alias("key"), "name")
    spelled = slices.filter("target is not null").select("source", "name", source_key(F.col("source")).alias("key")).distinct()
    return spelled.join(F.broadcast(short), ["key", "name"]).select("source", "name")


# 4 -- the best pages of each document


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "page_density").filter("n_complex_tables is not null and doc_id is not null").select("doc_id", "page_no", "n_complex_tables", "max_table_cells")
    order = [F.desc("n_complex_tables"), F.desc_nulls_last("max_table_cells"), F.asc_nulls_last("page_no")]
    return topn.top_n(rows, "doc_id", "page_no", order, 3).select("doc_id", "page_no")


# 5 -- at most eight documents of a domain


def _contributions(spark: SparkSession, d: str) -> DataFrame:
    quality = table(spark, d, "page_density").groupBy("doc_id").agg(F.max("n_complex_tables").alias("quality"))
    docs = _stored(spark, d).select("doc_id", host(F.col("domain"), F.col("url")).alias("contributor"), "discovered_at")
    return docs.join(quality, "doc_id", "left").select("contributor", F.col("doc_id").alias("id"), F.coalesce("quality", F.lit(0)).cast("double").alias("quality"), "discovered_at")


def _capped(spark: SparkSession, d: str, limit: int = 8, shares: tuple[float, ...] = (0.5, 0.75)) -> caps.CapState:
    rows = _contributions(spark, d).filter("contributor is not null")
    rows = cut(rows)
    at = rows.select(F.unix_micros("discovered_at").alias("t")).approxQuantile("t", list(shares), 0.01)
    state = caps.CapState(spark, limit)
    t, edges = F.coalesce(F.unix_micros("discovered_at"), F.lit((1 << 63) - 1)), [-(1 << 63), *map(int, at), (1 << 63) - 1]
    for low, high in zip(edges, edges[1:]):
        state.add(rows.filter((t > low) & (t <= high)).select("contributor", "id", "quality"))
    return state


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    state = _capped(spark, d)
    over = state.displaced().select("contributor").distinct()
    return state.kept().join(over, "contributor", "left_semi").select(F.col("contributor").alias("domain"), F.col("id").alias("doc_id"))


def displaced(spark: SparkSession, d: str) -> DataFrame:
    return _capped(spark, d).displaced()


# 6 -- new batches against all history


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = history.repeats(table(spark, d, "documents").select("doc_id", "discovered_at", "sha256", "text"), similarity=0.6)
    return pairs.select(F.least("doc_id", "partner").alias("doc_id_a"), F.greatest("doc_id", "partner").alias("doc_id_b"))


# 7 -- containers of 4,096 tokens


def _packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(tokens.token_sizes(table(spark, d, "documents"), ["doc_id"]), 4096)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d).filter("pieces > 1 and piece = 1").select("doc_id")


def containers(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d)


def container_report(spark: SparkSession, d: str) -> DataFrame:
    return packing.report(_packed(spark, d), 4096)


# 8 -- sources mixed to weights


def _mix(spark: SparkSession, d: str) -> mixing.Mix:
    return mixing.Mix(tokens.token_sizes(table(spark, d, "documents"), ["doc_id", "source"]), table(spark, d, "mix_targets"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d).short().select("source")


def mixture(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d).chosen()


def mixture_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d).shares()


# 9 -- subjects


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return subjects.assign(table(spark, d, "documents"), table(spark, d, "subject_labels"), table(spark, d, "subjects")).select("doc_id", "subject")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_varied_pages": varied_pages,
        "p1_coverage": varied_coverage,
        "p2_found": p2_found,
        "p2_sampled": sampled,
        "p2_report": sample_report,
        "p4_found": p4_found,
        "p5_found": p5_found,
        "p5_displaced": displaced,
        "p6_found": p6_found,
        "p7_found": p7_found,
        "p7_containers": containers,
        "p7_report": container_report,
        "p8_found": p8_found,
        "p8_mixture": mixture,
        "p8_shares": mixture_shares,
        "p9_found": p9_found,
    }


_KEY = r"regexp_replace(lower(regexp_replace({0}, '^[\s ]+|[\s ]+$', '', 'g')), '[\s _-]+', '_', 'g')"


def oracle_sql() -> dict[str, str]:
    source, own = _KEY.format("source"), _KEY.format("s.source")
    return {
        "p2_found": f"""
            with s as (select distinct source, name, target from slices where target is not null),
                 d as (select {source} as k, discovery_query as q from documents where status = 'stored'),
                 n as (select k, q, count(*) as n from d group by k, q)
            select s.source, s.name from s left join n on n.k = {own} and n.q = s.name
            where coalesce(n.n, 0) < s.target::double / (select sum(target) from s) * (select count(*) from d) / 5""",
        "p4_found": """
            with best as (
                select doc_id, page_no, n_complex_tables as a, max_table_cells as b,
                       row_number() over (partition by doc_id, page_no order by n_complex_tables desc, max_table_cells desc nulls last) as k
                from page_density where n_complex_tables is not null and doc_id is not null),
            placed as (select doc_id, page_no, row_number() over (partition by doc_id order by a desc, b desc nulls last, page_no nulls last) as place from best where k = 1)
            select doc_id, page_no from placed where place <= 3""",
        "p5_found": r"""
            with q as (select doc_id, max(n_complex_tables) as q from page_density group by doc_id),
            h as (select doc_id, lower(trim(coalesce(domain, regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)))) as h from documents where status = 'stored'),
            c as (select doc_id, nullif(regexp_replace(regexp_replace(h, ':[0-9]*$', ''), '^www\.|\.+$', '', 'g'), '') as domain from h),
            r as (select domain, doc_id, row_number() over (partition by domain order by coalesce(q, 0) desc, doc_id) as place, count(*) over (partition by domain) as n
                  from c left join q using (doc_id) where domain is not null)
            select domain, doc_id from r where n > 8 and place <= 8""",
    }
