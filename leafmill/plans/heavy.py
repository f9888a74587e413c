"""Totals per document of the two page tables, where a few documents hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.operators.skew import first_delivery, heavy_keys, tree_aggregate
from leafmill.storage import table


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    found = [heavy_keys(table(spark, d, t).select("doc_id"), "doc_id", 0.03).select(F.lit(t).alias("table_name"), "doc_id") for t in ("pages", "page_density")]
    return found[0].unionByName(found[1])


def p3_page_totals(spark: SparkSession, d: str) -> DataFrame:
    """Per document: rows delivered, different pages, and totals over the pages, each in its delivery of the smallest id."""
    pages = table(spark, d, "pages").select("doc_id", "page_no", "id", "text_chars", "has_text_layer", "n_images", "n_drawings", "n_widgets")
    once = first_delivery(pages, ["doc_id", "page_no"], ["id"])
    count = lambda c: ("sum", F.when(c, 1).otherwise(0).cast("long"))
    return tree_aggregate(
        once,
        ["doc_id"],
        {"rows_delivered": ("sum", F.col("deliveries")), "n_pages": ("count", F.lit(1)), "text_chars": ("sum", F.col("text_chars").cast("long")), "text_layer_pages": count(F.col("has_text_layer")), "form_pages": count(F.col("n_widgets") > 0), "n_images": ("sum", F.col("n_images").cast("long")), "n_drawings": ("sum", F.col("n_drawings").cast("long")), "last_page": ("max", F.col("page_no"))},
    )


def p3_density_totals(spark: SparkSession, d: str) -> DataFrame:
    """Per document: measurements delivered and, over the pages in their best measurement, totals; failed ones are counted apart."""
    rows = table(spark, d, "page_density").groupBy("doc_id", "page_no").agg(F.count("*").alias("deliveries"), F.max("n_tables").alias("n_tables"), F.max("n_complex_tables").alias("n_complex_tables"), F.max("n_charts").alias("n_charts"), F.max("max_table_cells").alias("max_table_cells"))
    total = lambda c: ("sum", F.col(c).cast("long"))
    return tree_aggregate(rows, ["doc_id"], {"rows_delivered": total("deliveries"), "pages_seen": ("count", F.lit(1)), "pages_measured": ("count", F.col("n_tables")), "n_tables": total("n_tables"), "n_complex_tables": total("n_complex_tables"), "n_charts": total("n_charts"), "max_table_cells": ("max", F.col("max_table_cells"))})


QUERIES = {"p3_found": p3_found, "p3_page_totals": p3_page_totals, "p3_density_totals": p3_density_totals}

SQL = {
    "p3_found": """
        select 'pages' as table_name, doc_id from pages where doc_id is not null group by doc_id having count(*) >= 0.03 * (select count(*) from pages)
        union all
        select 'page_density', doc_id from page_density where doc_id is not null group by doc_id having count(*) >= 0.03 * (select count(*) from page_density)""",
    "p3_page_totals": """
        with r as (select *, row_number() over (partition by doc_id, page_no order by id, text_chars nulls first, has_text_layer nulls first, n_images nulls first, n_drawings nulls first, n_widgets nulls first) as k,
                          count(*) over (partition by doc_id, page_no) as deliveries from pages)
        select doc_id, sum(deliveries)::bigint as rows_delivered, count(*) as n_pages, sum(text_chars)::bigint as text_chars, count(*) filter (has_text_layer) as text_layer_pages,
               count(*) filter (n_widgets > 0) as form_pages, sum(n_images)::bigint as n_images, sum(n_drawings)::bigint as n_drawings, max(page_no) as last_page
        from r where k = 1 group by doc_id""",
    "p3_density_totals": """
        with r as (select doc_id, page_no, count(*) as deliveries, max(n_tables) as n_tables, max(n_complex_tables) as n_complex_tables, max(n_charts) as n_charts, max(max_table_cells) as max_table_cells
                   from page_density group by doc_id, page_no)
        select doc_id, sum(deliveries)::bigint as rows_delivered, count(*) as pages_seen, count(n_tables) as pages_measured, sum(n_tables)::bigint as n_tables,
               sum(n_complex_tables)::bigint as n_complex_tables, sum(n_charts)::bigint as n_charts, max(max_table_cells) as max_table_cells
        from r group by doc_id""",
}
