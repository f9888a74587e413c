"""Roll-ups of page measurements. What couldn't be measured never votes, and what wasn't measured isn't "sparse"."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions.names import source_key


def once(pages: DataFrame, columns: list[str]) -> DataFrame:
    """Each page (doc_id, page_no) once, in its delivery of the smallest id. Pages are fine enough keys not to be skewed, and are combined before the shuffle."""
    return pages.select("doc_id", "page_no", "id", *columns).groupBy("doc_id", "page_no").agg(F.min_by(F.struct(*columns), "id").alias("x")).select("doc_id", "page_no", "x.*")


def page_rollup(pages: DataFrame) -> DataFrame:
    """Per document the pages that are scans, forms and rotated, whatever number of times they were delivered; a null flag isn't counted."""
    n = lambda c: F.count_if(F.expr(c))
    return once(pages, ["has_text_layer", "covered_by_one_image", "n_widgets", "rotation", "text_angle"]).groupBy("doc_id").agg(n("not has_text_layer or covered_by_one_image").alias("scanned"), n("n_widgets > 0").alias("forms"), n("rotation <> 0 or (text_angle is not null and text_angle <> 0)").alias("rotated"))


def document_density(density: DataFrame, least: float = 0.33) -> DataFrame:
    """Per document its measured, opaque and dense pages. Of a page that was measured more than once every flag counts that was set once, and the largest numbers. The share of dense pages is over judged pages only; a document is
    dense from ``least`` on, on the unrounded share; one without a judged page is undecided, hence not dense."""
    measurable = F.expr("coalesce(table_measurable, false) or coalesce(chart_measurable, false)")
    dense = F.expr("coalesce(is_table_page, false) or coalesce(is_chart_page, false)")
    n = lambda c: F.count_if(F.expr(c) if isinstance(c, str) else c)
    flags = ["table_measurable", "chart_measurable", "is_table_page", "is_chart_page", "possible_raster_figure"]
    pages = density.groupBy("doc_id", "page_no").agg(*(F.bool_or(c).alias(c) for c in flags), *(F.max(c).alias(c) for c in ("max_table_cells", "n_borderless_tables")))
    out = pages.groupBy("doc_id").agg(
        F.count("*").alias("pages_measured"),
        n(~measurable).alias("pages_opaque"),
        n("is_table_page").alias("table_pages"),
        n("is_chart_page").alias("chart_pages"),
        n("not coalesce(chart_measurable, false)").alias("chart_blind_pages"),
        n(measurable & dense).alias("dense_pages"),
        n("possible_raster_figure").alias("raster_figure_pages"),
        F.coalesce(F.max("max_table_cells"), F.lit(0)).alias("max_table_cells"),
        n("n_borderless_tables > 0").alias("borderless_pages"),
    )
    share = F.coalesce(F.try_divide("dense_pages", F.col("pages_measured") - F.col("pages_opaque")), F.lit(0.0))
    return out.withColumn("dense_share", share).withColumn("is_dense_doc", (F.col("pages_measured") > F.col("pages_opaque")) & (F.col("dense_share") >= least))


def yield_by(docs: DataFrame, density: DataFrame, key: str) -> DataFrame:
    x = docs.join(density.withColumn("seen", F.lit(True)), "doc_id", "left")
    n = lambda c: F.count_if(F.expr(c))
    return x.groupBy(key).agg(F.count("*").alias("docs"), n("seen").alias("measured"), n("is_dense_doc").alias("dense_docs"), n("pages_measured = pages_opaque").alias("opaque_docs"), n("seen is null").alias("unmeasured"), F.sum("table_pages").alias("table_pages"), F.sum("chart_pages").alias("chart_pages"), F.sum("borderless_pages").alias("borderless_pages"))


def progress(docs: DataFrame, density: DataFrame) -> DataFrame:
    """Per source: stored, measured, dense and opaque documents; a source without stored documents stays, with zeros."""
    x = docs.select("doc_id", "status", source_key(F.col("source")).alias("source")).join(density.withColumn("seen", F.lit(True)), "doc_id", "left")
    n = lambda c: F.count_if(F.expr(f"status = 'stored' and {c}"))
    return x.groupBy("source").agg(n("true").alias("stored"), n("seen").alias("measured"), n("is_dense_doc").alias("dense"), n("pages_measured = pages_opaque").alias("opaque_docs"))


def cascade(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """The rows of child whose parent exists."""
    return child.join(parent.select(key), key, "left_semi")
