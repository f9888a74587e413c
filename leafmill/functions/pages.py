"""Predicates and scores of pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Filters of the page index, by name. A null flag counts as not set.
FILTERS = {
    "scanned": "(not coalesce(has_text_layer, true) or coalesce(covered_by_one_image, false))",
    "form": "coalesce(n_widgets, 0) > 0",
    "table": "coalesce(is_table_page, false)",
    "chart": "coalesce(is_chart_page, false)",
    "rotated": "(coalesce(rotation, 0) <> 0 or coalesce(text_angle, 0) <> 0)",
    "borderless": "coalesce(n_borderless_tables, 0) > 0",
}


def page_filter(names: list[str]) -> Column:
    """All named filters together; unknown names are ignored, no name keeps every page."""
    return reduce(lambda a, b: a & b, [F.expr(FILTERS[n]) for n in names if n in FILTERS], F.lit(True))


def even_pages(n_pages: Column, most: int) -> Column:
    """At most ``most`` page numbers (from 1), spread evenly over the closed range from page 2 (1 up to four pages) to the last; all
    pages if there are no more than ``most``. Halves are rounded to even. Null or no pages give an empty list."""
    n = F.coalesce(n_pages, F.lit(0))
    start = F.when(n > 4, 2).otherwise(1)
    at = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: (start + F.bround(i * (n - start) / F.lit(max(most - 1, 1)), 0)).cast("int"))
    spread = F.array_sort(F.array_distinct(at)) if most > 1 else F.array(start)
    return F.when(n <= 0, F.array().cast("array<int>")).when(n <= most, F.sequence(F.lit(1), F.greatest(n, F.lit(1)))).otherwise(spread)


def table_score(complex_: Column, borderless: Column, spanned: Column, cells: Column, width: Column, height: Column) -> Column:
    """Two points a complex, borderless or spanned table, up to three for cells, one for a landscape page."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    landscape = F.coalesce(width, F.lit(0)) > F.coalesce(height, F.lit(1))
    return 2 * zero(complex_) + 2 * zero(borderless) + 2 * zero(spanned) + F.least(zero(cells) / F.lit(100.0), F.lit(3.0)) + F.when(landscape, 1).otherwise(0)
