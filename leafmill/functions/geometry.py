"""Charts and tables from the drawn shapes and cells of a page, as functions of plain arrays.

A page is given as arrays of shapes (boxes, fills, counts of path segments) and words, so everything after the extraction from the
PDF can run, and be tested, without one. :func:`page_charts` runs it over pages in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

# Thresholds of real and complex tables.
MIN_ROWS, MIN_COLS, MAX_MEAN_CHARS, MIN_NUMERIC = 4, 3, 28, 0.15
COMPLEX_CELLS, COMPLEX_COLS, COMPLEX_ROWS_BORDERLESS = 40, 6, 8
# Thresholds of charts (points, shares of an area, numbers of shapes).
GAP, HAIRLINE, BAND, MIN_SHAPES, MIN_AREA, MAX_AREA = 12.0, 3.0, 0.9, 8, 0.01, 0.75
LINE_SEGMENTS, DIAGONALS, LARGE, CURVES, CURVED_PATHS = 8, 4, 24.0, 4, 3
MIN_BARS, BAR_SPREAD, BAR_LENGTHS, MIN_MARKS, MIN_COLOURS, MARK_SHARE = 4, 0.25, 3, 6, 3, 0.1
LABEL_PAD, LABEL_CHARS, MIN_LABELS = 24.0, 8, 3
# When an image is the page, and when it is a figure on it.
SCAN_COVER, FIGURE_COVER, FEW_DRAWINGS = 0.80, 0.05, 8

SHAPES = "array<struct<x0:double,y0:double,x1:double,y1:double,fill:array<double>,n_rects:int,n_lines:int,n_curves:int,n_diagonals:int>>"
WORDS = "array<struct<x0:double,y0:double,x1:double,y1:double,word:string>>"


@dataclass
class Shapes:
    """Shapes of a page: boxes (n x 4), fills (tuple or None) and counts of lines, curves and diagonals."""

    box: np.ndarray
    fill: list
    lines: np.ndarray
    curves: np.ndarray
    diagonals: np.ndarray

    @classmethod
    def of(cls, rows: list[dict]) -> Shapes:
        number = lambda k: np.array([r.get(k) or 0 for r in rows], np.int64)
        box = np.array([[r["x0"], r["y0"], r["x1"], r["y1"]] for r in rows], float).reshape(-1, 4)
        return cls(box, [tuple(r["fill"]) if r.get("fill") else None for r in rows], number("n_lines"), number("n_curves"), number("n_diagonals"))

    def take(self, at: np.ndarray) -> Shapes:
        return Shapes(self.box[at], [self.fill[i] for i in at], self.lines[at], self.curves[at], self.diagonals[at])

    @property
    def size(self) -> np.ndarray:
        """Widths and heights."""
        return np.abs(self.box[:, 2:] - self.box[:, :2])

    @property
    def rule(self) -> np.ndarray:
        return (self.size < HAIRLINE).any(1)


def clusters(box: np.ndarray, gap: float = GAP) -> np.ndarray:
    """A number for each box, equal for boxes that are linked through boxes less than ``gap`` apart. Labels spread along the
    links until nothing changes."""
    n = len(box)
    if not n:
        return np.zeros(0, np.int64)
    near = ((box[:, None, :2] - gap <= box[None, :, 2:]) & (box[None, :, :2] - gap <= box[:, None, 2:])).all(2)
    label = np.arange(n)
    while True:
        new = np.where(near, label[None, :], n).min(1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def is_white(fill: tuple | None) -> bool:
    """Invisible on paper: all of RGB (or grey) near 1, all of CMYK near 0."""
    return bool(fill) and (min(fill) >= 0.97 if len(fill) <= 3 else max(fill) <= 0.03)


def is_grid(s: Shapes, tolerance: float = 2.0) -> bool:
    """Shapes that tile rows and columns: at least three extents repeated three times each way."""
    box = np.rint(s.box[~s.rule] / tolerance).astype(np.int64)
    repeated = lambda c: (np.unique(box[:, c], axis=0, return_counts=True)[1] >= 3).sum()
    return len(box) >= 8 and repeated([0, 2]) >= 3 and repeated([1, 3]) >= 3


def is_banding(s: Shapes) -> bool:
    """Many filled shapes of nearly one size: shaded cells."""
    size = s.size[[f is not None for f in s.fill] & ~s.rule]
    if len(size) < 8 or (size.mean(0) <= 0).any():
        return False
    return bool((size.std(0) / size.mean(0) < 0.25).all())


def marks(s: Shapes) -> np.ndarray:
    """Places of the shapes that could stand for a value: filled, not white, no rule, and not as wide or high as the region."""
    span = (s.box[:, 2:].max(0) - s.box[:, :2].min(0)) * BAND
    seen = np.array([f is not None and not is_white(f) for f in s.fill], bool)
    return np.flatnonzero(seen & ~s.rule & (s.size < span).all(1))


def has_hub(box: np.ndarray, tolerance: float = 2.5) -> bool:
    """Whether the corners of several shapes meet in a point that still more shapes cover: wedges of a pie."""
    if not len(box):
        return False
    corners = np.concatenate([box[:, [i, j]] for i in (0, 2) for j in (1, 3)])
    meet = (np.abs(corners[:, None] - corners[None]) <= tolerance).all(2).sum(1)
    cover = ((box[None, :, :2] - tolerance <= corners[:, None]) & (corners[:, None] <= box[None, :, 2:] + tolerance)).all(2).sum(1)
    return bool(((meet >= CURVED_PATHS) & (cover > CURVED_PATHS)).any())


def bars(box: np.ndarray, tolerance: float = 2.0) -> str | None:
    """"v" or "h" if enough boxes stand on one line (bottom or left) with lengths that differ clearly."""
    for name, edge, length in (("v", box[:, 3], box[:, 3] - box[:, 1]), ("h", box[:, 0], box[:, 2] - box[:, 0])):
        line = np.rint(edge / tolerance)
        for at in np.unique(line):
            own = length[line == at]
            spread = np.ptp(own) if len(own) else 0
            if len(own) >= MIN_BARS and spread > 2 * tolerance and spread >= BAR_SPREAD * own.max() and len(np.unique(np.rint(own / tolerance))) >= BAR_LENGTHS:
                return name
    return None


def charts(s: Shapes, words: np.ndarray, lengths: np.ndarray, width: float, height: float) -> list[dict]:
    """Regions of a page that behave like charts. words: boxes (n x 4), lengths: characters of each."""
    out = []
    label = clusters(s.box)
    for one in np.unique(label):
        g = s.take(np.flatnonzero(label == one))
        n = len(g.box)
        low, high = g.box[:, :2].min(0), g.box[:, 2:].max(0)
        area = float(np.prod(high - low) / (abs(width * height) or 1.0))
        if n < MIN_SHAPES or not MIN_AREA <= area <= MAX_AREA or g.rule.all() or is_grid(g) or is_banding(g):
            continue
        m = marks(g)
        colours = {g.fill[i] for i in m}
        long, short = g.size.max(1), g.size.min(1)
        line = bool(((g.lines >= LINE_SEGMENTS) & (g.diagonals >= DIAGONALS) & (long >= LARGE)).any())
        curved = (g.curves >= 1) & (short >= LARGE)
        curvy = (curved & (g.curves >= CURVES)).sum() >= CURVED_PATHS
        pie = curved.sum() >= CURVED_PATHS and has_hub(g.box[curved])
        bar = bars(g.box[m])
        colourful = len(m) >= max(MIN_MARKS, MARK_SHARE * n) and len(colours) >= MIN_COLOURS
        near = (words[:, 2:] > low - LABEL_PAD).all(1) & (words[:, :2] < high + LABEL_PAD).all(1) if len(words) else np.zeros(0, bool)
        labels = int((near & (lengths <= LABEL_CHARS)).sum())
        if labels < MIN_LABELS or not (line or curvy or pie or bar or colourful):
            continue
        kind = "pie" if pie else "bar" if bar else "line" if line or g.lines.sum() > g.curves.sum() else "mixed"
        out.append({"kind": kind, "n_primitives": n, "n_distinct_colors": len(colours), "area_frac": round(area, 4), "n_labels": labels, "x0": low[0], "y0": low[1], "x1": high[0], "y1": high[1]})
    return out


_CHARTS = "array<struct<kind:string,n_primitives:int,n_distinct_colors:int,area_frac:double,n_labels:int,x0:double,y0:double,x1:double,y1:double>>"


def page_charts(pages: DataFrame) -> DataFrame:
    """pages: doc_id, page_no, width, height, shapes, words -> doc_id, page_no, charts. Null shapes or words are none."""
    names = ["kind", "n_primitives", "n_distinct_colors", "area_frac", "n_labels", "x0", "y0", "x1", "y1"]
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), *[pa.float64()] * 4]
    item = pa.list_(pa.struct(list(zip(names, kinds))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for w, h, shapes, words in zip(*(b.column(c).to_pylist() for c in ("width", "height", "shapes", "words"))):
                box = np.array([[x["x0"], x["y0"], x["x1"], x["y1"]] for x in words or []], float).reshape(-1, 4)
                found.append(charts(Shapes.of(shapes or []), box, np.array([len(x["word"] or "") for x in words or []]), w or 0.0, h or 0.0))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("page_no"), pa.array(found, item)], names=["doc_id", "page_no", "charts"])

    return pages.mapInArrow(run, f"doc_id long, page_no int, charts {_CHARTS}")


# -- tables: expressions over a struct of facts, evaluated in the JVM


def cell_facts(cells: Column) -> Column:
    """Of an array of rows of cells: n_rows, n_cols, filled cells, share of numeric ones among them, their mean length."""
    from .text import is_numeric

    flat = F.filter(F.flatten(F.transform(cells, lambda r: F.transform(r, lambda c: F.trim(F.coalesce(c, F.lit("")))))), lambda c: c != "")
    n = F.size(flat)
    chars = F.aggregate(flat, F.lit(0), lambda a, c: a + F.length(c))
    return F.struct(
        F.size(cells).alias("n_rows"),
        F.coalesce(F.array_max(F.transform(cells, lambda r: F.size(r))), F.lit(0)).alias("n_cols"),
        n.alias("n_filled"),
        F.coalesce(F.try_divide(F.size(F.filter(flat, is_numeric)), n), F.lit(0.0)).alias("numeric_ratio"),
        F.coalesce(F.try_divide(chars, n), F.lit(0.0)).alias("mean_cell_chars"),
    )


def is_real_table(t: Column) -> Column:
    return (t.n_rows >= MIN_ROWS) & (t.n_cols >= MIN_COLS) & (t.mean_cell_chars <= MAX_MEAN_CHARS) & (t.numeric_ratio >= MIN_NUMERIC)


def is_complex_table(t: Column) -> Column:
    """Many cells, many columns, spanned cells in more than a small table, or a long table without rules."""
    spanned = t.spanned & ((t.n_rows >= MIN_ROWS) | (t.n_cols >= MIN_COLS))
    return (t.n_rows * t.n_cols >= COMPLEX_CELLS) | (t.n_cols >= COMPLEX_COLS) | spanned | (t.borderless & (t.n_rows >= COMPLEX_ROWS_BORDERLESS))


def is_ruled_table(t: Column) -> Column:
    """A table drawn with rules: at least two rows and columns, unless it is a small box of prose."""
    return (t.n_rows >= 2) & (t.n_cols >= 2) & ~((t.n_rows < MIN_ROWS) & (t.n_cols < MIN_COLS) & (t.mean_cell_chars > MAX_MEAN_CHARS))


def is_spanned(cells: Column, header: Column) -> Column:
    """Whether cells are merged: a missing cell (null), or a header that names some but not all of the columns."""
    named = F.size(F.filter(F.coalesce(header, F.array().cast("array<string>")), lambda x: F.trim(F.coalesce(x, F.lit(""))) != ""))
    widest = F.coalesce(F.array_max(F.transform(cells, lambda r: F.size(r))), F.lit(0))
    return F.exists(cells, lambda r: F.exists(r, lambda c: c.isNull())) | ((named > 0) & (named < widest))


def density_row(tables: Column, charts: Column) -> Column:
    """The measures of a page from its tables (n_rows, n_cols, complex, borderless, spanned) and charts (kind)."""
    n = lambda f: F.size(F.filter(tables, f))
    kinds = F.array_join(F.array_sort(F.array_distinct(F.transform(charts, lambda c: c.kind))), ",")
    return F.struct(
        F.size(tables).alias("n_tables"),
        n(lambda t: t.complex).alias("n_complex_tables"),
        n(lambda t: t.borderless).alias("n_borderless_tables"),
        n(lambda t: t.spanned).alias("n_spanned_tables"),
        F.coalesce(F.array_max(F.transform(tables, lambda t: t.n_rows * t.n_cols)), F.lit(0)).alias("max_table_cells"),
        F.size(charts).alias("n_charts"),
        F.nullif(kinds, F.lit("")).alias("chart_kinds"),
    )


def _inner(a: Column, b: Column) -> Column:
    side = lambda lo, hi: F.greatest(F.lit(0.0), F.least(a[hi], b[hi]) - F.greatest(a[lo], b[lo]))
    return side("x0", "x1") * side("y0", "y1")


def _area(a: Column) -> Column:
    return F.abs((a.x1 - a.x0) * (a.y1 - a.y0))


def overlap(a: Column, b: Column) -> Column:
    """Shared area of two boxes over their joint area; 0 without any."""
    return F.coalesce(F.try_divide(_inner(a, b), _area(a) + _area(b) - _inner(a, b)), F.lit(0.0))


def contained(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(_inner(a, b), _area(a)), F.lit(0.0))


def merge_tables(ruled: Column, aligned: Column, regions: Column) -> Column:
    """Ruled tables, and aligned ones that overlap none of these by more than half; without those lying in a chart."""
    free = F.filter(aligned, lambda t: ~F.exists(ruled, lambda r: overlap(t, r) > 0.5))
    return F.filter(F.concat(ruled, free), lambda t: ~F.exists(regions, lambda c: contained(t, c) > 0.75))


def covered_by_one_image(n_images: Column, share: Column) -> Column:
    return (n_images == 1) & (share > SCAN_COVER)


def raster_figure(share: Column) -> Column:
    """A picture on the page, not of it."""
    return (share >= FIGURE_COVER) & (share <= SCAN_COVER)


def is_rasterised(n_drawings: Column, n_images: Column, share: Column) -> Column:
    return ((n_drawings < FEW_DRAWINGS) & (share > SCAN_COVER)) | ((n_drawings == 0) & (n_images > 0))


@pandas_udf(DoubleType())
def ink_share(grey: pd.Series) -> pd.Series:
    """The share of pixels darker than 200 of a page drawn in grey (one byte a pixel); null for none."""
    return grey.map(lambda b: float((np.frombuffer(b, np.uint8) < 200).mean()) if b else None)
