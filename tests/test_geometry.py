import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.functions import geometry as g


def shape(x0, y0, x1, y1, fill=None, lines=0, curves=0, diagonals=0):
    return {"x0": float(x0), "y0": float(y0), "x1": float(x1), "y1": float(y1), "fill": fill, "n_rects": 1, "n_lines": lines, "n_curves": curves, "n_diagonals": diagonals}


def word(x, y, w="12"):
    return {"x0": float(x), "y0": float(y), "x1": x + 8.0, "y1": y + 8.0, "word": w}


RED, BLUE = [1.0, 0.0, 0.0], [0.0, 0.0, 1.0]
LABELS = [word(100 + 20 * i, 310) for i in range(5)]
BARS = [shape(100 + 22 * i, 300 - h, 112 + 22 * i, 300, RED if i % 2 else BLUE) for i, h in enumerate([20, 60, 110, 40, 90, 150, 30, 70, 120])]
GRID = [shape(100 + 40 * c, 100 + 20 * r, 138 + 40 * c, 118 + 20 * r, RED) for r in range(5) for c in range(4)]
LINE = [shape(100, 100, 300, 250, None, lines=12, diagonals=10), *[shape(100, 110 + 12 * i, 300, 111 + 12 * i) for i in range(9)]]


@pytest.mark.parametrize("shapes,words,kinds", [(BARS, LABELS, ["bar"]), (BARS, [], []), (GRID, LABELS, []), (LINE, [word(100 + 20 * i, 255) for i in range(5)], ["line"]), (LINE, LABELS, []), ([], LABELS, []), (None, None, []), (BARS[:3], LABELS, [])])
def test_charts(spark, shapes, words, kinds):
    df = spark.createDataFrame([(1, 1, 600.0, 800.0, shapes, words)], f"doc_id long, page_no int, width double, height double, shapes {g.SHAPES}, words {g.WORDS}")
    assert [c["kind"] for c in g.page_charts(df).first()["charts"]] == kinds


def test_pie_and_parts():
    wedges = np.array([[100, 100, 150, 150], [150, 100, 200, 150], [100, 150, 150, 200], [150, 150, 200, 200]], float)
    assert g.has_hub(wedges) and not g.has_hub(wedges + np.arange(4)[:, None] * 90)
    assert g.bars(np.array([[0, 0, w, 5] for w in (10, 40, 70, 100)], float)) == "h"
    assert g.bars(np.array([[0, 0, 50, 5]] * 6, float)) is None
    assert g.is_white((1.0, 1.0, 0.98)) and g.is_white((0, 0, 0, 0.01)) and not g.is_white(None)


def test_clusters_follow_links():
    box = np.array([[0, 0, 10, 10], [100, 0, 110, 10], [20, 0, 30, 10], [40, 0, 50, 10]], float)
    label = g.clusters(box)
    assert label[0] == label[2] == label[3] != label[1] and not len(g.clusters(np.zeros((0, 4))))


def test_tables(spark):
    cells = [["a", "b", "1"], ["x", None, "2,5"], ["y", "", "(3)"], ["z", "4%", "5"]]
    read = F.from_json(F.lit(json.dumps(cells)), "array<array<string>>")
    fact = spark.range(1).select(g.cell_facts(read).alias("t")).select("t.*", g.is_real_table(F.col("t")).alias("real")).first()
    assert (fact["n_rows"], fact["n_cols"], fact["n_filled"], fact["real"]) == (4, 3, 10, True) and fact["numeric_ratio"] == 0.5
    t = lambda r, c, b, s: spark.range(1).select(F.struct(F.lit(r).alias("n_rows"), F.lit(c).alias("n_cols"), F.lit(b).alias("borderless"), F.lit(s).alias("spanned")).alias("t")).select(g.is_complex_table(F.col("t"))).first()[0]
    assert [t(10, 4, False, False), t(4, 6, False, False), t(4, 2, False, True), t(3, 2, False, True), t(8, 3, True, False), t(7, 3, True, False)] == [True, True, True, False, True, False]


def test_merging_of_tables(spark):
    box = lambda *x: F.struct(*(F.lit(float(v)).alias(n) for n, v in zip(("x0", "y0", "x1", "y1"), x)))
    out = spark.range(1).select(g.merge_tables(F.array(box(0, 0, 10, 10)), F.array(box(0, 0, 10, 9), box(50, 50, 60, 60), box(80, 80, 90, 90)), F.array(box(79, 79, 99, 99))).alias("t")).first()["t"]
    assert [(t["x0"], t["y1"]) for t in out] == [(0.0, 10.0), (50.0, 60.0)]
