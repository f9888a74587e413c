"""Facts, shapes and words of PDF pages, where PyMuPDF is installed (it isn't needed by anything else)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from leafmill.functions.geometry import SCAN_COVER, SHAPES, WORDS

# Characters that make a text layer.
TEXT_LAYER = 32
SCHEMA = f"doc_id long, status string, page_no int, width double, height double, rotation int, text_chars int, has_text_layer boolean, n_images int, n_drawings int, n_widgets int, covered_by_one_image boolean, image_share double, shapes {SHAPES}, words {WORDS}, error string"


def _segments(path: dict) -> dict:
    kinds = {"re": "n_rects", "l": "n_lines", "c": "n_curves", "qu": "n_curves"}
    out = dict.fromkeys(("n_rects", "n_lines", "n_curves", "n_diagonals"), 0)
    for kind, *points in path.get("items", ()):
        if kind in kinds:
            out[kinds[kind]] += 1
        if kind == "l":
            a, b = points[:2]
            out["n_diagonals"] += min(abs(a.x - b.x), abs(a.y - b.y)) > 1
    return out


def _page(page) -> dict:
    box, text = page.rect, page.get_text()
    area = abs(box.width * box.height) or 1.0
    images = page.get_image_info()
    covers = [abs((x["bbox"][2] - x["bbox"][0]) * (x["bbox"][3] - x["bbox"][1])) / area for x in images]
    drawn = [x for x in page.get_drawings() if x.get("rect") is not None]
    shapes = [{"x0": x["rect"].x0, "y0": x["rect"].y0, "x1": x["rect"].x1, "y1": x["rect"].y1, "fill": list(x["fill"]) if x.get("fill") else None} | _segments(x) for x in drawn]
    words = [dict(zip(("x0", "y0", "x1", "y1", "word"), w[:5])) for w in page.get_text("words")]
    n = len(text.strip())
    return {"width": box.width, "height": box.height, "rotation": page.rotation, "text_chars": n, "has_text_layer": n >= TEXT_LAYER, "n_images": len(images), "n_drawings": len(drawn), "n_widgets": sum(1 for _ in page.widgets()), "covered_by_one_image": len(covers) == 1 and covers[0] > SCAN_COVER, "image_share": max(covers, default=0.0), "shapes": shapes, "words": words}


def pages(documents: DataFrame) -> DataFrame:
    """(doc_id, content) to one row per page. A document that can't be opened gives one row with its status (encrypted, corrupt); a page
    that fails gives a row with its error, and the rest of the document is kept."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pymupdf

        for some in batches:
            for i, body in zip(some["doc_id"], some["content"]):
                rows = []
                try:
                    pdf = pymupdf.open(stream=body, filetype="pdf")
                    if pdf.needs_pass and not pdf.authenticate(""):
                        rows.append({"doc_id": i, "status": "encrypted"})
                    else:
                        for k in range(pdf.page_count):
                            try:
                                rows.append({"doc_id": i, "status": "ok", "page_no": k + 1} | _page(pdf[k]))
                            except Exception as e:  # noqa: BLE001 - whatever a broken page raises
                                rows.append({"doc_id": i, "status": "ok", "page_no": k + 1, "error": str(e)[:500]})
                except Exception as e:  # noqa: BLE001 - whatever a broken file raises
                    rows.append({"doc_id": i, "status": "corrupt", "error": str(e)[:500]})
                yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in ("doc_id", "status", "page_no", "width", "height", "rotation", "text_chars", "has_text_layer", "n_images", "n_drawings", "n_widgets", "covered_by_one_image", "image_share", "shapes", "words", "error")]).astype(object)

    return documents.select("doc_id", "content").mapInPandas(run, SCHEMA)
