"""Annotation projects and detector candidates."""

from __future__ import annotations

from functools import cmp_to_key

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import space_out

# Keys of regions that hold no text.
NO_TEXT = ["page", "logo", "profile_image", "qr_code", "van_tay"]
PROJECT = (
    "_via_settings struct<project:struct<name:string>>, _via_img_metadata map<string,struct<filename:string,regions:array<struct<"
    "shape_attributes:struct<name:string,all_points_x:array<int>,all_points_y:array<int>,x:int,y:int,width:int,height:int>,region_attributes:struct<text:string,key:string,orientation:string>>>>>"
)


def regions(projects: DataFrame) -> DataFrame:
    """One row for each text region of parsed projects: file, region number (counted before filtering), text, target and polygon."""
    images = projects.select(F.col("_via_settings.project.name").alias("project"), F.explode(F.map_values("_via_img_metadata")).alias("img"))
    r = images.select("project", F.col("img.filename").alias("file"), F.posexplode("img.regions").alias("region", "r"))
    shape, attr = F.col("r.shape_attributes"), F.col("r.region_attributes")
    zipped = F.zip_with(shape["all_points_x"], shape["all_points_y"], lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    points = F.slice(zipped, F.lit(1), F.least(F.size(shape["all_points_x"]), F.size(shape["all_points_y"])))
    x, y, w, h = (shape[c] for c in ("x", "y", "width", "height"))
    rect = F.array(*[F.struct(a.alias("x"), b.alias("y")) for a, b in ((x, y), (x + w, y), (x + w, y + h), (x, y + h))])
    poly = F.when(shape["name"] == "polygon", points).when(shape["name"] == "rect", rect)
    kept = r.where(~F.coalesce(attr["key"].isin(NO_TEXT), F.lit(False)) & ~F.coalesce(F.trim(attr["text"]) == "", F.lit(False)))
    out = kept.select("project", "file", "region", attr["text"].alias("text"), space_out(attr["text"]).alias("target"), poly.alias("polygon"))
    return out.where("polygon is not null").withColumn("image", F.concat(F.col("file"), F.lit("_"), F.col("region"), F.lit(".png")))


def candidates(df: DataFrame, no: str, short: Column, score: Column, grown: Column, first: int = 1000, box: float = 0.4) -> DataFrame:
    """Detected contours that become lines: of the first ``first``, wide enough, sure enough, wide enough when grown."""
    return df.where(F.col(no) < first).where((short >= 3) & (score >= box) & (grown >= 5))


def compare_boxes(a: tuple, b: tuple, tolerance: int = 7) -> int:
    """Reading order of two boxes (x1, y1, x2, y2): -1 if ``a`` comes first, 1 if ``b`` does.

    One box is below the other if it begins (but for the tolerance) where the
    other ends, or if neither's middle is within the other's height; then
    columns decide in the same way by the edges; boxes that overlap both ways
    are in one column, and go by their tops, if their relative overlap in width
    exceeds that in height, and else ``a`` comes first.  No total order.
    """
    middle_a, middle_b = (a[1] + a[3]) / 2, (b[1] + b[3]) / 2
    below = lambda p, q, mp, mq: p[1] > q[3] - tolerance or (mp > q[3] and mq < p[1])
    above = lambda p, q, mp, mq: p[3] < q[1] + tolerance or (mp < q[1] and mq > p[3])
    if below(a, b, middle_a, middle_b):
        return 1
    if above(a, b, middle_a, middle_b):
        return -1
    if a[0] > b[2] - tolerance:
        return 1
    if a[2] < b[0] + tolerance:
        return -1
    wide = min(a[2], b[2]) - max(a[0], b[0])
    high = min(a[3], b[3]) - max(a[1], b[1])
    if wide * min(a[3] - a[1], b[3] - b[1]) > min(a[2] - a[0], b[2] - b[0]) * high:
        return -1 if a[1] < b[1] else 1
    return -1


def reading_order(lines: DataFrame) -> DataFrame:
    """doc, page_idx, ocr_id and ``position`` of each line of a page by the comparator (not a total order, so rows come in a fixed one)."""

    def page(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = sorted(pdf.itertuples(index=False), key=lambda r: (r.y1, r.x1, r.ocr_id))
        rows = sorted(rows, key=cmp_to_key(lambda a, b: compare_boxes((a.x1, a.y1, a.x2, a.y2), (b.x1, b.y1, b.x2, b.y2))))
        return pd.DataFrame({"doc": [r.doc for r in rows], "page_idx": [r.page_idx for r in rows], "ocr_id": [r.ocr_id for r in rows], "position": range(len(rows))})

    flat = lines.select("doc", "page_idx", "ocr_id", "bbox.*")
    return flat.groupBy("doc", "page_idx").applyInPandas(page, "doc string, page_idx int, ocr_id long, position int")
