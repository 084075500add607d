"""Pages to exercises: slices, markers, bands, context bands, records.

All windows share the partitioning (doc, page), so that one exchange serves
them; a document of any size is many pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import MARKERS, is_marker

PAGE_H = 1754
#: Space kept above a band's marker and below the next one.
ABOVE, BELOW = 10, 5


def latest(df: DataFrame, key: str, order: str, within: tuple[str, ...] = ()) -> DataFrame:
    """One row for each key: the last delivered.

    One exchange, by ``within`` (columns that the key decides: a record stays
    in its group) or else by the key.  Operators that group by ``within``
    afterwards need no other one.  Project and reduce columns before the call:
    what isn't selected is neither read nor moved.
    """
    spread = df.repartition(*within) if within else df
    first = F.row_number().over(Window.partitionBy(*within, key).orderBy(F.desc_nulls_last(order)))
    return spread.withColumn("__r", first).where("__r = 1").drop("__r")


def latest_markers(lines: DataFrame, prefixes: list[str] = MARKERS) -> DataFrame:
    """doc, page_idx, idx, y of the marker lines among the last deliveries; texts are reduced to a flag before the exchange."""
    hit = F.coalesce(is_marker(F.col("prediction"), prefixes), F.lit(False))
    flags = lines.select("ocr_id", "doc", "page_idx", "idx", F.col("bbox.y1").alias("y"), hit.alias("hit"), "ingested_at")
    return latest(flags, "ocr_id", "ingested_at", ("doc", "page_idx")).where("hit").select("doc", "page_idx", "idx", "y")


def page_slice(pages: DataFrame, jobs: DataFrame) -> DataFrame:
    """Pages each job asks for, numbers kept.

    ``pages``: doc, page_idx; ``jobs``: job_id, doc, start_page, end_page.
    Slices as in Python: a null end means all, negative ends count from the back.
    """
    n = pages.groupBy("doc").agg((F.max("page_idx") + 1).alias("n"))
    eff = lambda c, dflt: F.when(c.isNull(), dflt).when(c < 0, F.greatest(F.col("n") + c, F.lit(0))).otherwise(F.least(c, F.col("n")))
    want = jobs.join(n, "doc").select("job_id", "doc", eff(F.col("start_page"), F.lit(0)).alias("a"), eff(F.col("end_page"), F.col("n")).alias("b"))
    return want.join(pages, "doc").where("page_idx >= a and page_idx < b").select("job_id", "doc", "page_idx")


def markers(lines: DataFrame, prefixes: list[str] = MARKERS) -> DataFrame:
    """doc, page_idx, idx, y of lines that begin an exercise."""
    return lines.where(is_marker(F.col("prediction"), prefixes)).select("doc", "page_idx", "idx", F.col("bbox.y1").alias("y"))


def _page() -> Window:
    return Window.partitionBy("doc", "page_idx").orderBy("y", "idx")


def bands(m: DataFrame, include_last: bool = False, height: int = PAGE_H) -> DataFrame:
    """doc, page_idx, ex_idx, y_from, y_to between each marker and the next; the last marker only closes a band unless ``include_last``."""
    w = _page()
    b = m.select("doc", "page_idx", "y", (F.row_number().over(w) - 1).alias("ex_idx"), F.lead("y").over(w).alias("next"))
    b = b if include_last else b.where("next is not null")
    to = F.coalesce(F.least(F.col("next") + BELOW, F.lit(height)), F.lit(height))
    return b.select("doc", "page_idx", "ex_idx", F.greatest(F.col("y") - ABOVE, F.lit(0)).alias("y_from"), to.alias("y_to"))


def draw(*key: Column) -> Column:
    """A number in [0, 1) that depends on the key alone."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *key)), 1, 8), 16, 10).cast("double") / 4294967296.0


def context_bands(m: DataFrame, height: int = PAGE_H) -> DataFrame:
    """doc, page_idx, ex_idx, y_from, y_to with a neighbour before, after or on both sides, drawn for each exercise."""
    w = _page()
    b = m.select("doc", "page_idx", "y", (F.row_number().over(w) - 1).alias("ex_idx"), F.lag("y").over(w).alias("prev"), F.lead("y").over(w).alias("next"), F.lead("y", 2).over(w).alias("next2"))
    b = b.where("next is not null").withColumn("p", draw(F.col("doc"), F.col("page_idx"), F.col("ex_idx")))
    far = F.coalesce("next2", F.lit(height))
    first = F.col("ex_idx") == 0
    y_from = F.when(first, F.col("y")).when(F.col("p") < 0.33, F.col("prev")).when(F.col("p") < 0.66, F.col("y")).otherwise(F.col("prev"))
    y_to = F.when(first, far).when(F.col("p") < 0.33, F.col("next")).otherwise(far)
    return b.select("doc", "page_idx", "ex_idx", y_from.alias("y_from"), y_to.alias("y_to"))


def band_text(lines: DataFrame, prefixes: list[str] = MARKERS) -> DataFrame:
    """doc, page_idx, ex_idx, n_lines, text of each band: lines from a marker up to the next, in order."""
    w = Window.partitionBy("doc", "page_idx").orderBy("idx")
    hit = F.coalesce(is_marker(F.col("prediction"), prefixes), F.lit(False)).cast("int")
    x = lines.select("doc", "page_idx", "idx", "prediction", hit.alias("hit")).withColumn("no", F.sum("hit").over(w))
    x = x.withColumn("all", F.max("no").over(Window.partitionBy("doc", "page_idx"))).where("no >= 1 and no < all")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", F.coalesce("prediction", F.lit("")).alias("t")))), lambda s: s["t"]), "\n")
    return x.groupBy("doc", "page_idx", (F.col("no") - 1).cast("int").alias("ex_idx")).agg(F.count(F.lit(1)).alias("n_lines"), joined.alias("text"))


def image_path(doc: Column, page: Column, ex: Column, variant: Column) -> Column:
    """Where a crop lies; the context variant has its own name."""
    name = F.when(variant == "context", F.lit("padding_exercise_image_")).otherwise(F.lit("exercise_image_"))
    return F.concat(F.lit("data/"), doc, F.lit("/output_image/page_"), page, F.lit("/"), name, ex, F.lit(".png"))


def records(tight: DataFrame, context: DataFrame) -> DataFrame:
    """Two records for each exercise: the tight band and the context band, with the paths of their pictures."""
    both = tight.withColumn("variant", F.lit("tight")).unionByName(context.withColumn("variant", F.lit("context")))
    return both.withColumn("image", image_path(F.col("doc"), F.col("page_idx"), F.col("ex_idx"), F.col("variant")))


def variants(df: DataFrame) -> DataFrame:
    """Each row twice, as tight and as context."""
    return df.select("*", F.explode(F.array(F.lit("tight"), F.lit("context"))).alias("variant"))


def small_lines(lines: DataFrame) -> DataFrame:
    """Lines of a page at least a third as high as its third highest; pages of up to three lines whole."""
    w = Window.partitionBy("doc", "page_idx")
    h = F.col("bbox.y2") - F.col("bbox.y1")
    x = lines.withColumn("h", h).withColumn("n", F.count(F.lit(1)).over(w)).withColumn("r", F.row_number().over(w.orderBy(F.desc("h"), "idx")))
    x = x.withColumn("m3", F.max(F.when(F.col("r") == 3, F.col("h"))).over(w))
    return x.where("n <= 3 or h * 3 >= m3").drop("n", "r", "m3")
