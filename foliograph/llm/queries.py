"""The pN_ queries of the text operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language, leakage, neardup, pairs, scannoise, sql, textform, tokenizer, truncation
from .common import table


def _reader(spark: SparkSession, sf_dir: str):
    return scannoise.reader_of(table(spark, sf_dir, "ocr_output"), "prediction", "bbox", table(spark, sf_dir, "exercise"), "question")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scannoise.by_page(table(spark, sf_dir, "ocr_output"), "doc", "page_idx", "idx", "ocr_id", "prediction", "bbox", "ingested_at")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of scan noise in recognised lines and in questions."""
    reader = _reader(spark, sf_dir)
    q = scannoise.question_noise(table(spark, sf_dir, "exercise"), "exercise_id", "question", reader)
    o = scannoise.page_noise(_pages(spark, sf_dir), reader)
    return q.select(F.lit("exercise").alias("tbl"), "row_id", "kind").unionAll(o.select(F.lit("ocr_output"), "row_id", "kind"))


def p1_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions as continuous paragraphs."""
    return scannoise.repaired_questions(table(spark, sf_dir, "exercise"), "exercise_id", "question", _reader(spark, sf_dir))


def p1_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as continuous paragraphs."""
    return scannoise.repaired_pages(_pages(spark, sf_dir), _reader(spark, sf_dir))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with characters that look like plainer ones."""
    q = textform.odd_records(table(spark, sf_dir, "exercise"), "question", ["exercise_id"])
    o = textform.odd_records(table(spark, sf_dir, "ocr_output"), "prediction", ["ocr_id"])
    return q.select(F.lit("exercise").alias("tbl"), F.col("exercise_id").alias("row_id")).unionAll(o.select(F.lit("ocr_output"), F.col("ocr_id")))


def p2_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one consistent form of each text, and the same without regard to case; one row for each text of a record."""
    q = table(spark, sf_dir, "exercise").select(F.lit("exercise").alias("tbl"), F.col("exercise_id").alias("row_id"), F.col("question").alias("t"))
    o = table(spark, sf_dir, "ocr_output").select(F.lit("ocr_output").alias("tbl"), F.col("ocr_id").alias("row_id"), F.col("prediction").alias("t"))
    return q.unionAll(o).select("tbl", "row_id", textform.to_plain(F.col("t")).alias("form"), textform.to_folded(F.col("t")).alias("folded"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of different exercises whose questions are nearly the same."""
    found = neardup.pairs(table(spark, sf_dir, "exercise"), "exercise_id", "question")
    return found.select(F.col("a").alias("exercise_a"), F.col("b").alias("exercise_b"))


def p3_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of each exercise: smallest id with the same words, size, and number of near classes."""
    found = neardup.groups(table(spark, sf_dir, "exercise"), "exercise_id", "question")
    return found.select(F.col("id").alias("exercise_id"), F.col("class").alias("class_id"), F.col("size").alias("class_size"), "links")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defects of question and answer pairs; the language model is fitted on labelled documents."""
    model = language.fit(table(spark, sf_dir, "documents"), "text", "lang", "doc_id")
    return pairs.defects(table(spark, sf_dir, "exercise"), "exercise_id", "question", "answer", "source", model)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exercises whose answer was cut."""
    return truncation.found(table(spark, sf_dir, "exercise"), "exercise_id", "answer", "source")


def p5_source_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each source's answers are cut."""
    return truncation.shares(table(spark, sf_dir, "exercise"), "exercise_id", "answer", "source")


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    return tokenizer.encode_table(table(spark, sf_dir, "documents"), "doc_id", "text")


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaks(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_item"), "item_id", ["question", "answer"])


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with passages of test items."""
    return _leaks(spark, sf_dir).select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"))


def p7_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest match of each document and item, with its places in both."""
    return _leaks(spark, sf_dir).withColumnsRenamed({"doc": "doc_id", "item": "item_id"})


def p7_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that remain without leaks."""
    return leakage.without_leaks(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", _leaks(spark, sf_dir))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a missing or wrong language label or with several languages."""
    return language.mislabelled(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")


def p8_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language of each document, with its share of the words, the confidence, and whether the label is right."""
    return language.document_languages(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")


def p8_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each segment with words, with a confidence."""
    return language.segment_languages(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")


def queries() -> dict:
    return {name: fn for name, fn in globals().items() if name[0] == "p" and name[1:2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return sql.oracle_sql()
