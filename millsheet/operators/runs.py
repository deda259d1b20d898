"""What a run does around the fields: selection of documents, routing, reports with errors, metrics, expected values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millsheet.functions.pages import is_pdf_name
from millsheet.functions.rules import FIELDS
from millsheet.operators.score import scores

STAGES = ("preprocessing", "ocr", "extraction")
#: Messages of the failures that aren't those of a provider.
NO_SOURCE, NO_PAGE, NO_RESULT = "source file not found", "no page was read", "no extraction result"


def first_rows(rows: DataFrame, n: int | None, order: str) -> DataFrame:
    """The first ``n`` rows in the order of a column, such as the number of a row in its file; all if ``n`` is 0 or None."""
    return rows.orderBy(order).limit(n) if n else rows


def input_error(name: Column) -> Column:
    """Why a file isn't read, null if it is."""
    return F.when(~F.coalesce(is_pdf_name(name), F.lit(False)), F.concat(F.lit("only PDF files are read: "), F.coalesce(name, F.lit(""))))


def cleaner(modality: Column) -> Column:
    """What prepares the pages of a document: the full cleaning for scanned ones, gray scale for all others."""
    return F.when(F.lower(F.trim(F.coalesce(modality, F.lit("digital")))) == "scanned", "clean").otherwise("gray")


def text_reader(modality: Column) -> Column:
    """What reads the text of a document: its text layer if it is digital, the OCR engines if not."""
    return F.when(F.lower(F.trim(F.coalesce(modality, F.lit("digital")))) == "digital", "text_layer").otherwise("ocr")


def reports(documents: DataFrame) -> DataFrame:
    """The report of every document, as it stands in a run summary.

    ``documents``: document_name, source_path, the messages ``preprocessing``, ``ocr``, ``extraction`` and ``unknown`` (null
    where nothing failed), page_count, confidence, text_length and the five fields. The first stage that failed is the
    error; what comes after it didn't run. An unexpected failure is of no stage.
    """
    message = lambda s: F.col(s)
    stage = F.when(F.col("source_path").isNull(), "preprocessing").when(F.col("preprocessing").isNotNull(), "preprocessing")
    for s in ("unknown", "ocr", "extraction"):
        stage = stage.when(message(s).isNotNull(), s)
    text = F.when(F.col("source_path").isNull(), NO_SOURCE).otherwise(F.coalesce("preprocessing", "unknown", "ocr", "extraction"))
    d = documents.select("*", stage.alias("error_stage"), text.alias("error_message"))
    past = lambda *failed: ~F.coalesce(F.col("error_stage").isin("unknown", *failed), F.lit(False))
    read = past("preprocessing", "ocr")
    return d.select(
        "document_name", F.coalesce("source_path", F.lit("(not found)")).alias("source_path"), F.col("error_stage").isNull().alias("success"),
        past("preprocessing").alias("preprocessing_ok"), read.alias("ocr_ok"), past("preprocessing", "ocr", "extraction").alias("extraction_ok"),
        F.when(past("preprocessing"), F.col("page_count")).otherwise(0).cast("int").alias("page_count"), F.round(F.when(read, F.col("confidence")).otherwise(0.0), 2).alias("avg_ocr_confidence"), F.when(read, F.col("text_length")).otherwise(0).cast("int").alias("total_text_length"),
        *[F.when(F.col("error_stage").isNull(), F.col(f)).alias(f) for f in FIELDS], "error_stage", "error_message",
    )


def exit_status(reported: DataFrame) -> DataFrame:
    """0 if no document failed, else 2."""
    return reported.agg(F.when(F.count_if(~F.col("success")) == 0, 0).otherwise(2).alias("status"))


def summary_document(reported: DataFrame, timestamp: str) -> DataFrame:
    """The run summary as one nested row: totals and the report of every document.

    The list of documents makes this a report for runs of some thousands of documents; the totals alone are ``run_totals``.
    """
    doc = F.struct(
        "document_name", "source_path", "success", F.struct(*[F.col(f"{s}_ok").alias(s) for s in STAGES]).alias("stages"), F.struct("page_count", "avg_ocr_confidence", "total_text_length").alias("outputs"),
        F.when(F.col("extraction_ok"), F.struct(*FIELDS)).alias("extracted_entities"), F.when(F.col("error_stage").isNotNull(), F.struct(F.col("error_stage").alias("stage"), F.col("error_message").alias("message"))).alias("error"),
    )
    return run_totals(reported, F.array_sort(F.collect_list(doc)).alias("documents")).select(F.lit(timestamp).alias("timestamp"), "*")


def run_totals(reported: DataFrame, *more: Column) -> DataFrame:
    """Totals of a run: documents by outcome, failures by stage (unexpected ones are of none), mean confidence, pages."""
    failures = F.struct(*[F.count_if(F.coalesce(F.col("error_stage") == s, F.lit(False))).cast("int").alias(s) for s in STAGES]).alias("stage_failures")
    return reported.agg(
        F.count("*").cast("int").alias("total_documents"), F.count_if("success").cast("int").alias("successful"), F.count_if(~F.col("success")).cast("int").alias("failed"), failures,
        F.round(F.coalesce(F.avg(F.when(F.col("ocr_ok"), F.col("avg_ocr_confidence"))), F.lit(0.0)), 2).alias("avg_ocr_confidence"), F.coalesce(F.sum("page_count"), F.lit(0)).cast("int").alias("total_pages_processed"), *more,
    )


def metrics(outcomes: DataFrame) -> DataFrame:
    """section, name, measure, value of the scores of every field and of their unweighted means."""
    s = scores(outcomes)
    measures = ("precision", "recall", "f1", "tp", "fp", "fn")
    per = s.select(F.lit("per_entity").alias("section"), F.col("field").alias("name"), F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures])).alias("x"))
    mean = s.agg(*[F.avg(m).alias(m) for m in measures[:3]]).select(F.lit("macro").alias("section"), F.lit("macro").alias("name"), F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in measures[:3]])).alias("x"))
    return per.unionByName(mean).select("section", "name", "x.*")


def first_match(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Of the rows with one key the first in the order of a column, others don't count."""
    rest = [c for c in rows.columns if c != key]
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(order, *[c for c in rest if c != order])).alias("x")).select(key, "x.*")


def with_images(seeds: DataFrame, images: DataFrame) -> DataFrame:
    """The expected values with entries for images (filename, source_pdf): each takes the values of the first entry of its source."""
    values = first_match(seeds.select("seed_id", "filename", *FIELDS, "doc_type", "language"), "filename", "seed_id").withColumnRenamed("filename", "source_pdf")
    new = images.join(values, "source_pdf").select(*FIELDS, "doc_type", "filename", "language", F.lit("image").alias("variant"), "source_pdf")
    return seeds.select(*FIELDS, "doc_type", "filename", "language", "variant", F.lit(None).cast("string").alias("source_pdf")).unionByName(new)
