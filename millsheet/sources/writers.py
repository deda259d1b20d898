"""Sinks: JSON and text per document, run summaries, metrics and files parted by use."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millsheet.functions.pages import stem
from millsheet.functions.rules import FIELDS
from millsheet.functions.text import one_decimal


def page_text(pages: DataFrame) -> DataFrame:
    """document_name and the readable text of its pages (document_name, page_number, page_file, engine, avg_confidence, full_text, words)."""
    head = F.concat(F.lit("Page "), "page_number", F.lit(": "), "page_file", F.lit("\nEngine: "), "engine", F.lit("\nConfidence: "), one_decimal(F.col("avg_confidence")), F.lit("%\nWords: "), F.coalesce(F.size("words"), F.lit(0)))
    page = F.concat(F.lit("=" * 80 + "\n"), head, F.lit("\n" + "-" * 80 + "\n"), F.coalesce("full_text", F.lit("")), F.lit("\n\n"))
    p = pages.groupBy("document_name").agg(F.array_sort(F.collect_list(F.struct("page_number", page.alias("t")))).alias("p"))
    return p.select("document_name", F.concat(F.lit("# OCR Results: "), "document_name", F.lit("\n# Total pages: "), F.size("p"), F.lit("\n\n"), F.array_join(F.transform("p", lambda x: x["t"]), "")).alias("value"))


def page_documents(pages: DataFrame) -> DataFrame:
    """One nested row per document, as the page reader takes it; confidences with two decimals."""
    word = F.transform("words", lambda w: F.struct(w["text"].alias("text"), F.bround(w["confidence"], 2).alias("confidence"), w["bbox"].alias("bbox")))
    page = F.struct("page_number", "page_file", "engine", F.bround("avg_confidence", 2).alias("avg_confidence"), "full_text", F.coalesce(F.size("words"), F.lit(0)).alias("word_count"), word.alias("words"))
    d = pages.groupBy("document_name").agg(F.array_sort(F.collect_list(F.struct("page_number", page.alias("page")))).alias("p"))
    return d.select("document_name", F.size("p").alias("total_pages"), F.transform("p", lambda x: x["page"]).alias("pages"))


def extraction_documents(fields: DataFrame, candidates: DataFrame) -> DataFrame:
    """One nested row per document: all five fields (null allowed), its candidates in order, and the notes."""
    c = F.struct("ord", "field", "value", F.bround("confidence", 3).alias("confidence"), "source", F.substring("raw_text", 1, 100).alias("raw_text"))
    rank = F.array_position(F.array(*[F.lit(f) for f in ("project_id", "supplier", "material", "quantity", "date")]), F.col("field"))
    lists = candidates.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct(rank.alias("r"), c.alias("c")))).alias("cs"))
    return fields.join(lists, "doc", "left").select(
        F.col("doc").alias("document_name"), F.struct("project_id", "supplier", "material", "quantity", "date").alias("extracted_entities"),
        F.coalesce(F.transform("cs", lambda x: x["c"].dropFields("ord")), F.array().cast("array<struct<field:string,value:string,confidence:double,source:string,raw_text:string>>")).alias("all_candidates"), "notes",
    )


def page_file(document: Column, number: Column) -> Column:
    """The name of a page's image file."""
    return F.format_string("%s_p%02d.png", stem(document), number)


def write_page_files(pages: DataFrame, folder: str) -> None:
    """Images (document_name, page_number, content) as files of a folder that all executors share; what is there is written again."""

    def write(rows) -> None:  # noqa: ANN001
        for r in rows:
            with open(os.path.join(folder, r.file), "wb") as f:
                f.write(r.content)

    os.makedirs(folder, exist_ok=True)
    pages.where("content is not null").select(page_file(F.col("document_name"), F.col("page_number")).alias("file"), "content").foreachPartition(write)


def metrics_document(measured: DataFrame, per_doc: DataFrame) -> DataFrame:
    """One nested row: ``per_entity`` and ``macro`` by measure, and the outcomes of every document (a report of some thousands of documents)."""
    rows = measured.select("section", "name", "measure", "value").unionByName(per_doc.select(F.struct(*per_doc.columns).alias("doc")), allowMissingColumns=True)
    values = lambda section, name: F.map_from_entries(F.transform(F.filter("m", lambda x: (x["section"] == section) & (x["name"] == name)), lambda x: F.struct(x["measure"], x["value"])))
    held = rows.agg(F.collect_list(F.when(F.col("measure").isNotNull(), F.struct("section", "name", "measure", "value"))).alias("m"), F.array_sort(F.collect_list("doc")).alias("per_doc"))
    return held.select(F.struct(*[values("per_entity", f).alias(f) for f in FIELDS]).alias("per_entity"), values("macro", "macro").alias("macro"), "per_doc")


def write_json(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines that keep null fields."""
    rows.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_by_use(files: DataFrame, used: DataFrame, path: str) -> None:
    """Parts files (file, ...) into ``used`` and ``extra`` by whether ``used`` (file) names them; files already written aren't written again."""
    spark = files.sparkSession
    mark = used.select("file").distinct().withColumn("use", F.lit("used"))
    rows = files.join(mark, "file", "left").withColumn("use", F.coalesce("use", F.lit("extra")))
    try:
        rows = rows.join(spark.read.parquet(path).select("file"), "file", "left_anti")
    except Exception as e:  # the first write finds no folder
        if "PATH_NOT_FOUND" not in str(e):
            raise
    rows.write.mode("append").partitionBy("use").parquet(path)
