"""Scans: label tables, page documents, extraction results, run summaries, and listings of files.

Every reader has a fixed schema; nothing is inferred. Malformed rows give nulls, not failures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millsheet.functions.pages import page_document, stem

LABELS = "document_name string, doc_type string, language string, modality string, source string, project_id string, supplier string, material string, quantity string, date string, notes string"
WORDS = "array<struct<text: string, confidence: double, bbox: array<int>>>"
PAGES = f"document_name string, total_pages int, pages array<struct<page_number: int, page_file: string, engine: string, avg_confidence: double, full_text: string, word_count: int, words: {WORDS}>>"
EXTRACTION = (
    "document_name string, extracted_entities struct<project_id: string, supplier: string, material: string, quantity: string, date: string>, "
    "all_candidates array<struct<field: string, value: string, confidence: double, source: string, raw_text: string>>, notes array<string>"
)
SEEDS = "project_id string, supplier string, material string, quantity string, date string, doc_type string, filename string, language string, variant string, path string, source_pdf string"


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """A label table as CSV with a header and quoted commas; empty cells are empty strings, the rows keep their number."""
    rows = spark.read.schema(LABELS).option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).csv(path)
    return rows.na.fill("").withColumn("row_no", F.monotonically_increasing_id())


def read_page_documents(spark: SparkSession, path: str) -> DataFrame:
    """One JSON file per document, to one row per page."""
    d = spark.read.schema(PAGES).option("multiLine", True).json(path)
    return d.select("document_name", "total_pages", F.explode_outer("pages").alias("p")).select("document_name", "total_pages", "p.*")


def document_texts(pages: DataFrame) -> DataFrame:
    """document_name and its pages' texts in order, a blank line between them."""
    p = pages.groupBy("document_name").agg(F.array_sort(F.collect_list(F.struct("page_number", F.coalesce("full_text", F.lit("")).alias("t")))).alias("p"))
    return p.select("document_name", F.array_join(F.transform("p", lambda x: x["t"]), "\n\n").alias("text"))


def read_extractions(spark: SparkSession, path: str) -> DataFrame:
    """One JSON file per document: the fields, all candidates and the notes."""
    return spark.read.schema(EXTRACTION).option("multiLine", True).json(path)


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """The list of expected values, a JSON array."""
    return spark.read.schema(SEEDS).option("multiLine", True).json(path)


def list_files(spark: SparkSession, folders: list[str], pattern: str = "*") -> DataFrame:
    """path, file, stem and the priority (position in the list) of every file below the folders; contents aren't read."""
    out = None
    for k, folder in enumerate(folders):
        f = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder).select("path", F.regexp_extract("path", r"([^/]*)$", 1).alias("file"), "length", F.lit(k).alias("priority"))
        out = f if out is None else out.unionByName(f)
    return out.withColumn("stem", stem(F.col("file")))


def resolve(names: DataFrame, files: DataFrame) -> DataFrame:
    """Of every name (document_name) the first folder's file; path null if no folder has it."""
    w = Window.partitionBy("document_name").orderBy("priority", "path")
    hit = names.select("document_name").distinct().join(files, F.col("document_name") == F.col("file"), "left")
    return hit.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("document_name", "path")


def group_page_files(files: DataFrame) -> DataFrame:
    """The page files of every document, in order."""
    return files.groupBy(page_document(F.col("file")).alias("document_name")).agg(F.sort_array(F.collect_list("file")).alias("page_files"))


def latest_run_file(files: DataFrame) -> DataFrame:
    """The run summary whose name is last: names hold the time."""
    return files.where(F.col("file").rlike(r"^pipeline_run_.*\.json$")).agg(F.max_by("path", "file").alias("path"))
