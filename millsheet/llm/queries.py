"""Queries of the operators in this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millsheet.llm.canonical import map_rows, material_rows
from millsheet.llm import language
from millsheet.llm.leakage import find_leaks
from millsheet.llm.names import link_names, linked_pairs, supplier_names
from millsheet.llm.packing import count_tokens, least_containers, pack
from millsheet.llm.sentences import split_sentences
from millsheet.llm.topn import top_n
from millsheet.operators.quantities import document_key
from millsheet.session import cut, spread, table


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "extracted_entity")
    doc = document_key(F.col("document_name"))
    return top_n(e, [F.when(doc != "", doc), F.lower(F.trim("field"))], F.col("confidence"), F.col("ord"), F.col("entity_id"), 3).select(F.col("id").alias("entity_id"), "rank_no")


def _materials(spark: SparkSession, sf: str) -> DataFrame:
    return map_rows(material_rows(table(spark, sf, "extracted_entity"), table(spark, sf, "extraction_result")), table(spark, sf, "material_ref"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return _materials(spark, sf).select("source_table", "row_id", "ref_id")


def p6_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    """How many values of each table name each entry, or none."""
    return _materials(spark, sf).groupBy("source_table", "ref_id").agg(F.count("*").alias("n"), F.round(F.avg("score"), 3).alias("mean_score"))


def p6_ranking(spark: SparkSession, sf: str) -> DataFrame:
    """Of the values that name an entry, how many have it first in the ranking, before the check of codes."""
    m = _materials(spark, sf)
    return m.groupBy("source_table").agg(F.count("*").alias("n"), F.count_if(F.col("ref_id") != "NONE").alias("n_named"), F.count_if((F.col("ref_id") != "NONE") & (F.col("ref_id") == F.col("ranked_first"))).alias("n_first"), F.count_if((F.col("ref_id") == "NONE") & (F.col("ranked_first") != "NONE")).alias("n_refused"))


def _companies(spark: SparkSession, sf: str) -> DataFrame:
    return link_names(supplier_names(table(spark, sf, "extraction_result"), table(spark, sf, "seed_record")))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return linked_pairs(_companies(spark, sf))


def p7_companies(spark: SparkSession, sf: str) -> DataFrame:
    """Every spelling with the canonical form it is attached to."""
    return _companies(spark, sf)


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return find_leaks(spread(table(spark, sf, "documents")), table(spark, sf, "eval_items"))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return split_sentences(spread(table(spark, sf, "documents")))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return language.find_languages(spread(table(spark, sf, "documents")), table(spark, sf, "seed_record"), table(spark, sf, "ocr_result"), document_key)


def p5_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Every stretch of every document with its language and confidence."""
    d = spread(table(spark, sf, "documents"))
    read = language.read_languages(d.select(F.col("doc_id").alias("row_id"), "text"), language.fit(d)).withColumn("confidence", F.round("confidence", 4))
    return read.dropDuplicates(["row_id", "segment_no", "start_pos", "end_pos", "lang"])


def p8_containers(spark: SparkSession, sf: str) -> DataFrame:
    return pack(count_tokens(spread(table(spark, sf, "documents"))), table(spark, sf, "pack_capacity"))


def p8_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Of each capacity: containers, tokens, the used share, the containers that are needed at least, and how many more there are."""
    packed = cut(p8_containers(spark, sf))
    sizes = sorted({(r[0], r[1]) for r in table(spark, sf, "pack_capacity").select("capacity_id", "capacity_tokens").collect() if r[1]})
    least = spark.createDataFrame([(k, c, least_containers(packed.where(F.col("capacity_id") == k), c)) for k, c in sizes], "capacity_id int, capacity_tokens int, least int")
    per = packed.groupBy("capacity_id").agg(F.countDistinct("container").alias("containers"), F.sum("tokens").alias("tokens"))
    used = F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 5).alias("used")
    return per.join(least, "capacity_id").select("capacity_id", "containers", "tokens", used, "least", (F.col("containers") - F.col("least")).alias("above_least"))


QUERIES = {f.__name__: f for f in (p4_found, p6_found, p6_unmatched, p6_ranking, p7_found, p7_companies, p9_found, p10_found, p5_found, p5_segments, p8_containers, p8_fill)}

ORACLE = {
    "p4_found": """
WITH e AS (
  SELECT DISTINCT entity_id, regexp_replace(lower(trim(document_name)), '\\s*\\.pdf$', '') AS d, lower(trim(field)) AS f, confidence AS c, ord AS o
  FROM extracted_entity WHERE document_name IS NOT NULL AND field IS NOT NULL AND confidence IS NOT NULL AND NOT isnan(confidence)
), r AS (SELECT entity_id, row_number() OVER (PARTITION BY d, f ORDER BY c DESC, o NULLS LAST, entity_id) AS k FROM e WHERE d <> '')
SELECT entity_id, CAST(k AS INTEGER) AS rank_no FROM r WHERE k <= 3
""",
}
