"""Queries of the general data-preparation operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millsheet.operators.nested import flat_tables, page_rows
from millsheet.operators.quantities import hidden_units, normalise_quantities, quantity_records
from millsheet.operators.timestamps import date_records, hidden_sites, normalise_timestamps
from millsheet.session import table


def _quantity_records(spark: SparkSession, sf: str) -> DataFrame:
    return quantity_records(table(spark, sf, "extracted_entity"), table(spark, sf, "extraction_result"), table(spark, sf, "seed_record"))


def _quantities(spark: SparkSession, sf: str) -> DataFrame:
    return normalise_quantities(_quantity_records(spark, sf))


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return _quantities(spark, sf).where(F.col("stated") & F.col("amount").isNotNull()).select("source_table", "row_id", "base_unit", "amount")


def p1_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Every number with its segment and its stated or inferred unit."""
    return _quantities(spark, sf)


def p1_hidden(spark: SparkSession, sf: str) -> DataFrame:
    """How many stated units the levels of their histories find when they are hidden, and how many amounts come within 2 % then."""
    h = hidden_units(_quantity_records(spark, sf))
    near = F.abs(F.col("found_amount") - F.col("amount")) <= 0.02 * F.abs(F.col("amount"))
    return h.groupBy("source_table").agg(F.count("*").alias("n"), F.count("found_unit").alias("n_found"), F.count_if(F.col("found_unit") == F.col("base_unit")).alias("n_unit_right"), F.count_if((F.col("found_unit") == F.col("base_unit")) & near).alias("n_amount_right"))


def _date_records(spark: SparkSession, sf: str) -> DataFrame:
    return date_records(table(spark, sf, "extraction_result"), table(spark, sf, "seed_record"))


def _dates(spark: SparkSession, sf: str) -> DataFrame:
    return normalise_timestamps(_date_records(spark, sf))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return _dates(spark, sf).where("by_convention").select("source_table", "row_id", "utc")


def p2_formats(spark: SparkSession, sf: str) -> DataFrame:
    """How often each source table writes dates in each format, how many have several readings, and how many the history alone reads as the conventions do."""
    return _dates(spark, sf).groupBy("source_table", "format").agg(F.count("*").alias("n"), F.count_if(F.col("interpretations") > 1).alias("n_ambiguous"), F.count_if(F.col("utc") == F.col("by_history")).alias("n_by_history"))


def p2_hidden(spark: SparkSession, sf: str) -> DataFrame:
    """Of the days that are valid in either order of day and month: how many the history reads as the site's convention when no site is known."""
    h = hidden_sites(_date_records(spark, sf))
    return h.groupBy("source_table").agg(F.count("*").alias("n"), F.count_if(F.col("day") == F.col("by_history")).alias("n_right"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return page_rows(table(spark, sf, "pipeline_run"))


def p3_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of every flat table of the run summaries."""
    rows = None
    for tag, t in flat_tables(table(spark, sf, "pipeline_run")).items():
        n = t.select(F.lit(tag).alias("tag"), "parent")
        rows = n if rows is None else rows.unionByName(n)
    return rows.groupBy("tag").agg(F.count("*").alias("n"), F.countDistinct("parent").alias("n_parents"))


QUERIES = {f.__name__: f for f in (p1_found, p1_segments, p1_hidden, p2_found, p2_formats, p2_hidden, p3_found, p3_tags)}
ORACLE: dict[str, str] = {}
