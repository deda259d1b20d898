"""An industrial corpus rendered from ``orders``: one document per order, in SQL that Spark and DuckDB both read.

Columns: doc, document_name, doc_type, language, modality, origin, text, and the labels g_project_id, g_supplier,
g_material, g_quantity, g_date, some of them wrong, empty or ``N/A`` on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millsheet.session import spread, table


def _pick(expr: str, values: list[str]) -> str:
    return f"CASE {expr} % {len(values)} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


_NAMES = ["Nordhall", "Brunwick", "Castelan", "Ferromax", "Lindqvar", "Ostmark", "Pellegri", "Varennes"]
_SUFFIX = ["SARL", "SA", "GmbH", "Industries", "et Fils", "Group"]
_MATERIAL = ["304L", "316L", "SS 316", "1.4307", "A106 Gr. B", "6061-T6", "Duplex 2205", "Carbon Steel", "S355J2", "Inconel 625", "PVC Sch 80", "AWS A5.9 ER316L"]
_UNITS = ["pcs", "kg", "lbs", "tonnes", "m", "units"]
_PREFIX = ["PRJ", "WO", "JOB", "WLD", "FAB", "PO"]
_MONTH = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
_S = lambda e: f"CAST({e} AS STRING)"
_2 = lambda e: f"lpad({_S(e)}, 2, '0')"
_TYPE = ["MaterialCert", "WeldingPlan", "FabricationSheet", "InspectionReport", "Invoice"]

_PARTS = f"""
SELECT o_orderkey AS k, o_orderkey % 2 AS fr, year(o_orderdate) AS y, month(o_orderdate) AS mo, day(o_orderdate) AS d,
  {_pick('o_orderkey', _TYPE)} AS doc_type,
  ({_pick('o_orderkey', _NAMES)}) || ' ' || ({_pick('o_orderkey', _SUFFIX)}) AS supplier,
  ({_pick('o_orderkey', _PREFIX)}) || '-' || {_S('1000 + o_orderkey % 99000')} AS project,
  {_pick('o_orderkey', _MATERIAL)} AS material,
  {_S('5 + o_orderkey % 496')} || (CASE WHEN o_orderkey % 10 = 0 THEN ',5' WHEN o_orderkey % 4 = 1 THEN '.25' ELSE '' END) AS num,
  {_pick('o_orderkey', _UNITS)} AS unit,
  {_pick('(month(o_orderdate) - 1)', _MONTH)} AS mon
FROM orders
"""
_DATES = f"""
SELECT *, CASE k % 5 WHEN 0 THEN {_S('y')} || '-' || {_2('mo')} || '-' || {_2('d')} WHEN 1 THEN {_2('d')} || '.' || {_2('mo')} || '.' || {_S('y')}
  WHEN 2 THEN {_S('d')} || '/' || {_S('mo')} || '/' || {_S('y')} WHEN 3 THEN {_2('d')} || '.' || {_2('mo')} || '.' || {_2('y % 100')}
  ELSE mon || ' ' || {_S('d')} || ', ' || {_S('y')} END AS datum FROM parts
"""
_LINES = """
SELECT *, CASE WHEN k % 7 = 0 THEN ' ' ELSE chr(10) END AS nl FROM dated
"""
_TEXT = f"""
SELECT k AS doc, CASE WHEN k % 3 = 0 THEN 'Real' ELSE 'Synthetic' END || '_' || doc_type || '_' || (CASE WHEN fr = 1 THEN 'FR' ELSE 'EN' END) || '_' || {_S('k')} || '.pdf' AS document_name,
  doc_type, CASE WHEN fr = 1 THEN 'FR' ELSE 'EN' END AS language, CASE WHEN k % 7 = 0 THEN 'scanned' ELSE 'digital' END AS modality,
  CASE WHEN k % 3 = 0 THEN 'real_filled' ELSE 'synthetic' END AS origin,
  supplier || nl ||
  (CASE WHEN fr = 1 THEN 'Fournisseur' ELSE 'Supplier' END) || nl || supplier || nl ||
  (CASE WHEN k % 9 = 0 THEN 'Customer Watanabe Trading Co. Ltd' || nl ELSE '' END) ||
  (CASE WHEN k % 13 = 0 THEN '' WHEN k % 11 = 0 THEN (CASE WHEN fr = 1 THEN 'Certificat ' ELSE 'Certificate No. ' END) || {_S('100000 + k')} || nl ELSE 'Order ' || project || nl END) ||
  (CASE WHEN k % 17 = 0 THEN 'See also WPS-' || {_S('100 + k % 800')} || nl ELSE '' END) ||
  (CASE WHEN fr = 1 THEN 'Nuance: ' ELSE 'Material: ' END) || material || nl ||
  (CASE WHEN fr = 1 THEN 'Poids net: ' ELSE 'Quantity: ' END) || num || ' ' || unit || nl ||
  (CASE WHEN k % 4 = 0 THEN 'Issued ' ELSE 'Date: ' END) || datum || nl ||
  (CASE WHEN k % 6 = 0 THEN 'Report date ' || datum || nl ELSE '' END) || 'Page 1' AS text,
  CASE WHEN k % 13 = 0 THEN '' WHEN k % 11 = 0 THEN {_S('100000 + k')} WHEN k % 29 = 0 THEN 'ZZ-99' ELSE project END AS g_project_id,
  CASE WHEN k % 31 = 0 THEN 'N/A' WHEN k % 23 = 0 THEN 'Autre Usine SA' ELSE supplier END AS g_supplier,
  CASE WHEN k % 19 = 0 THEN '' ELSE material END AS g_material,
  CASE WHEN k % 37 = 0 THEN '1 pcs' ELSE num || ' ' || unit END AS g_quantity,
  {_S('y')} || '-' || {_2('mo')} || '-' || {_2('CASE WHEN k % 41 = 0 THEN 1 ELSE d END')} AS g_date
FROM lined
"""
#: ``WITH`` clauses that define ``corpus``.
WITH = f"WITH parts AS ({_PARTS}), dated AS ({_DATES}), lined AS ({_LINES}), corpus AS ({_TEXT})"


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    """The corpus of a data folder."""
    return spark.sql(f"{WITH.replace('FROM orders', 'FROM {orders}').strip()} SELECT * FROM corpus", orders=spread(table(spark, sf, "orders").select("o_orderkey", "o_orderdate")))
