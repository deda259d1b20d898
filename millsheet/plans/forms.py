"""Forms of five kinds in two languages with their expected values, rendered in SQL that Spark and DuckDB both read.

One form for every number of a range: kind, language and modality go round (five kinds, two languages, two digital and two
scanned ones of each), the values are drawn by arithmetic on the number. Scanned forms are one line, as OCR gives them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millsheet.plans.corpus import _2, _MATERIAL, _MONTH, _PREFIX, _S, _SUFFIX, _TYPE, _pick

#: Forms that a query renders.
FORMS = 4000
_UNIT = ["pcs", "kg", "lbs", "tonnes", "m", "mm"]
_MAKER = ["Argenthal", "Bellmont", "Corvanne", "Dornfels", "Estrelle", "Falkmoor"]
_DRAWN = lambda a, b, n: f"(k * {a} + {b}) % {n}"

_VALUES = f"""
SELECT k, {_pick('k', _TYPE)} AS doc_type, CAST(floor(k / 5) AS BIGINT) % 2 AS fr, CAST(floor(k / 20) AS BIGINT) % 2 AS scanned,
  ({_pick(_DRAWN(7, 3, 6), _PREFIX)}) || '-' || {_S(f'1000 + {_DRAWN(7919, 13, 99000)}')} AS project,
  ({_pick(_DRAWN(5, 1, 6), _MAKER)}) || ' ' || ({_pick(_DRAWN(11, 2, 6), _SUFFIX)}) AS supplier, {_pick(_DRAWN(5, 4, 12), _MATERIAL)} AS material,
  CASE WHEN k % 3 = 0 THEN {_S(f'1 + {_DRAWN(31, 7, 249)}')} || '.' || {_2(_DRAWN(17, 5, 100))} ELSE {_S(f'5 + {_DRAWN(37, 11, 496)}')} END || ' ' || ({_pick(_DRAWN(13, 1, 6), _UNIT)}) AS quantity,
  2024 + CAST(floor({_DRAWN(29, 3, 27)} / 12) AS BIGINT) AS y, 1 + {_DRAWN(29, 3, 27)} % 12 AS mo, 1 + {_DRAWN(19, 2, 28)} AS d
FROM numbers
"""
_WRITTEN = f"""
SELECT *, CASE WHEN fr = 1 OR k % 3 = 0 THEN {_2('d')} || '/' || {_2('mo')} || '/' || {_S('y')} WHEN k % 3 = 1 THEN {_S('y')} || '-' || {_2('mo')} || '-' || {_2('d')}
  ELSE ({_pick('(mo - 1)', _MONTH)}) || ' ' || {_2('d')} || ', ' || {_S('y')} END AS datum, CASE WHEN scanned = 1 THEN ' ' ELSE chr(10) END AS nl FROM drawn
"""


def _say(en: str, fr: str) -> str:
    return f"(CASE WHEN fr = 1 THEN '{fr}' ELSE '{en}' END)"


#: The lines of each kind, of labels in both languages and values.
_LINES = {
    "MaterialCert": [_say("MATERIAL CERTIFICATE", "CERTIFICAT MATIERE"), f"{_say('Manufacturer', 'Fabricant')} || ': ' || supplier", f"{_say('Order ref.', 'Commande')} || ' ' || project", f"{_say('Grade', 'Nuance')} || ': ' || material", f"{_say('Net weight', 'Poids net')} || ': ' || quantity", f"{_say('Issue date', 'Date emission')} || ': ' || datum"],
    "WeldingPlan": [_say("WELDING PLAN", "PLAN SOUDURE"), f"{_say('Project', 'Projet')} || ' ' || project", f"{_say('Supplier', 'Fournisseur')} || ': ' || supplier", f"{_say('Base material', 'Matériau')} || ': ' || material", f"{_say('Quantity', 'Quantité')} || ': ' || quantity", f"{_say('Effective', 'Date')} || ' ' || datum"],
    "FabricationSheet": [_say("FABRICATION SHEET", "FICHE ATELIER"), f"{_say('Vendor', 'Fournisseur')} || ' ' || supplier", f"{_say('Job', 'Affaire')} || ' ' || project", f"{_say('Description', 'Désignation')} || ' = ' || material", f"{_say('Qty', 'Qté')} || ' ' || quantity", f"{_say('Shipped', 'Date')} || ': ' || datum"],
    "InspectionReport": [_say("INSPECTION REPORT", "RAPPORT CONTROLE"), f"{_say('Issued by', 'Fabricant')} || ': ' || supplier", f"{_say('Reference', 'Dossier')} || ': ' || project", f"{_say('Material', 'Matière')} || ': ' || material", f"{_say('Amount', 'Nombre')} || ': ' || quantity", f"{_say('Report date', 'Date essai')} || ': ' || datum"],
    "Invoice": [_say("INVOICE", "FACTURE"), f"{_say('Seller', 'Fournisseur')} || ': ' || supplier", f"{_say('Purchase order', 'Bon')} || ' ' || project", f"{_say('Commodity', 'Désignation')} || ': ' || material", f"{_say('Total weight', 'Poids total')} || ': ' || quantity", f"{_say('Invoice date', 'Date facture')} || ': ' || datum"],
}
_TEXT = "CASE doc_type " + " ".join(f"WHEN '{t}' THEN " + " || nl || ".join(lines) for t, lines in _LINES.items()) + " END"
_FORM = f"""
SELECT k AS doc, 'Synthetic_' || doc_type || '_' || (CASE WHEN fr = 1 THEN 'FR' ELSE 'EN' END) || '_' || {_S('k')} || (CASE WHEN scanned = 1 THEN '_scanned' ELSE '' END) || '.pdf' AS document_name, doc_type,
  CASE WHEN fr = 1 THEN 'FR' ELSE 'EN' END AS language, CASE WHEN scanned = 1 THEN 'scanned' ELSE 'digital' END AS modality, {_TEXT} AS text,
  project AS g_project_id, supplier AS g_supplier, material AS g_material, quantity AS g_quantity, {_S('y')} || '-' || {_2('mo')} || '-' || {_2('d')} AS g_date
FROM written
"""
_REST = f"drawn AS ({_VALUES}), written AS ({_WRITTEN}), corpus AS ({_FORM})"
#: ``WITH`` clauses that define the forms as ``corpus``, in DuckDB.
WITH = f"WITH numbers AS (SELECT range AS k FROM range({FORMS})), {_REST}"


def forms(spark: SparkSession, n: int = FORMS) -> DataFrame:
    """The first ``n`` forms with their expected values."""
    return spark.sql(f"WITH numbers AS (SELECT id AS k FROM range({n})), {_REST} SELECT * FROM corpus")
