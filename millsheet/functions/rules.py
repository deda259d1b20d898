"""Vocabularies and patterns of the field extractors.

The values below are fixed: results depend on them and on their order.
"""

# fixed values: pattern, confidence, source
PROJECT_ID = [
    (r"(?:numéro\s+de\s+certificat|certificat|certificate|certif\.?)\s*(?:n°|no\.?|number|nb|#)?\s*:?\s*(\d{5,9})", 0.95, "cert_trigger"),
    (r"\b(?:EXP|CERT)\s*\d{5,9}\b", 0.9, "cert_number"),
    (r"\b(?:PRJ|PROJ|WO|JOB|WLD|FAB|PO)[-_ ]?\d{2,7}\b", 0.85, "project_code"),
    (r"\b(?:WPS|SS)[-_ ]?\d{2,5}(?:[-_ ]?R\d+)?\b", 0.8, "wps_code"),
    (r"(?:reference|ref\.?|réf\.?|n°\s*commande)\s*:?\s*([A-Z]{2,4}[-_ ]?\d{2,7})", 0.75, "ref_trigger"),
]
MATERIAL = [
    (r"\bAWS\s+A\d\.\d+\s+[A-Z0-9-]+\b", 0.9, "aws_code"),
    (r"\b(?:SS\s?\d{3}L?|304L?|316L?|2205|S\d{3}[A-Z0-9\+]+)\b", 0.85, "steel_grade"),
    (r"\b1\.\d{4}\b", 0.85, "eu_steel_number"),
    (r"\bA\d{1,3}(?:\s*Gr\.?\s*[A-Z0-9]+)?\b", 0.8, "astm_grade"),
    (r"\b6061-T6\b", 0.9, "aluminum_grade"),
    (r"\b(?:Duplex|Monel|Hastelloy|Inconel|Hardox)\s*\d{3,4}\b", 0.85, "named_alloy"),
    (r"\b(?:Carbon\s+Steel|Stainless\s+Steel|Galvanized\s+Steel|Copper|PVC\s+Sch\s*\d+|Inox\s+\d{3}L?)\b", 0.75, "material_descriptor"),
]
QUANTITY = r"\b(\d{1,6}(?:[.,]\d{1,3})?)\s*(pcs|pieces|units|kg|kgs|lbs|tons|tonnes|metres?|mm|m)\b"
DATE = [
    (r"\b(\d{4})-(\d{2})-(\d{2})\b", 0.95, "iso"),
    (r"\b(\d{4})\.(\d{2})\.(\d{2})\b", 0.95, "iso_dot"),
    (r"\b(\d{1,2})\.(\d{1,2})\.(\d{2,4})\b", 0.85, "eu_dot"),
    (r"\b(\d{1,2})/(\d{1,2})/(\d{2,4})\b", 0.8, "slash"),
    (r"\b(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\s+(\d{1,2}),?\s+(\d{2,4})\b", 0.9, "en_textual"),
    (r"\b(\d{1,2})\s+(janv|févr|mars|avr|mai|juin|juil|août|sept|oct|nov|déc)[a-zé]*\s+(\d{2,4})\b", 0.9, "fr_textual"),
]
SUPPLIER_TRIGGERS = ["supplier", "vendor", "from", "seller", "issued by", "manufacturer", "shipped from", "ship from", "produced by", "fournisseur", "émis par", "émetteur", "fabricant", "producteur", "de"]
CORPORATE_SUFFIXES = ["Ltd", "Ltd.", "LLC", "Inc.", "Group", "Co.", "Corp.", "GmbH", "AG", "SA", "SARL", "S.A.S.", "SAS", "Aciéries", "Steel Mills", "Pvt.", "Private Limited", "et Fils", "Industries", "Industrial"]
NOT_A_SUPPLIER = ["customer", "client", "watanabe", "trading co"]
MATERIAL_TRIGGERS = ["material", "material type", "material spec", "base material", "grade", "commodity", "description", "filler metal", "steel", "designation", "matière", "matériau", "type de matériau", "désignation du matériau", "désignation", "nuance", "désign. acier", "métal de base"]
QUANTITY_TRIGGERS = ["quantity", "qty", "weight", "total weight", "gross weight", "net weight", "amount", "total", "masse", "quantité", "qté", "poids", "poids net", "poids total", "masse", "masse théorique", "masse effective", "nombre", "unités"]
DATE_TRIGGERS = ["date", "issue date", "invoice date", "date of sale", "effective", "mfg. date", "shipped", "report date", "date", "date d'émission", "date d'expédition", "date de facture", "date d'essai", "date de fabrication"]
MONTHS = {"jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12, "janv": 1, "févr": 2, "mars": 3, "avr": 4, "mai": 5, "juin": 6, "juil": 7, "août": 8, "sept": 9, "déc": 12}
FIELDS = ["project_id", "supplier", "material", "quantity", "date"]
