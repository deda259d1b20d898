"""The field rules as a table function in Python: what the native extraction is compared with, and a way to use it from SQL."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from millsheet.functions import rules

RETURNS = "field string, value string, confidence double, source string, raw_text string"
_SPACES = re.compile(r"\s+")


def _ids(text: str) -> Iterator[tuple]:
    for pattern, sure, source in rules.PROJECT_ID:
        for m in re.finditer(pattern, text, re.I):
            value = m[m.lastindex or 0].strip().upper()
            if len(value) <= 15 and not (len(value) == 4 and value.isdecimal()):
                yield "project_id", value, sure, source, m[0]


def _suppliers(text: str) -> Iterator[tuple]:
    lines = text.split("\n")
    for at, line in enumerate(lines):
        low = line.lower()
        for trigger in filter(low.__contains__, rules.SUPPLIER_TRIGGERS):
            for near in map(str.strip, lines[at : at + 3]):
                if len(near) > 2 and near.lower() != trigger and any(map(near.__contains__, rules.CORPORATE_SUFFIXES)):
                    yield "supplier", _SPACES.sub(" ", near), 0.8, "trigger_" + trigger, near
    head = " ".join(lines[: max(5, len(lines) // 5)])
    for suffix in rules.CORPORATE_SUFFIXES:
        for m in re.finditer(rf"\b([A-Z][A-Za-z\s,.&-]+{re.escape(suffix)}\.?)\b", head):
            value = _SPACES.sub(" ", m[0].strip())
            if not any(map(value.lower().__contains__, rules.NOT_A_SUPPLIER)):
                yield "supplier", value, 0.6, "letterhead", m[0]


def _materials(text: str) -> Iterator[tuple]:
    for pattern, sure, source in rules.MATERIAL:
        for m in re.finditer(pattern, text, re.I):
            yield "material", _SPACES.sub(" ", m[0].strip()), sure, source, m[0]
    for line in text.split("\n"):
        parts = re.split("[:=-]", line, maxsplit=1)
        value = re.split("[,;]", parts[-1].strip())[0].strip()
        if len(parts) == 2 and 2 < len(value) < 100:
            for trigger in filter(line.lower().__contains__, rules.MATERIAL_TRIGGERS):
                yield "material", value, 0.7, "trigger_" + trigger, line


def _quantities(text: str) -> Iterator[tuple]:
    for m in re.finditer(rules.QUANTITY, text, re.I):
        before = text[max(0, m.start() - 50) : m.end()].lower()
        trigger = next(filter(before.__contains__, rules.QUANTITY_TRIGGERS), None)
        yield "quantity", m[1].replace(",", ".") + " " + m[2].lower(), 0.85 if trigger else 0.7, f"trigger_{trigger}" if trigger else "pattern", m[0]


def _dates(text: str) -> Iterator[tuple]:
    for pattern, base, source in rules.DATE:
        near = 0
        for m in re.finditer(pattern, text, re.I):
            before = text[max(0, m.start() - 30) : m.end()].lower()
            near += any(map(before.__contains__, ("date", "effective", "shipped")))
            g = list(m.groups())
            if source.startswith("iso"):
                g.reverse()
            elif source == "en_textual":
                g[:2] = g[1], str(rules.MONTHS.get(g[0].lower()[:3], 1))
            elif source == "fr_textual":
                g[1] = str(rules.MONTHS.get(g[1].lower()[:4], 1))
            day, month, year = map(int, g)
            year += 2000 if year < 50 else 1900 if year < 100 else 0
            yield "date", f"{day:02d}/{month:02d}/{year:04d}", min(1.0, round(base + 0.1 * near, 2)), source, m[0]


class ExtractCandidates:
    """Every candidate of a text, field by field in candidate order."""

    def eval(self, text: str) -> Iterator[tuple]:
        for of in (_ids, _suppliers, _materials, _quantities, _dates):
            yield from of(text or "")


def register(spark: SparkSession, name: str = "extract_candidates") -> None:
    """Makes the table function known to SQL."""
    spark.udtf.register(name, udtf(ExtractCandidates, returnType=RETURNS))
