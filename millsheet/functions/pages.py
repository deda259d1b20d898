"""Expressions on OCR words, pages and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stem(name: Column) -> Column:
    """A file name without folder and last suffix."""
    return F.regexp_replace(F.regexp_extract(name, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def page_document(name: Column) -> Column:
    """The document of a page file: the stem before its last ``_p``, or the whole stem."""
    s = stem(name)
    return F.when(F.contains(s, F.lit("_p")), F.regexp_extract(s, r"^(.*)_p", 1)).otherwise(s)


def facets(name: Column) -> list[Column]:
    """origin, doc_type, language and source of a file name."""
    parts = F.split(stem(name), "_", 4)
    return [F.try_element_at(parts, F.lit(i + 1)).alias(k) for i, k in enumerate(("origin", "doc_type", "lang_code", "source_name"))]


def language_of_name(name: Column) -> Column:
    return F.when(F.contains(name, F.lit("_FR_")), F.lit("FR")).otherwise(F.lit("EN"))


def polygon_bbox(points: Column) -> Column:
    """x, y, width, height of a polygon given as array<struct<x, y>>, cut to whole numbers."""
    x, y = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    low = lambda a: F.array_min(a).cast("int")
    return F.array(low(x), low(y), (F.array_max(x) - low(x)).cast("int"), (F.array_max(y) - low(y)).cast("int"))


def kept_words(words: Column) -> Column:
    """Words that count: neither blank nor of negative confidence."""
    return F.filter(words, lambda w: (F.trim(w["text"]) != "") & (w["confidence"] >= 0))


def mean_confidence(words: Column) -> Column:
    """Mean confidence of the words that count, null without any."""
    k = kept_words(words)
    return F.when(F.size(k) > 0, F.aggregate(k, F.lit(0.0), lambda s, w: s + w["confidence"]) / F.size(k))


def deskew_angle(a: Column) -> Column:
    """The turn that straightens a page whose smallest rectangle has angle ``a``; 0 below 0.3 degrees."""
    turn = F.when(a < -45, -(a + 90)).otherwise(-a)
    return F.when(F.abs(turn) < 0.3, 0.0).otherwise(turn)


def _at(content: Column, place: int, head: str) -> Column:
    """Whether the bytes from ``place`` (from 0) are these, given as hex digits."""
    return F.substring(content, place + 1, len(head) // 2) == F.to_binary(F.lit(head), F.lit("hex"))


def image_type(content: Column) -> Column:
    """The kind of an image file of at least 50 bytes by its first bytes, null if it is none."""
    return F.when(F.length(content) < 50, None).when(_at(content, 0, "FFD8FF"), "jpeg").when(_at(content, 0, "89504E470D0A1A0A"), "png").when(_at(content, 0, "474946383761") | _at(content, 0, "474946383961"), "gif").when(_at(content, 0, "52494646") & _at(content, 8, "57454250"), "webp")


def image_check(content: Column) -> Column:
    """What becomes of fetched content: an image of at least 512 bytes is taken."""
    return F.when(F.length(content) < 512, "too small").when(image_type(content).isNull(), "no image").otherwise("ok")


def is_pdf(content: Column) -> Column:
    """Whether content begins as a PDF file does."""
    return _at(content, 0, "255044462D")


def pdf_check(content: Column) -> Column:
    """What becomes of fetched content: a PDF file of at least 1024 bytes is taken."""
    return F.when(F.length(content) < 1024, "too small").when(~is_pdf(content), "no PDF").otherwise("ok")


def pdf_present(content: Column) -> Column:
    """Whether a file that is there already needs no fetching: a PDF file of more than 1024 bytes."""
    return is_pdf(content) & (F.length(content) > 1024)


def is_pdf_name(name: Column) -> Column:
    """Whether a file's suffix, in any letter case, is the only one that is read."""
    return F.lower(name).endswith(".pdf")


def corner_bbox(word: Column) -> Column:
    """x, y, width, height of a word of the text layer given by its corners x0, y0, x1, y1, cut to whole numbers."""
    return F.array(word["x0"].cast("int"), word["y0"].cast("int"), (word["x1"] - word["x0"]).cast("int"), (word["y1"] - word["y0"]).cast("int"))


def percent(confidence: Column) -> Column:
    """A confidence between 0 and 1 on the scale of 100."""
    return confidence * 100


#: How the outcomes are shown: fixed values.
OUTCOME_MARKS = {"OK": "\u2713", "WRONG": "\u2715", "MISS": "\u00b7", "FP": "!", "\u2014": "\u2013", "missing-json": "?"}


def outcome_mark(outcome: Column) -> Column:
    marks = F.create_map(*[F.lit(x) for kv in OUTCOME_MARKS.items() for x in kv])
    return F.coalesce(F.try_element_at(marks, F.coalesce(outcome, F.lit("\u2014"))), F.lit("?"))


def confidence_band(c: Column) -> Column:
    return F.when(c < 50, "poor").when(c < 80, "borderline").otherwise("good")


def chosen_engine(tess: Column, paddle: Column, fallback: bool = True, threshold: float = 60.0) -> Column:
    """Which engine's result a page takes: the first if sure enough, else the second if there is one, else the first, else none."""
    second = paddle.isNotNull() if fallback else F.lit(False)
    return F.when(tess >= threshold, "tesseract").when(second, "paddleocr").when(tess.isNotNull(), "tesseract")
