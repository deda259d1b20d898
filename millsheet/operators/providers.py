"""Plug points for what needs pixels: page rendering, cleaning and the OCR engines.

A provider is a function over batches of rows; the engine calls it on executors through ``mapInPandas`` and keeps every
failure inside its row. None is built in: engines and images are outside this package.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millsheet.functions.pages import chosen_engine, corner_bbox, mean_confidence, stem
from millsheet.functions.text import strip
from millsheet.operators.runs import cleaner
from millsheet.sources.readers import WORDS

#: Kinds of providers: what they add to (document_name, page_number, content).
KINDS = {"render": "content binary", "decode": "content binary", "clean": "content binary", "gray": "content binary", "text_layer": f"words {WORDS}", "ocr": f"words {WORDS}", "ocr_fallback": f"words {WORDS}"}
_REGISTERED: dict[str, Callable[[pd.DataFrame], pd.Series]] = {}


def register_provider(kind: str, function: Callable[[pd.DataFrame], pd.Series]) -> None:
    """Sets the provider of a kind: from a batch of pages to one value per page, None where it finds nothing."""
    if kind not in KINDS:
        raise ValueError(f"no kind of provider: {kind}")
    _REGISTERED[kind] = function


def provide(pages: DataFrame, kind: str) -> DataFrame:
    """``pages`` with the column of the provider and ``error``; a batch that fails is tried page by page."""
    if kind not in _REGISTERED:
        raise LookupError(f"no provider of kind {kind} is registered")
    function, (column, _, type_) = _REGISTERED[kind], KINDS[kind].partition(" ")
    kept = [f for f in pages.schema.fields if f.name not in (column, "error")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b.reset_index(drop=True)
            errors: list[str | None] = [None] * len(b)
            try:
                values = list(function(b))
            except Exception:  # noqa: BLE001
                values = []
                for i in range(len(b)):
                    try:
                        values += list(function(b.iloc[[i]]))
                    except Exception as e:  # noqa: BLE001
                        values.append(None)
                        errors[i] = str(e) or type(e).__name__
            out = b[[f.name for f in kept]].copy()
            out[column], out["error"] = pd.Series(values, dtype=object), pd.Series(errors, dtype=object)
            yield out

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return pages.mapInPandas(run, f"{names}, `{column}` {type_}, error string")


def preprocess(pages: DataFrame) -> DataFrame:
    """Pages (document_name, page_number, content, modality) made ready for reading: each provider sees only the pages that are routed to it."""
    routed = pages.withColumn("via", cleaner(F.col("modality")))
    return provide(routed.where("via = 'clean'"), "clean").unionByName(provide(routed.where("via = 'gray'"), "gray")).drop("via")


def text_layer_pages(pages: DataFrame) -> DataFrame:
    """Pages read from a text layer: ``pages`` (document_name, page_number, text, layer), where ``layer`` has the words with their corners.

    Blank words don't count, boxes are whole numbers, a page with words is sure (100), one without is not (0).
    """
    kept = F.filter("layer", lambda w: strip(w["text"]) != "")
    words = F.transform(kept, lambda w: F.struct(strip(w["text"]).alias("text"), F.lit(100.0).alias("confidence"), corner_bbox(w).alias("bbox")))
    named = F.format_string("%s_p%02d.pdf-text", stem(F.col("document_name")), F.col("page_number"))
    out = pages.select("document_name", "page_number", named.alias("page_file"), strip(F.coalesce("text", F.lit(""))).alias("full_text"), F.coalesce(words, F.array().cast(WORDS)).alias("words"))
    return out.withColumn("avg_confidence", F.when(F.size("words") > 0, 100.0).otherwise(0.0)).withColumn("engine", F.lit("tesseract"))


def read_pages(pages: DataFrame, fallback: bool = True) -> DataFrame:
    """Words, engine and confidence of scanned pages: the second engine only sees the pages the first wasn't sure of.

    A page on which all engines fail is an empty page of confidence 0.
    """
    first = provide(pages, "ocr").drop("error").withColumn("tess", mean_confidence(F.col("words")))
    unsure = (F.coalesce("tess", F.lit(-1.0)) < 60) & F.lit(fallback and "ocr_fallback" in _REGISTERED)
    sure = first.where(~unsure).withColumn("second", F.lit(None).cast(WORDS))
    rest = first.where(unsure)
    if fallback and "ocr_fallback" in _REGISTERED:
        again = provide(rest.withColumnRenamed("words", "first_words"), "ocr_fallback").drop("error").withColumnRenamed("words", "second").withColumnRenamed("first_words", "words")
        sure = sure.unionByName(again)
    paddle = mean_confidence(F.col("second"))
    engine = chosen_engine(F.col("tess"), paddle, fallback)
    words = F.when(engine == "paddleocr", F.col("second")).otherwise(F.col("words"))
    out = sure.withColumn("engine", F.coalesce(engine, F.lit("tesseract"))).withColumn("avg_confidence", F.coalesce(F.when(engine == "paddleocr", paddle).otherwise(F.col("tess")), F.lit(0.0))).withColumn("words", words)
    kept = F.filter("words", lambda w: F.trim(w["text"]) != "")
    return out.drop("tess", "second").withColumn("full_text", F.coalesce(F.array_join(F.transform(kept, lambda w: w["text"]), " "), F.lit("")))
