"""Scoring of extracted fields against labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millsheet.functions.rules import FIELDS
from millsheet.functions.text import eval_normalize, eval_normalize_date, id_of, qty_of

#: Share of the label's tokens that a free-text prediction must hold.
OVERLAP = 0.34


def _overlap(p: Column, g: Column) -> Column:
    tokens = lambda c: F.array_distinct(F.filter(F.split(c, " "), lambda t: F.length(t) >= 3))
    # the label's tokens are named once
    return F.transform(F.array(tokens(g)), lambda t: F.when(F.size(t) > 0, F.size(F.array_intersect(tokens(p), t)) / F.size(t)))[0]


def token_overlap(pred: Column, label: Column) -> Column:
    """Share of the label's distinct tokens of three or more letters that the prediction has; null without any."""
    return _overlap(eval_normalize(pred), eval_normalize(label))


def matches(field: Column, pred: Column, label: Column) -> Column:
    """Whether a prediction satisfies a label of its field."""
    inside = lambda a, b: ((a != "") & F.contains(b, a)) | F.contains(a, b)

    def of(x: Column) -> Column:
        p, g = x["p"], x["g"]
        free = F.when(p == "", False).otherwise(F.coalesce(_overlap(p, g) >= OVERLAP, p == g))
        by_field = (
            F.when(field == "project_id", inside(id_of(p), id_of(g)))
            .when(field == "date", eval_normalize_date(pred) == eval_normalize_date(label))
            .when(field == "quantity", inside(qty_of(p), qty_of(g)))
            .otherwise(free)
        )
        return F.when((F.coalesce(label, F.lit("")) == "") | (F.upper(g) == "N/A"), True).otherwise(by_field)

    # both are normalised once, whatever the field
    normalised = F.array(F.struct(eval_normalize(pred).alias("p"), eval_normalize(label).alias("g")))
    return F.when(F.coalesce(pred, F.lit("")) == "", False).otherwise(F.transform(normalised, of)[0])


def outcome(field: Column, pred: Column, label: Column, present: Column) -> Column:
    """OK, WRONG, FP, MISS, — or missing-json."""
    has_pred, has_label = F.coalesce(pred, F.lit("")) != "", F.coalesce(label, F.lit("")) != ""
    return (
        F.when(~present, "missing-json")
        .when(has_pred & has_label, F.when(matches(field, pred, label), "OK").otherwise("WRONG"))
        .when(has_pred, "FP").when(has_label, "MISS").otherwise("—")
    )


def unpivot(rows: DataFrame, prefix: str, value: str, keep: list[str]) -> DataFrame:
    """One row per field from columns ``prefix`` + field."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(prefix + f).alias(value)) for f in FIELDS])).alias("x")
    return rows.select(*keep, pairs).select(*keep, "x.field", f"x.{value}")


def outcomes(labels: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """key, field, label, pred, outcome for labels (key, g_field...) and predictions (key, field...)."""
    p = predictions.select(key, *[F.col(f).alias(f"p_{f}") for f in FIELDS], F.lit(True).alias("present"))
    both = labels.join(p, key, "left")
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"g_{f}").alias("label"), F.col(f"p_{f}").alias("pred")) for f in FIELDS])).alias("x")
    long = both.select(key, F.coalesce("present", F.lit(False)).alias("present"), pairs).select(key, "present", "x.*")
    return long.select(key, "field", "label", "pred", outcome(F.col("field"), F.col("pred"), F.col("label"), F.col("present")).alias("outcome"), ((F.col("label") != "") & F.col("label").isNotNull()).alias("has_label"))


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def scores(out: DataFrame) -> DataFrame:
    """tp, fp, fn, precision, recall and f1 of each field."""
    o = F.col("outcome")
    n = out.groupBy("field").agg(
        F.count_if(o == "OK").alias("tp"), F.count_if(o.isin("WRONG", "FP")).alias("fp"), F.count_if(o.isin("WRONG", "MISS") | ((o == "missing-json") & F.col("has_label"))).alias("fn")
    )
    p, r = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return n.withColumn("precision", p).withColumn("recall", r).withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
