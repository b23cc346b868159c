"""Accuracy of findings against ground truth, by confidence threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netforensics.functions.lookup import literals
from netforensics.vocab import DOMAIN_KINDS


def flagged_by_threshold(findings: DataFrame) -> DataFrame:
    """Distinct (case_id, threshold, indicator) at confirmed, strong+ and any."""
    named = F.col("kind").isin(DOMAIN_KINDS) & (F.coalesce("destination_domain", F.lit("")) != "")
    indicator = F.when(named, F.col("destination_domain")).otherwise(F.col("dst_ip"))
    tier = F.col("confidence_tier")
    reached = (
        F.when(tier == "confirmed", literals(["confirmed", "strong+", "any"]))
        .when(tier == "strong", literals(["strong+", "any"]))
        .when(tier == "weak", literals(["any"]))
    )
    return (
        findings.filter(tier.isin("confirmed", "strong", "weak"))
        .select("case_id", F.explode(reached).alias("threshold"), indicator.alias("indicator"))
        .distinct()
    )


def case_outcomes(flagged: DataFrame, truth: DataFrame) -> DataFrame:
    """(case_id, threshold, tp, fp, fn, outcome) for every case of the ground truth."""
    cases = truth.groupBy("case_id").agg(F.max("is_malware").alias("is_malware"))
    grid = cases.withColumn("threshold", F.explode(literals(["confirmed", "strong+", "any"])))
    wanted = (
        truth.filter(F.col("indicator").isNotNull()).select("case_id", "indicator").distinct()
        .withColumn("threshold", F.explode(literals(["confirmed", "strong+", "any"])))
        .withColumn("_t", F.lit(1))
    )
    known = flagged.join(cases.select("case_id"), "case_id", "left_semi").withColumn("_f", F.lit(1))
    # NULL indicators count as flagged but can never be true.
    both = known.join(wanted, ["case_id", "threshold", "indicator"], "full_outer")
    f, t = F.col("_f").isNotNull(), F.col("_t").isNotNull()
    counts = both.groupBy("case_id", "threshold").agg(
        F.sum((f & t).cast("bigint")).alias("tp"), F.sum((f & ~t).cast("bigint")).alias("fp"),
        F.sum((~f & t).cast("bigint")).alias("fn"),
    )
    zero = F.lit(0).cast("bigint")
    return grid.join(counts, ["case_id", "threshold"], "left").select(
        "case_id", "threshold", "is_malware",
        *[F.coalesce(c, zero).alias(c) for c in ("tp", "fp", "fn")],
        F.when(F.coalesce("tp", zero) > 0, "HIT").otherwise("miss").alias("outcome"),
    )


def precision_recall(outcomes: DataFrame) -> DataFrame:
    """Totals with precision (1.0 when nothing was flagged) and recall (0.0 without truth)."""
    totals = outcomes.groupBy("threshold").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    flagged, wanted = F.col("tp") + F.col("fp"), F.col("tp") + F.col("fn")
    return totals.select(
        "threshold", "tp", "fp", "fn",
        F.when(flagged > 0, F.col("tp") / flagged).otherwise(1.0).alias("precision"),
        F.when(wanted > 0, F.col("tp") / wanted).otherwise(0.0).alias("recall"),
    )
