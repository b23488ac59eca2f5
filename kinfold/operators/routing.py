"""Route property scores: escalate, audit, correct."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds and fallbacks.
CONFIDENCE_THRESHOLD = 75.0
SANITY_RATE = 0.10
GREY_FROM, GREY_TO = 3, 6
FALLBACK_SCORE, FALLBACK_CONFIDENCE = 5, 50.0

KEY = ["label", "key"]


def faulty_score(score: Column, confidence: Column, reasoning: Column) -> Column:
    ok = score.between(0, 10) & confidence.between(0, 100) & reasoning.isNotNull()
    return ~F.coalesce(ok, F.lit(False))


def checked_scores(scores: DataFrame) -> DataFrame:
    """(label, key, score, confidence, reasoning) with a ``faulty`` flag; faulty rows take the fallback."""
    return (
        scores.withColumn("faulty", faulty_score(F.col("score"), F.col("confidence"), F.col("reasoning")))
        .withColumn("score", F.when(F.col("faulty"), F.lit(FALLBACK_SCORE)).otherwise(F.col("score")))
        .withColumn(
            "confidence", F.when(F.col("faulty"), F.lit(FALLBACK_CONFIDENCE)).otherwise(F.col("confidence"))
        )
        .withColumn(
            "reasoning",
            F.when(F.col("faulty"), F.lit("Fallback assignment due to an unusable answer")).otherwise(F.col("reasoning")),
        )
    )


def checked_verdicts(verdicts: DataFrame) -> DataFrame:
    """(label, key, justified, revised, correction); an unusable verdict counts as justified."""
    ok = F.col("justified").isNotNull() & F.col("correction").isNotNull() & (
        F.col("revised").isNull() | F.col("revised").between(0, 10)
    )
    return verdicts.select(
        *KEY,
        F.when(ok, F.col("justified")).otherwise(F.lit(True)).alias("justified"),
        F.when(ok, F.col("revised")).alias("revised"),
        F.when(ok, F.col("correction")).otherwise(F.lit("Fallback due to an unusable verdict")).alias("correction"),
    )


def sampled(rate: float, seed: int = 0) -> Column:
    """Repeatable sample by a hash of the key."""
    return F.pmod(F.xxhash64(*KEY, F.lit(seed)), F.lit(10_000)) < int(rate * 10_000)


def audit_plan(
    scores: DataFrame,
    research: DataFrame,
    threshold: float = CONFIDENCE_THRESHOLD,
    sanity: Column | None = None,
) -> DataFrame:
    """Scores with escalation, the score before the audit, and whether to audit.

    ``research`` is (label, key, research_score, research_reasoning); its parts
    override one by one where not null, and only for escalated rows.
    """
    sanity = sampled(SANITY_RATE) if sanity is None else sanity
    escalated = F.col("confidence") < threshold
    found = scores.withColumn("escalated", escalated).join(research, KEY, "left")
    for name in ("research_score", "research_reasoning"):
        found = found.withColumn(name, F.when(F.col("escalated"), F.col(name)))
    return (
        found.withColumn("before_score", F.coalesce("research_score", "score"))
        .withColumn("before_reasoning", F.coalesce("research_reasoning", "reasoning"))
        .withColumn("grey", F.col("before_score").between(GREY_FROM, GREY_TO))
        .withColumn("judged", F.col("grey") | (~F.col("grey") & sanity))
    )


def audit(plan: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Full audit row per property with the final score and rationale."""
    ruled = plan.join(verdicts, KEY, "left")
    # An audited row whose verdict never came counts as justified.
    justified = F.when(F.col("judged"), F.coalesce("justified", F.lit(True)))
    overruled = F.col("judged") & ~F.coalesce(justified, F.lit(True))
    return ruled.select(
        *KEY,
        "score",
        "confidence",
        "reasoning",
        "escalated",
        "research_score",
        "research_reasoning",
        "before_score",
        "before_reasoning",
        "judged",
        justified.alias("justified"),
        F.when(F.col("judged"), F.col("correction")).alias("correction"),
        F.when(overruled, F.coalesce("revised", "before_score")).otherwise(F.col("before_score")).alias("final_score"),
        F.when(
            overruled,
            F.concat(
                "before_reasoning", F.lit(" | Corrected by Judge: "), F.coalesce("correction", F.lit(""))
            ),
        )
        .otherwise(F.col("before_reasoning"))
        .alias("final_rationale"),
    )


def route_scores(
    scores: DataFrame,
    research: DataFrame,
    verdicts: DataFrame,
    threshold: float = CONFIDENCE_THRESHOLD,
    sanity: Column | None = None,
) -> DataFrame:
    return audit(audit_plan(scores, research, threshold, sanity), verdicts)
