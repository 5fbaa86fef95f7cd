"""Numbers and decisions: similarity of neighbouring pages, confidence triggers, resolutions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The labels a page can have, and the weights and limits used unless others are given.
CATEGORIES = (
    "mortgage_closing_disclosure_seller", "lender_rate_note", "title_rider",
    "property_tax_record_information_sheet", "title_signature_name_affidavit_ack", "other",
)
OTHER = "other"
WEIGHTS = (0.60, 0.25, 0.15)
MIN_EMBEDDING, EDGE_THRESHOLD = 0.60, 0.78


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Clamped to [-1, 1]; null for a null vector, an error for a zero one."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot(a, b) / norms))


def unit_interval(x: Column) -> Column:
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)))


def category_score(left: Column, left_conf: Column, right: Column, right_conf: Column) -> Column:
    """Null if either is missing, 0 if they differ, else the lower confidence."""
    return F.when(left.isNull() | right.isNull(), None).when(left != right, F.lit(0.0)).otherwise(F.least(left_conf, right_conf))


def page_number_score(left: Column, right: Column) -> Column:
    """1 for the next number, 0.5 for the same one, else null: no evidence."""
    return F.when(right == left + 1, F.lit(1.0)).when(right == left, F.lit(0.5))


def available_weight(category: Column, numbers: Column, weights=WEIGHTS) -> Column:
    e, c, p = weights
    return F.lit(e) + F.when(category.isNotNull(), F.lit(c)).otherwise(0.0) + F.when(numbers.isNotNull(), F.lit(p)).otherwise(0.0)


def combine(embedding: Column, category: Column, numbers: Column, weights=WEIGHTS) -> Column:
    """Mean of the scores there are, by weight; null without any weight."""
    if min(weights) < 0 or not sum(weights):
        raise ValueError("weights must not be negative, nor all zero")
    e, c, p = weights
    total = F.lit(e) * embedding + F.coalesce(F.lit(c) * category, F.lit(0.0)) + F.coalesce(F.lit(p) * numbers, F.lit(0.0))
    available = available_weight(category, numbers, weights)
    return F.when(available > 0, total / available)


def margin(probabilities: Column) -> Column:
    """Highest less second highest value of a map."""
    ordered = F.sort_array(F.map_values(probabilities), asc=False)
    return F.get(ordered, F.lit(0)) - F.get(ordered, F.lit(1))


def trigger_reasons(category: Column, confidence: Column, gap: Column, min_confidence: float = 0.5, min_margin: float = 0.5) -> Column:
    """Why a page needs a second opinion, in fixed order; none without a category."""
    found = F.array_compact(F.array(F.when(confidence < min_confidence, F.lit("low confidence")), F.when(gap < min_margin, F.lit("low margin"))))
    return F.when(category.isNull(), F.array().cast("array<string>")).otherwise(found)


def resolution(triggered: Column, first: Column, second: Column, error: Column | None = None) -> Column:
    failed = F.lit(False) if error is None else error.isNotNull()
    return (
        F.when(~triggered, F.lit("not_triggered"))
        .when(failed, F.lit("verifier_failed"))
        .when(first != second, F.lit("disagreement"))
        .when(first == OTHER, F.lit("mutual_other"))
        .otherwise(F.lit("accepted"))
    )


def reviewed(outcome: Column, needs_review: Column, reason: Column) -> tuple[Column, Column]:
    """(needs_review, review_reason) after the second opinion: agreement clears a flag, anything else sets one."""
    flag = F.when(outcome == "not_triggered", needs_review).otherwise(outcome != "accepted")
    why = (
        F.when(outcome == "not_triggered", reason)
        .when(outcome == "mutual_other", F.lit("other"))
        .when(outcome == "disagreement", F.lit("verifier disagreement"))
        .when(outcome == "verifier_failed", F.lit("verifier failed"))
    )
    return flag, why


def initial_review(category: Column, confidence: Column, min_confidence: float = 0.5) -> Column:
    """Reason for a first review, null for none: low confidence comes before other."""
    return F.when(confidence < min_confidence, F.lit("low confidence")).when(category == OTHER, F.lit("other"))
