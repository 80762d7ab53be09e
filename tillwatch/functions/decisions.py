"""Threshold and business rules on a scored transaction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decide(score: Column, review_at: float, decline_at: float,
           decline_rule: Column | None = None, review_rule: Column | None = None) -> Column:
    """``approve`` / ``manual_review`` / ``decline``; a rule can only make the outcome stricter."""
    never = F.lit(False)
    decline = (score >= decline_at) | F.coalesce(decline_rule if decline_rule is not None else never, never)
    review = ((score >= review_at) | score.isNull()
              | F.coalesce(review_rule if review_rule is not None else never, never))
    return F.when(decline, "decline").when(review, "manual_review").otherwise("approve")
