"""Scores of works as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a role in the portfolio is worth.
ROLES = {"essential": 42, "core": 28, "strong": 16, "supporting": 5, "specialized": -6, "redundant": -45}
# Tokens from which size costs, cost of a doubling, further cost for a work that contains others.
SIZE_TOKENS, DOUBLING, CONTAINER_DOUBLING = 250_000, 6, 14


def role_weight(role: Column) -> Column:
    """The weight of a role, 0 for others."""
    out = F.lit(0)
    for name, weight in ROLES.items():
        out = F.when(role == name, weight).otherwise(out)
    return out


def doublings(tokens: Column) -> Column:
    """How often a size doubles the reference size, at least 0."""
    return F.greatest(F.lit(0.0), F.log2(F.greatest(tokens, F.lit(1)) / SIZE_TOKENS))


def static_utility(priority: Column, role: Column, relevance: Column, must: Column, creator_works: Column, rank: Column, tokens: Column, contains: Column, contained: Column, standalone: Column) -> Column:
    """The part of a work's utility that does not depend on what is selected already."""
    d = doublings(tokens)
    alone = F.when(~contained, 0).when(standalone == "high", 6).when(standalone == "low", -10).otherwise(0)
    terms = [
        priority, role_weight(role), F.greatest(F.lit(0), relevance - 70) * 0.18, F.when(must, 100).otherwise(0), 25 / F.sqrt(F.greatest(F.lit(1), creator_works)),
        -F.least(F.lit(24), F.greatest(F.lit(0), rank - 1) * 0.55), -DOUBLING * d, F.when(contains, -CONTAINER_DOUBLING * d).otherwise(0), alone,
    ]
    total = terms[0].cast("double")
    for term in terms[1:]:
        total = total + term
    return total
