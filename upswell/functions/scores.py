"""Score expressions; each gives a whole number from 0 to 100."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from upswell import config as C
from upswell.functions.text import is_populated


def clamp(c: Column) -> Column:
    """Round half to even, then keep inside 0..100."""
    return F.greatest(F.lit(0), F.least(F.lit(100), F.bround(c).cast("int")))


def age_days(event_date: Column, now: Column) -> Column:
    """Days since a date: a future date counts as today, a missing one as very old."""
    return F.greatest(F.lit(0), F.coalesce(F.datediff(now, event_date), F.lit(C.MISSING_AGE_DAYS)))


def decayed(base: Column, age: Column, half_life: float) -> Column:
    if half_life <= 0:
        raise ValueError("half_life must be > 0")
    return base * F.exp(-age / F.lit(float(half_life)))


def event_base(event_type: Column) -> Column:
    """Base value of an event type; types without one are worth 0."""
    pairs = [F.lit(x) for t, base, _ in C.EVENT_VALUES for x in (t, base)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), event_type), F.lit(0))


def component_types(component: str) -> list[str]:
    return [t for t, _, c in C.EVENT_VALUES if c == component]


def is_countable(event_type: Column, status: Column, types: Sequence[str]) -> Column:
    return F.coalesce(status.isin(C.COUNTABLE_STATUSES) & event_type.isin(list(types)), F.lit(False))


def hiring_momentum(status: Column, confidence: Column) -> Column:
    pairs = [F.lit(x) for kv in C.HIRING_BASE.items() for x in kv]
    base = F.coalesce(F.try_element_at(F.create_map(*pairs), F.coalesce(status, F.lit("unknown"))), F.lit(0))
    return clamp(base * (F.coalesce(confidence, F.lit(0)) / F.lit(100.0)))


def moat(confidence: Column) -> Column:
    return clamp(F.coalesce(confidence, F.lit(0)).cast("double"))


def corroboration(sources: Column) -> Column:
    n = F.coalesce(sources, F.lit(0))
    return F.when(n <= 0, 0).when(n == 1, 40).when(n == 2, 80).otherwise(100)


def completeness(columns: Sequence[str]) -> Column:
    """Share of the named columns that hold a real value."""
    if not columns:
        return F.lit(0)
    filled = sum((is_populated(F.col(c)).cast("int") for c in columns[1:]), is_populated(F.col(columns[0])).cast("int"))
    return F.bround(100 * filled / F.lit(len(columns))).cast("int")


def data_confidence(
    tier: Column,
    sources: Column,
    days_since_verified: Column,
    field_completeness: Column,
    resolution: Sequence[Column],
    extraction: Column,
    contradicted: Column | None = None,
) -> Column:
    w = C.CONFIDENCE_WEIGHTS
    tier_pts = F.when(tier == 1, 100.0).when(tier == 2, 65.0).when(tier == 3, 30.0).otherwise(0.0)
    n = F.coalesce(sources, F.lit(0))
    corro_pts = F.when(n <= 0, 0.0).when(n == 1, 50.0).when(n == 2, 80.0).otherwise(100.0)
    span = float(C.STALE_EXCLUDE_DAYS - C.STALE_WARN_DAYS)
    d = days_since_verified
    fresh_pts = (
        F.when(d.isNull(), 0.0)
        .when(d <= C.STALE_WARN_DAYS, 100.0)
        .when(d >= C.STALE_EXCLUDE_DAYS, 0.0)
        .otherwise(100.0 * (1 - (d - C.STALE_WARN_DAYS) / F.lit(span)))
    )
    zero = F.lit(0.0)
    known = sum((c.isNotNull().cast("int") for c in resolution), F.lit(0))
    total = sum((F.coalesce(c.cast("double"), zero) for c in resolution), zero)
    resolution_pts = F.when(known == 0, zero).otherwise(total / known)
    score = (
        tier_pts * w["source_tier"]
        + corro_pts * w["corroboration"]
        + fresh_pts * w["freshness"]
        + field_completeness.cast("double") * w["completeness"]
        + resolution_pts * w["resolution_confidence"]
        + F.coalesce(extraction.cast("double"), zero) * w["extraction_confidence"]
    )
    if contradicted is not None:
        score = F.when(contradicted, score * 0.7).otherwise(score)
    return clamp(score)


def percent(part: Column, whole: Column) -> Column:
    """Percentage with one decimal; an empty whole counts as one."""
    return F.bround(100.0 * part / F.greatest(whole, F.lit(1)), 1)
