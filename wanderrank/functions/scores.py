"""Composite scores and weight rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values of the scoring rules ------------------------------------
# engagement = (5*book + 3*review + 1*like + 4*completed) / 13
ENGAGEMENT_WEIGHTS = {"book": 5, "review": 3, "like": 1, "completed": 4}
ENGAGEMENT_DIVISOR = 13.0
# popularity = .3*views + .4*unique visitors + .3*bookings
POPULARITY_WEIGHTS = {"views": 0.3, "unique": 0.4, "bookings": 0.3}
# adaptive weights (w_cf, w_cb): n < 5 -> (.2, .8); n < 20 -> (.5, .5); else (.7, .3)
WEIGHT_BANDS = [(5, 0.2, 0.8), (20, 0.5, 0.5)]
WEIGHT_DEFAULT = (0.7, 0.3)


def engagement_score(book: Column, review: Column, like: Column, completed: Column) -> Column:
    w = ENGAGEMENT_WEIGHTS
    return (book * w["book"] + review * w["review"] + like * w["like"]
            + completed * w["completed"]) / F.lit(ENGAGEMENT_DIVISOR)


def popularity_score(views: Column, unique: Column, bookings: Column) -> Column:
    w = POPULARITY_WEIGHTS
    z = F.lit(0)
    return (F.coalesce(views, z) * w["views"] + F.coalesce(unique, z) * w["unique"]
            + F.coalesce(bookings, z) * w["bookings"])


def adaptive_weights(n: Column) -> tuple[Column, Column]:
    """(w_cf, w_cb) by number of interactions ``n`` (null counts as 0)."""
    n = F.coalesce(n, F.lit(0))
    w_cf = w_cb = None
    for bound, cf, cb in WEIGHT_BANDS:
        w_cf = F.when(n < bound, cf) if w_cf is None else w_cf.when(n < bound, cf)
        w_cb = F.when(n < bound, cb) if w_cb is None else w_cb.when(n < bound, cb)
    return w_cf.otherwise(WEIGHT_DEFAULT[0]), w_cb.otherwise(WEIGHT_DEFAULT[1])
