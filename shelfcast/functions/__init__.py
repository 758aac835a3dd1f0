"""Scalar / aggregate column helpers (all built-in Spark expressions)."""

from .labels import event_label, lifecycle_bucket, price_move  # noqa: F401
from .numeric import (  # noqa: F401
    avg_money_rounded,
    avg_rounded,
    clip_lower,
    clip_upper,
    idiv,
    money_rounded,
    money_sum,
    money_units,
    pct_rounded,
    round_ratio,
    safe_div,
)
