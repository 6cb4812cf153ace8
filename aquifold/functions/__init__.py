"""Column helpers shared by the operators."""

from aquifold.functions.columns import as_double, drop_suspect, fixed, rounded, snap
from aquifold.functions.dates import AsOf, as_date, days_before, latest_date
from aquifold.functions.moments import with_moments
from aquifold.functions.windows import at_least, by_bore, newest_first, preceding, trailing

__all__ = [
    "AsOf", "as_date", "as_double", "at_least", "by_bore", "days_before", "drop_suspect",
    "fixed", "latest_date", "newest_first", "preceding", "rounded", "snap", "trailing",
    "with_moments",
]
