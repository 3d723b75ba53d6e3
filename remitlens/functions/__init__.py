"""Column helpers: surrogate key, exact rounding of ratios."""

from remitlens.functions.keys import surrogate_key
from remitlens.functions.numeric import percent, round_ratio

__all__ = ["surrogate_key", "percent", "round_ratio"]
