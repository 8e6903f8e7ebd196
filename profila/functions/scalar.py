"""Scalar column expressions.

Each returns a ``Column`` built from ``pyspark.sql.functions`` only, so the
expressions stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word-token pattern of the vectorisers: lower-cased runs of two or more
# word characters (Unicode), so one-character tokens (one-digit app ids)
# vanish.  Fixed value but for the least length.
TOKEN_PATTERN = r"(?U)\b\w{%d,}\b"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tag_count(tag_list) -> Column:
    """number of tags = commas + 1; NULL list → NULL."""
    t = _c(tag_list)
    return (F.length(t) - F.length(F.replace(t, F.lit(","), F.lit(""))) + 1).cast("int")


def safe_div(a, b) -> Column:
    """a / b with a zero or missing divisor giving NULL (never
    Infinity or NaN, which the tree learners reject)."""
    return _c(a).cast("double") / F.nullif(_c(b).cast("double"), F.lit(0.0))


def round6(x) -> Column:
    return F.round(_c(x).cast("double"), 6)


def bround6(x, scale: int = 6) -> Column:
    """half-even rounding as the stack artefacts are written."""
    return F.bround(_c(x).cast("double"), scale)


def sigmoid(margin) -> Column:
    """probability of the positive class from a raw margin."""
    return 1.0 / (1.0 + F.exp(-_c(margin)))


def threshold(p, cut: float = 0.5) -> Column:
    """P10: probability → 0/1 label."""
    return (_c(p) >= cut).cast("int")


def word_tokens(text, min_len: int = 2) -> Column:
    """Lower-case word tokens of ``min_len`` or more characters."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(TOKEN_PATTERN % min_len), 0)
