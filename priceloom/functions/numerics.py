"""Column helpers shared by every operator.

All helpers return ``Column`` expressions, so they stay inside whole-stage
codegen.  The DuckDB oracle (``priceloom.plans.oracle``) spells the same
arithmetic in SQL, operation for operation, so both engines produce the same
doubles.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r(c: ColumnOrName, n: int = 2) -> Column:
    """Round half-to-even on ``x * 10**n`` (pandas ``.round(n)`` semantics).

    ``F.round`` rounds half-up on the decimal expansion and differs from the
    pandas / NumPy results on ties; ``rint`` matches them.
    """
    scale = float(10 ** n)
    return F.rint(col(c) * F.lit(scale)) / F.lit(scale)


def exact_sum(c: ColumnOrName, scale: int = 2, weight: ColumnOrName | None = None) -> Column:
    """Exact sum of a column holding ``scale``-decimal values, as
    DECIMAL(28, scale), the type ``SUM(CAST(c AS DECIMAL(18, scale)))`` has.

    Each value is read as a whole number of 10^-scale units and the units are
    summed as LONG: primitive adds in the aggregation buffer, where a
    DECIMAL(28) buffer boxes a BigDecimal on every update (about 2.5x slower
    per aggregate).  The total turns back into a decimal once per group.  For
    values already at ``scale`` decimals (every cleaned money column),
    ``rint(x * 10^scale)`` is exactly the decimal cast's unscaled value.
    Integer sums are exact, so the total does not depend on partitioning or
    task order; under ANSI mode a sum beyond 9.2e18 units fails instead of
    wrapping.  ``weight`` (an integer column) multiplies each value's units
    first: ``SUM(x * w)`` for a value repeated ``w`` times.
    """
    units = F.rint(col(c) * F.lit(float(10 ** scale))).cast("long")
    if weight is not None:
        units = units * col(weight).cast("long")
    step = F.lit(Decimal(1).scaleb(-scale))
    return (F.sum(units).cast("decimal(20,0)") * step).cast(f"decimal(28,{scale})")


def money_sum(c: ColumnOrName, scale: int = 2) -> Column:
    """``exact_sum`` as DOUBLE."""
    return exact_sum(c, scale).cast("double")


def exact_avg(c: ColumnOrName, scale: int = 2) -> Column:
    """Average of a fixed-scale column: exact decimal sum over count."""
    return F.try_divide(money_sum(c, scale), F.count(col(c)).cast("double"))


def safe_div(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``a / b`` with NULL on a zero or NULL denominator (SQLite semantics)."""
    return F.try_divide(col(a), col(b))


def pct(a: ColumnOrName, b: ColumnOrName, n: int = 2) -> Column:
    """``r((a / b) * 100, n)``; NULL when ``b`` is 0."""
    return r(safe_div(a, b) * F.lit(100.0), n)


def pct_change(new: ColumnOrName, old: ColumnOrName, n: int = 2) -> Column:
    """``r(((new - old) / old) * 100, n)``; NULL when ``old`` is 0 or NULL."""
    return r(safe_div(col(new) - col(old), col(old)) * F.lit(100.0), n)


def guarded(value: Column, cond: Column, otherwise: float = 0.0) -> Column:
    """``np.where(cond, value, otherwise)`` (NULL condition takes ``otherwise``)."""
    return F.when(cond, value).otherwise(F.lit(otherwise))


def clip(c: ColumnOrName, lower: float | None = None, upper: float | None = None) -> Column:
    """pandas ``clip``: bounds values, keeps NULL as NULL; NaN is missing, so NULL.

    ``greatest(NULL, lo)`` returns ``lo`` in Spark, which would invent values
    for missing data, so this is spelled with ``when``.
    """
    x = F.nullif(col(c), F.lit(float("nan")))
    out = x
    if lower is not None:
        out = F.when(x < F.lit(lower), F.lit(lower)).otherwise(out)
    if upper is not None:
        out = F.when(x > F.lit(upper), F.lit(upper)).otherwise(out)
    return out


def strip(c: ColumnOrName) -> Column:
    """Python ``str.strip`` on ASCII white space: tabs and newlines as well."""
    return F.btrim(col(c), F.lit(" \t\n\x0b\x0c\r"))


def is_true(cond: Column) -> Column:
    """NULL-safe truth test: a NULL comparison counts as False (pandas masks)."""
    return F.coalesce(cond, F.lit(False))


_PLAIN_WORDS = "^ *(?:[A-Za-z]+[0-9#]*(?: +|$))*$"


def title_case(c: ColumnOrName) -> Column:
    """Python ``str.title``: upper-case a letter that follows a non-letter,
    lower-case every other letter.

    ``initcap`` only restarts a word after white space (``men's`` -> ``Men's``
    where Python gives ``Men'S``).  Runs JVM-side over the character array,
    at some 30 microseconds a text; words of ASCII letters, digits behind
    them or not, are the same either way and left to ``initcap``.
    """
    chars = F.split(col(c), "")

    def fix(ch: Column, i: Column) -> Column:
        prev = F.element_at(chars, i)  # 1-based: element i is the previous char
        prev_is_letter = (i > 0) & prev.rlike(r"^\p{L}$")
        return F.when(prev_is_letter, F.lower(ch)).otherwise(F.upper(ch))

    return F.when(col(c).isNull(), F.lit(None).cast("string")).when(
        col(c).rlike(_PLAIN_WORDS), F.initcap(col(c))).otherwise(F.array_join(F.transform(chars, fix), ""))


# Coefficients of the Chebyshev-fitted complementary error
# function (Numerical Recipes, erfcc), fractional error below 1.2e-7.
_ERFC_COEFFS = (
    -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
    0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277,
)


def erfc_nonneg(z: ColumnOrName) -> Column:
    """``erfc(z)`` for ``z >= 0`` as a JVM expression (Spark has no erf)."""
    zc = col(z)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * zc)
    poly = F.lit(_ERFC_COEFFS[-1])
    for coef in reversed(_ERFC_COEFFS[:-1]):
        poly = F.lit(coef) + t * poly
    return t * F.exp(-zc * zc + poly)


def erfc_py(z: float) -> float:
    """Same polynomial in plain Python, for tests."""
    t = 1.0 / (1.0 + 0.5 * z)
    poly = _ERFC_COEFFS[-1]
    for coef in reversed(_ERFC_COEFFS[:-1]):
        poly = coef + t * poly
    return t * math.exp(-z * z + poly)


def two_sided_p(t_stat: ColumnOrName) -> Column:
    """Normal two-sided p-value ``erfc(|t| / sqrt 2)``."""
    return erfc_nonneg(F.abs(col(t_stat)) / F.lit(math.sqrt(2.0)))


def portfolio_sum(value: Column) -> Column:
    """Sum of one-row-per-product amounts as DOUBLE: whole cents are added
    exactly, in any order; amounts beyond DECIMAL(18,2), which an extreme
    fit can give, are added as DOUBLE instead of failing the report."""
    cents = value.try_cast("decimal(18,2)")
    beyond = F.sum(F.when(cents.isNull(), value))
    exact = F.sum(cents).cast("double")
    return F.when(exact.isNull(), beyond).otherwise(exact + F.coalesce(beyond, F.lit(0.0)))
