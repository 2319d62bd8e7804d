"""Column-expression guards shared by the operators.

All of these return ``Column`` expressions built from ``pyspark.sql.functions`` so
they stay inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den, default=None) -> Column:
    """``num / den`` when ``den`` is non-zero, else ``default`` (NULL by default).

    Spark's ANSI mode raises on division by zero and SQLite yields NULL; this keeps
    the SQLite result without an error.
    """
    num, den = col(num), col(den)
    out = F.when(den != 0, num / den)
    return out if default is None else out.otherwise(F.lit(default))


def div_if_positive(num, den, default=0.0) -> Column:
    """``CASE WHEN den > 0 THEN num * 1.0 / den ELSE default END`` (the SQL guard idiom)."""
    num, den = col(num), col(den)
    out = F.when(den > 0, num.cast("double") / den)
    return out.otherwise(F.lit(default)) if default is not None else out


def least_null(a, b) -> Column:
    """SQLite two-argument ``MIN(a, b)``: NULL if either argument is NULL."""
    a, b = col(a), col(b)
    return F.when(a.isNull() | b.isNull(), F.lit(None)).otherwise(F.least(a, b))


# Fixed value: the numeric prefix SQLite accepts when casting text to REAL.
SQLITE_REAL_PREFIX = r"^\s*([+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?)"


def sqlite_real(c) -> Column:
    """Emulate SQLite ``CAST(text AS REAL)``: numeric prefix, else 0.0; NULL stays NULL."""
    c = col(c).cast("string")
    num = F.regexp_extract(c, SQLITE_REAL_PREFIX, 1).try_cast("double")
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(F.coalesce(num, F.lit(0.0)))


def finite_or_null(c) -> Column:
    """NaN and +-infinity become NULL (pandas ``replace([inf,-inf], nan)`` + NaN as missing)."""
    c = col(c)
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None).cast("double")).otherwise(c)


def trim_or_empty(c) -> Column:
    """``COALESCE(TRIM(x), '')`` on any type (SQL TRIM strips spaces only)."""
    return F.coalesce(F.trim(col(c).cast("string")), F.lit(""))


def typed_null(dtype: str) -> Column:
    """A NULL literal with a concrete type (untyped NULL columns break the CSV writer)."""
    return F.lit(None).cast(dtype)


def fmt_amount(c) -> Column:
    """Label money as ``1.23M`` / ``4.56K`` / ``789`` (no UDF)."""
    c = col(c)
    return (F.when(c >= 1e6, F.format_string("%.2fM", c / 1e6))
             .when(c >= 1e3, F.format_string("%.2fK", c / 1e3))
             .otherwise(F.format_string("%.0f", c)))


CANON_OFFSET = 0.41421356237309515


def canon(c, sig: int = 10) -> Column:
    """Round a double to ``sig`` significant digits with plain IEEE arithmetic.

    Used only to compare results across engines: ``floor(x * 10^k + h) / 10^k`` gives
    the same double in Spark and DuckDB for the same input, unlike ``round`` whose tie
    rules differ. The offset ``h`` is irrational (sqrt(2) - 1) rather than 0.5: money
    built from two-decimal prices often sits exactly on a ``...5`` tie, where summation
    noise would pick the side; no decimal value sits on this boundary.
    """
    c = col(c)
    k = F.lit(sig - 1) - F.floor(F.log10(F.when(c == 0, F.lit(1.0)).otherwise(F.abs(c))))
    up = F.floor(c * F.pow(F.lit(10.0), k) + CANON_OFFSET) / F.pow(F.lit(10.0), k)
    down = F.floor(c / F.pow(F.lit(10.0), -k) + CANON_OFFSET) * F.pow(F.lit(10.0), -k)
    bad = c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")) | (c == 0)
    return F.when(bad, c).when(k >= 0, up).otherwise(down).cast("double")


def canon_sql(name: str, sig: int = 10) -> str:
    """DuckDB/ANSI text of :func:`canon` for column ``name``."""
    k = f"({sig - 1} - floor(log10(CASE WHEN {name} = 0 THEN 1.0 ELSE abs({name}) END)))"
    return (f"CASE WHEN {name} IS NULL OR isnan({name}) OR isinf({name}) OR {name} = 0 THEN {name} "
            f"WHEN {k} >= 0 THEN floor({name} * pow(10.0, {k}) + {CANON_OFFSET!r}) / pow(10.0, {k}) "
            f"ELSE floor({name} / pow(10.0, -{k}) + {CANON_OFFSET!r}) * pow(10.0, -{k}) END")
