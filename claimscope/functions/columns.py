"""Column-level helpers shared by the operators (all JVM-side expressions)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: str | Column, den: str | Column) -> Column:
    """BigQuery ``SAFE_DIVIDE``: NULL when the denominator is 0 or NULL."""
    return F.try_divide(col_(num), col_(den))


def ratio_or_zero(num: str | Column, den: str | Column) -> Column:
    """precision/recall style ratio: 0.0 instead of NULL on an empty denominator."""
    return F.coalesce(F.try_divide(col_(num).cast("double"), col_(den).cast("double")), F.lit(0.0))


def flag_rate(c: str | Column) -> Column:
    """``AVG(CAST(flag AS FLOAT64))``."""
    return F.avg(col_(c).cast("double"))


def money_avg(c: str | Column) -> Column:
    """Average of a DECIMAL column as a double: exact sum / count (order independent)."""
    return F.sum(col_(c)).cast("double") / F.count(col_(c))


def money_avg_cents(c: str | Column) -> Column:
    """Mean of a non-negative DECIMAL (scale <= 4) rounded HALF_UP to cents, as double.

    Done on exact integers (ten-thousandths), so the result does not depend on
    float summation order or on how an engine rounds a binary double at .xx5.
    """
    if not isinstance(c, str):
        raise TypeError("money_avg_cents takes a column name")
    units = f"CAST(CAST(SUM({c}) AS DECIMAL(38,4)) * 10000 AS BIGINT)"
    return F.expr(f"CAST(({units} * 2 + COUNT({c}) * 100) div (COUNT({c}) * 200) AS DOUBLE) / 100.0")


def money_avg_cents_sql(c: str) -> str:
    """DuckDB form of ``money_avg_cents``."""
    units = f"CAST(CAST(SUM({c}) AS DECIMAL(38,4)) * 10000 AS BIGINT)"
    return f"CAST(({units} * 2 + COUNT({c}) * 100) // (COUNT({c}) * 200) AS DOUBLE) / 100.0"


def count_if(cond: Column) -> Column:
    return F.count_if(cond)


def reasons(*parts: tuple[Column, str]) -> Column:
    """Join the labels whose condition is true with ',' (NULL-free array filter)."""
    arr = F.array(*[F.when(c, F.lit(label)) for c, label in parts])
    return F.array_join(F.filter(arr, lambda x: x.isNotNull()), ",")


def round_doubles(df: DataFrame, digits: int = 6, cols: Iterable[str] | None = None) -> DataFrame:
    """Round double columns (for comparing order-dependent float sums across engines)."""
    names = set(cols) if cols is not None else None
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType) and (names is None or f.name in names):
            out.append(round_double(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def round_double(c: Column, digits: int) -> Column:
    """Round a double half away from zero at ``digits`` on its binary value:
    ``round(x * 10^d) / 10^d``.

    ``F.round(x, d)`` rounds the shortest decimal text of ``x``, so a non-dyadic
    value such as 56615.1271275 rounds up there but down in engines that scale
    first.  Scaling first, then rounding an exact .5 away from zero, then dividing
    gives the same double in Spark and in SQL engines that use this definition.
    """
    mod = float(10 ** digits)
    return F.round(c * F.lit(mod), 0) / F.lit(mod)


def typed_null(dtype: T.DataType | str) -> Column:
    return F.lit(None).cast(dtype)


def validate_names(names: Iterable[str]) -> list[str]:
    """Feature-contract check: identifier-like, unique, non-reserved names."""
    import re
    out = list(names)
    if not out:
        raise ValueError("feature list is empty")
    seen = set()
    for n in out:
        if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", n or ""):
            raise ValueError(f"unsafe feature name: {n!r}")
        if n in ("provider_id", "dataset_split"):
            raise ValueError(f"reserved column used as a feature: {n}")
        if n in seen:
            raise ValueError(f"duplicate feature: {n}")
        seen.add(n)
    return out


def pct2_expr(k: str, n: str, engine: str = "spark") -> str:
    """``ROUND(100 * k / n, 2)`` for non-negative integer k, n > 0, rounded HALF_UP exactly.

    Integer arithmetic, so both engines agree even at a .xx5 tie.  NULL when n = 0.
    """
    div = "div" if engine == "spark" else "//"
    return (f"CASE WHEN ({n}) = 0 THEN NULL ELSE CAST((CAST({k} AS BIGINT) * 20000 + ({n})) {div} "
            f"(2 * ({n})) AS DOUBLE) / 100.0 END")


def pct2(k: str, n: str) -> Column:
    return F.expr(pct2_expr(k, n, "spark"))


def attach_scalars(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Attach the columns of a 1-row frame (a global aggregate) to every row.

    The SQL form is ``LEFT JOIN (SELECT agg ...) ON TRUE``.  The right side is a
    global aggregate -- exactly one row by construction -- so it is broadcast and
    the join is a map-side projection, not a pairing of two data sets.
    """
    return df.crossJoin(F.broadcast(scalars))
