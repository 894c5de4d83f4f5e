"""Safe casts, rounding and calendar helpers as Spark SQL expressions.

Spark and the engine that fixed the expected results differ in small ways (text to integer,
half-even casts, decimal rounding). The forms here give the expected results, are built-in
expressions throughout and stay inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text is checked before it is cast: a failing try_cast raises and catches an exception per
# cell, which costs more than reading the row. Java's own notations ('1.5d') are no numbers.
_NUMBER = r"r'(?i)^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|nan|inf(?:inity)?)\s*$'"
_INTEGER = r"r'^\s*[+-]?\d{1,18}\s*$'"


def exprs(*texts: str) -> list[Column]:
    return [F.expr(t) for t in texts]


def _type_of(df: DataFrame, name: str) -> T.DataType:
    for f in df.schema.fields:
        if f.name.lower() == name.lower():
            return f.dataType
    raise KeyError(name)


def to_double(expr: str, dtype: T.DataType) -> str:
    if isinstance(dtype, T.StringType):
        return f"CASE WHEN {expr} RLIKE {_NUMBER} THEN try_cast({expr} AS DOUBLE) END"
    return f"try_cast({expr} AS DOUBLE)"


def to_long(expr: str, dtype: T.DataType) -> str:
    """Integers: text rounds half up ('2.5' is 3), floating point rounds half even (2.5 is 2)."""
    if isinstance(dtype, T.IntegralType):
        return f"CAST({expr} AS BIGINT)"
    if isinstance(dtype, T.StringType):
        return (f"CASE WHEN {expr} RLIKE {_INTEGER} THEN CAST({expr} AS BIGINT) "
                f"ELSE try_cast(round({to_double(expr, dtype)}) AS BIGINT) END")
    return f"try_cast(bround(try_cast({expr} AS DOUBLE)) AS BIGINT)"


def to_timestamp(expr: str, dtype: T.DataType) -> str:
    """A timestamp must start with a full calendar date: '2023' and '2023-01' are none."""
    if isinstance(dtype, T.StringType):
        return (f"CASE WHEN locate('-', trim({expr}), 7) > 0 "
                f"THEN try_cast({expr} AS TIMESTAMP_NTZ) END")
    return f"try_cast({expr} AS TIMESTAMP_NTZ)"


def read_as(df: DataFrame, name: str, kind: str) -> str:
    """Column ``name`` of ``df`` read as ``kind``; a cell that cannot be read is NULL."""
    expr, dtype = f"`{name}`", _type_of(df, name)
    if kind == "bigint":
        return to_long(expr, dtype)
    if kind == "double":
        return to_double(expr, dtype)
    if kind == "timestamp_ntz":
        return to_timestamp(expr, dtype)
    return f"CAST({expr} AS STRING)"


def rounded(expr: str, digits: int) -> str:
    scale = f"{10 ** digits}D"
    return f"(round(({expr}) * {scale}) / {scale})"


def rounded_decimal(expr: str, digits: int) -> str:
    """The double nearest to the value's exact decimal expansion cut to ``digits`` places, ties to even.

    ``rounded`` multiplies first, so that 2.675 (really 2.67499...) becomes 2.68; here the error of that
    product decides whenever the product ends in one half. Scales up to 10**11 have few enough binary
    digits for the error to be exact. From 2**53 on a double has no digit left to round.
    """
    if not 0 <= digits <= 11:
        raise ValueError(f"{digits} digits")
    scale = f"{10 ** digits}D"
    p = f"(_r * {scale})"
    high, low = _halves("_r")
    error = f"(({high} * {scale} - {p}) + {low} * {scale})"
    whole = (f"CASE WHEN {p} - floor({p}) = 0.5D AND {error} <> 0D "
             f"THEN floor({p}) + IF({error} > 0D, 1D, 0D) ELSE rint({p}) END")
    return (f"transform(array(CAST({expr} AS DOUBLE)), _r -> "
            f"CASE WHEN abs({p}) < 9007199254740992D THEN {whole} / {scale} ELSE _r END)[0]")


def _halves(x: str) -> tuple[str, str]:
    """A double as the sum of two with half the digits, so that products of them are exact."""
    high = f"(134217729D * {x} - (134217729D * {x} - {x}))"
    return high, f"({x} - {high})"


def interpolated(low: str, high: str, weight: str) -> str:
    """``low * (1 - weight) + high * weight`` with one rounding for the first product and sum.

    A quantile is published with two decimals, so a value that lies half way between two of
    them must come out as the fused multiply-add of the expected results leaves it. The
    rounding error of the product and of the sum are computed and added back.
    """
    rest = f"(1D - {weight})"
    a, b = f"({low} * {rest})", f"({high} * {weight})"
    (xh, xl), (yh, yl) = _halves(low), _halves(rest)
    product_error = f"((({xh} * {yh} - {a}) + {xh} * {yl} + {xl} * {yh}) + {xl} * {yl})"
    s = f"({a} + {b})"
    sum_error = f"(({a} - ({s} - ({s} - {a}))) + ({b} - ({s} - {a})))"
    return f"({s} + ({sum_error} + {product_error}))"


def seconds_between(start: str, end: str) -> str:
    """Elapsed seconds with microseconds, independent of the session time zone."""
    return f"CAST(CAST(CAST({end} - {start} AS INTERVAL SECOND) AS DECIMAL(18,6)) AS DOUBLE)"


def ratio(part: str, whole: str) -> str:
    """Quotient of two counts as a double, NULL over zero."""
    return f"try_divide(CAST({part} AS DOUBLE), CAST({whole} AS DOUBLE))"


def share(condition: str) -> str:
    """Share of rows for which a condition is true; a row where it is NULL does not count as one."""
    return f"avg(CASE WHEN {condition} THEN 1D ELSE 0D END)"


def period_start(label: str, unit: str) -> str:
    """First day of the period a label such as 2023-01 (month) or 2024-01-01 (week) names."""
    return f"to_date(concat({label}, '-01'))" if unit == "month" else f"to_date({label})"


def period_label(ts: str, unit: str) -> str:
    shape = "yyyy-MM" if unit == "month" else "yyyy-MM-dd"
    return f"date_format(trunc(CAST({ts} AS DATE), '{unit}'), '{shape}')"
