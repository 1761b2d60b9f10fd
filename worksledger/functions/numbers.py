"""Arithmetic, rounding, classes and order-independent sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {"billion": 1e9, "million": 1e6, "thousand": 1e3, "one": 1.0}


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def coalesce_zero(col: Column | str) -> Column:
    return F.coalesce(_col(col).cast("double"), F.lit(0.0))


def cost_variance(cost: Column | str, budget: Column | str) -> Column:
    """Cost minus budget, each taken as 0 when missing."""
    return coalesce_zero(cost) - coalesce_zero(budget)


def round_half(col: Column | str, n: int) -> Column:
    """Round half away from zero on the binary value.

    Spark's two-argument ``round`` works on the shortest decimal text, so 1.005
    becomes 1.01; scaling first keeps the value the double really holds (1.0).
    """
    scale = float(10**n)
    c = _col(col).cast("double")
    return F.round(c, 0) if n == 0 else F.round(c * scale, 0) / scale


def safe_ratio(num: Column | str, den: Column | str, scale: int = 4) -> Column:
    """Rounded ``num / den`` where the denominator is positive, else NULL."""
    d = _col(den).cast("double")
    return F.when(d > 0, round_half(_col(num).cast("double") / d, scale))


def percent(part: Column | str, whole: Column | str, scale: int) -> Column:
    """Rounded share in per cent; NULL when there is nothing to divide by."""
    w = _col(whole)
    return F.when(w > 0, round_half(_col(part) / w * 100, scale))


def bucketize(
    col: Column | str,
    classes: Sequence[tuple[float, str]],
    above: str,
    unknown: str,
) -> Column:
    """Label by the first exclusive upper bound that exceeds the value.

    NULL and 0 are ``unknown``; whatever reaches the last bound is ``above``.
    """
    c = _col(col)
    label = F.when(c.isNull() | (c == 0), F.lit(unknown))
    for bound, name in classes:
        label = label.when(c < bound, F.lit(name))
    return label.otherwise(F.lit(above))


def to_int(col: Column | str) -> Column:
    """Integer cast that rounds half to even (a plain Spark cast truncates)."""
    return F.rint(_col(col).cast("double")).cast("int")


def scale_units(col: Column | str, unit: str) -> Column:
    return _col(col) / _UNITS[unit]


# A sum is kept in digits of 24 bits. The lowest is worth 2**-96, and eight of them reach
# 2**96 (8e28). Digits are summed as bigint, which holds for 1e12 rows a group.
_WIDTH = 24
_LOWEST = -96
_DIGITS = 8
_TINY = 2.0 ** (_LOWEST + 53)  # below it a value can have bits under the lowest digit
_HUGE = 2.0 ** (_LOWEST + _WIDTH * _DIGITS)
_ODD = "odd"  # the sum of tiny and huge values
_COUNT = "count"
_PARTS = [*(f"s{k}" for k in range(_DIGITS)), _ODD, _COUNT]

# The expressions are written as SQL: built call by call, one sum would take half a second.


def _name(col: str) -> str:
    return "`" + col.replace("`", "``") + "`"


def _power(exponent: int) -> str:
    return f"{2.0**exponent!r}D"


def _split(col: str) -> dict[str, str]:
    """Aggregates of a column: its signed digits, lowest first, what is tiny or huge, and its values.

    A digit is the value in units of its own bit less that in units of the next digit,
    both rounded to integers. All steps are exact: they scale by powers of two, or
    subtract neighbours.
    """
    c = f"CAST({_name(col)} AS DOUBLE)"
    usual = f"coalesce(abs({c}) < {_HUGE!r}D AND (abs({c}) >= {_TINY!r}D OR {c} = 0), false)"
    value = f"IF({usual}, {c}, 0D)"
    units = [f"rint({value} * {_power(-(_LOWEST + _WIDTH * k))})" for k in range(_DIGITS)]
    above = [*(f"{u} * {_power(_WIDTH)}" for u in units[1:]), "0D"]
    parts = [f"sum(CAST({u} - {a} AS BIGINT))" for u, a in zip(units, above)]
    odd = f"sum(IF({c} IS NULL OR {usual}, 0D, {c}))"
    return dict(zip(_PARTS, [*parts, odd, f"count({c})"]))


def _carried(sums: Sequence[str]) -> str:
    """Array of the digits, carried: from 0 to 2**24 - 1, lowest first, the last two of the carry."""
    held, out = "", []
    for s in sums:
        held = f"({s} + shiftright({held}, {_WIDTH}))" if held else s
        out.append(f"{held} & {(1 << _WIDTH) - 1}L")
    return f"array({', '.join(out)}, shiftright({held}, {_WIDTH}) & {(1 << _WIDTH) - 1}L, shiftright({held}, {2 * _WIDTH}))"


def _bound(value: str, name: str, use: str) -> str:
    """use, in which name stands for the value, computed once."""
    return f"transform(array({value}), {name} -> {use})[0]"


def _nearest(sums: str) -> str:
    """The double nearest to an array of summed digits; ties to even."""
    at = [f"x[{k}]" for k in range(_DIGITS)]
    # the first four digits that are not zero hold 73 bits or more; what follows only breaks ties
    digit = [f"element_at(d, k - {n} + 1)" for n in range(4)]
    upper = f"CAST({digit[0]} * {1 << _WIDTH}L + {digit[1]} AS DECIMAL(16,0)) * {1 << (2 * _WIDTH + 1)}BD"
    rest = "IF(exists(slice(d, 1, k - 3), y -> y != 0), 1L, 0L)"
    lower = f"CAST(2L * ({digit[2]} * {1 << _WIDTH}L + {digit[3]}) + {rest} AS DECIMAL(16,0))"
    # digit k - 3 behind three zeros is worth 2 ** (lowest + 24 * (k - 6)), and the whole is doubled
    rounded = f"CAST({upper} + {lower} AS DOUBLE) * pow(2D, {_LOWEST - 1} + {_WIDTH} * (k - 6))"
    first = "greatest(array_max(transform(d, (y, i) -> IF(y != 0, i, 0))), 3)"
    value = _bound(f"concat(array(0L, 0L, 0L), {_carried([f'{x} * z' for x in at])})", "d", _bound(first, "k", rounded))
    sign = f"IF({_carried(at)}[{_DIGITS + 1}] < 0, -1L, 1L)"
    return _bound(sums, "x", _bound(sign, "z", f"z * {value}"))


def _joined(parts: dict[str, str]) -> str:
    exact = _nearest(f"array({', '.join(parts[f's{k}'] for k in range(_DIGITS))})")
    return f"IF({parts[_COUNT]} > 0, {exact} + {parts[_ODD]}, CAST(NULL AS DOUBLE))"


def exact_sum(col: str) -> Column:
    """Sum of a double column that does not depend on the order of rows.

    A double sum changes in its last digits with the partitioning, which shows once totals
    are rounded to cents. Here no value is rounded: each is cut into digits of 24 bits at
    fixed exponents, which are summed as ``bigint`` in generated code and carried once per
    group; the result is the double nearest to the true sum, whatever signs and sizes are
    mixed. That holds for values from 1e-13 to 8e28 (and 0); smaller and larger ones,
    infinities and NaN are added as doubles.
    """
    return F.expr(_joined(_split(col)))


def exact_avg(col: str) -> Column:
    """``exact_sum`` over the number of non-null values; NULL for none."""
    return exact_sum(col) / F.count(col)


def sum_parts(col: str) -> list[Column]:
    """Aggregates of a first grouping, from which a coarser one takes its sum.

    ``merged_sum(col)`` and ``merged_avg(col)`` over these equal ``exact_sum(col)``
    and ``exact_avg(col)`` over the rows themselves.
    """
    return [F.expr(part).alias(f"{col}_{name}") for name, part in _split(col).items()]


def merged_sum(col: str) -> Column:
    return F.expr(_joined({name: f"sum({_name(f'{col}_{name}')})" for name in _PARTS}))


def merged_avg(col: str) -> Column:
    return merged_sum(col) / F.sum(f"{col}_{_COUNT}")
