"""Aggregates that round once, at the end, and alike for every partitioning.

``ROUND(AVG(x), 2)`` on doubles depends on summation order and on how a binary fraction looks
at a half-cent tie. Here values become DECIMAL(28,10) one by one (exact for up to ten
decimals; NaN, infinities and values of 10**18 and more don't fit and are left out like nulls,
also of the count), are summed exactly, and the quotient is rounded half-up, away from zero,
in integers: ``(2 * |sum| + count) div (2 * count)`` in units of the last digit.

Over many rows, sums run over long columns instead of wide decimals. ``with_limbs`` adds, for each
value, five of them: ``x = (i2 * 2**40 + i1 * 2**20 + i0) + (f1 * 2**17 + f0) / 10**10``, all but
``i2`` small and not negative, so no sum of theirs overflows below 2**42 rows;
``avg_of_limbs`` and ``sum_of_limbs`` settle the carries once for each group and give what
``avg_round`` and ``sum_round`` do. Nearly all values have four decimals at most, which two
operations on doubles tell and prove: ``k = rint(x * 10**4)`` and ``k / 10**4 = x``. Only the others
pass through a decimal. ``misfit`` tells the values that are left out.

Each helper has a ``*_sql`` twin with the expression as Spark SQL text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 10          # decimals kept of each value
QUICK = 4           # decimals that the quick way to limbs covers
HIGH, LOW = 20, 17  # bits of a limb before and behind the point
LIMBS = ("i2", "i1", "i0", "f1", "f0")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _exact_sql(x: str) -> str:
    return f"try_cast({x} AS DECIMAL(28,{SCALE}))"


def avg_round_sql(x: str, digits: int = 2) -> str:
    """Half-up ``round(avg(x), digits)``; null without a value."""
    v = _exact_sql(x)
    total, unit = f"sum({v})", 10 ** (SCALE - digits)
    n = f"CAST(nullif(count({v}), 0) AS DECIMAL(20,0))"
    return (f"CAST(signum({total}) AS DOUBLE) * CAST((abs({total}) * {2 * 10 ** SCALE}BD + {n} * {unit}BD) "
            f"div ({n} * {2 * unit}BD) AS DOUBLE) / {10 ** digits}.0D")


def avg_round(c: str, digits: int = 2) -> Column:
    return F.expr(avg_round_sql(f"`{c}`", digits))


def sum_round_sql(x: str, digits: int = 2) -> str:
    """``round(sum(x), digits)``, half-up."""
    return f"CAST(round(sum({_exact_sql(x)}), {digits}) AS DOUBLE)"


def sum_round(c: str, digits: int = 2) -> Column:
    return F.expr(sum_round_sql(f"`{c}`", digits))


# --- sums over long columns -----------------------------------------------------------------

def _name(c: str, part: str) -> str:
    return f"`_{c}_{part}`"


def with_limbs_sql(source: str, columns: list[str]) -> str:
    """A subquery: the rows of ``source`` with the limbs of numeric ``columns`` (null where a value
    is null or doesn't fit). In steps, each on the one before, so nothing is worked out twice."""
    quick, unit = 10 ** QUICK, 10 ** (SCALE - QUICK)
    steps = [
        [f"rint(CAST(`{c}` AS DOUBLE) * {quick}D) AS {_name(c, 'k')}" for c in columns],
        # below 10**15 no other decimal text of so few digits stands for the same double
        [f"CASE WHEN abs({_name(c, 'k')}) < 1e15D AND {_name(c, 'k')} / {quick}D = `{c}` THEN CAST({_name(c, 'k')} AS BIGINT) END "
         f"AS {_name(c, 'q')}" for c in columns],
        [f"CASE WHEN {_name(c, 'q')} IS NULL THEN try_cast(`{c}` AS DECIMAL(28,{SCALE})) END AS {_name(c, 'd')}" for c in columns],
        [f"coalesce(floor({_name(c, 'q')} / {quick}D), CAST(floor({_name(c, 'd')}) AS BIGINT)) AS {_name(c, 'i')}, "
         f"coalesce(pmod({_name(c, 'q')}, {quick}L) * {unit}L, CAST(({_name(c, 'd')} - floor({_name(c, 'd')})) * {10 ** SCALE}BD AS BIGINT)) "
         f"AS {_name(c, 'f')}" for c in columns],
        [f"shiftright({_name(c, 'i')}, {2 * HIGH}) AS {_name(c, 'i2')}, "
         f"shiftright({_name(c, 'i')}, {HIGH}) & {2 ** HIGH - 1}L AS {_name(c, 'i1')}, {_name(c, 'i')} & {2 ** HIGH - 1}L AS {_name(c, 'i0')}, "
         f"shiftright({_name(c, 'f')}, {LOW}) AS {_name(c, 'f1')}, {_name(c, 'f')} & {2 ** LOW - 1}L AS {_name(c, 'f0')}" for c in columns],
    ]
    for step in steps:
        source = f"(SELECT *, {', '.join(step)} FROM {source})"
    return source


def with_limbs(df: DataFrame, *columns: str) -> DataFrame:
    return df.sparkSession.sql(f"SELECT * FROM {with_limbs_sql('{rows}', list(columns))}", rows=df)


def _whole(c: str) -> tuple[str, str]:
    """A group's sum of ``c`` in units of 10**-SCALE, and the number of its values."""
    s = {p: f"CAST(sum({_name(c, p)}) AS DECIMAL(38,0))" for p in LIMBS}
    before = f"({s['i2']} * {2 ** (2 * HIGH)}BD + {s['i1']} * {2 ** HIGH}BD + {s['i0']})"
    total = f"CAST({before} * {10 ** SCALE}BD + {s['f1']} * {2 ** LOW}BD + {s['f0']} AS DECIMAL(38,0))"
    return total, f"count({_name(c, 'i0')})"


def avg_of_limbs_sql(c: str, digits: int = 2) -> str:
    """Half-up ``round(avg(c), digits)`` over rows with limbs of ``c``; null without a value."""
    (total, n), unit = _whole(c), 10 ** (SCALE - digits)
    n = f"CAST(nullif({n}, 0) AS DECIMAL(20,0))"
    return (f"CAST(signum({total}) AS DOUBLE) * CAST((abs({total}) * 2BD + {n} * {unit}BD) "
            f"div ({n} * {2 * unit}BD) AS DOUBLE) / {10 ** digits}.0D")


def avg_of_limbs(c: str, digits: int = 2) -> Column:
    return F.expr(avg_of_limbs_sql(c, digits))


def sum_of_limbs_sql(c: str, digits: int = 2) -> str:
    """``round(sum(c), digits)``, half-up, over rows with limbs of ``c``; ``digits`` up to 6."""
    return f"CAST(round({_whole(c)[0]}, {digits - SCALE}) * 0.{'0' * (SCALE - 1)}1BD AS DOUBLE)"


def sum_of_limbs(c: str, digits: int = 2) -> Column:
    return F.expr(sum_of_limbs_sql(c, digits))


def misfit(c) -> Column:
    """Whether a value doesn't fit the sums: NaN, an infinity or 10**18 and more."""
    c = _c(c)
    return c.isNotNull() & c.try_cast(f"decimal(28,{SCALE})").isNull()


def pct_round_sql(num: str, den: str, digits: int = 2) -> str:
    """Half-up ``round(num * 100 / den, digits)`` of counts."""
    n, d = f"CAST({num} AS DECIMAL(20,0))", f"CAST(nullif({den}, 0) AS DECIMAL(20,0))"
    return f"CAST(({n} * {2 * 10 ** (digits + 2)}BD + {d}) div ({d} * 2BD) AS DOUBLE) / {10 ** digits}.0D"


def pct_round(num: str, den: str, digits: int = 2) -> Column:
    return F.expr(pct_round_sql(f"`{num}`", f"`{den}`", digits))


def count_if(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)``: a null condition counts as 0."""
    return F.count_if(cond)
