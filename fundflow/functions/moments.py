"""Sample deviation of doubles that does not depend on the order of the rows.

A value is taken as a whole number of billionths: exactly, if it has at most nine
decimals, else rounded to the ninth. Its upper and lower 31 bits, and the three
products of these, are added in two halves each, so every buffer of the aggregate
is a long and none can overflow below 2**32 rows in a group. States of several
aggregates merge by adding their fields. The variance is an exact fraction of
whole numbers; it is rounded once, when the deviation is published.

From 4.6 * 10**9 on, and for NaN, values are counted in ``outside``; only a group
that holds one, or whose squared distances add up to more than 38 digits of
10**-18, is published from plain sums of doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundflow.functions.exact import let, let_sql

_HALF = 31
_LIMIT = 4.6e9
_SUMS = ("up", "down", "uu_high", "uu_low", "ud_high", "ud_low", "dd_high", "dd_low", "n", "outside")
_WIDE = "DECIMAL(38,0)"


def billionths(column: str) -> Column:
    """The value as a whole number of billionths; NULL outside the exact range.

    Computed below the aggregate, so that ``moments`` reads it eight times for nothing.
    """
    x = f"`{column}`"
    steps = f"rint({x} * 10000D)"
    return F.expr(
        f"CASE WHEN {steps} / 10000D = {x} AND abs({steps}) < {2**40}D"
        f" THEN CAST({steps} AS BIGINT) * 100000L"
        f" WHEN abs({x}) < {_LIMIT:.1f}D"
        f" THEN CAST(CAST({x} AS DECIMAL(20,9)) * 1000000000BD AS BIGINT) END"
    )


def moments(column: str, whole: str) -> Column:
    """Aggregate: count, sum and sum of squares of a column whose ``billionths`` are in ``whole``."""
    k, x = f"`{whole}`", f"`{column}`"
    up, down = f"shiftright({k}, {_HALF})", f"({k} & {2**_HALF - 1}L)"
    products = {"uu": f"({up} * {up})", "ud": f"({up} * {down})", "dd": f"({down} * {down})"}
    sums = {"up": up, "down": down}
    for name, product in products.items():
        sums[f"{name}_high"] = f"shiftright({product}, {_HALF})"
        sums[f"{name}_low"] = f"{product} & {2**_HALF - 1}L"
    fields = ", ".join(f"'{name}', coalesce(sum({value}), 0L)" for name, value in sums.items())
    far = f"CASE WHEN {k} IS NULL THEN {x} END"
    return F.expr(
        f"named_struct({fields}, 'n', count({k}), 'outside', count({far}),"
        f" 'rough', coalesce(sum({far}), 0D), 'rough_squares', coalesce(sum({far} * {far}), 0D))"
    )


def add_moments(states: str) -> Column:
    """Aggregate: several states of ``moments`` as one."""
    names = (*_SUMS, "rough", "rough_squares")
    return F.expr(f"named_struct({', '.join(f"'{n}', sum(`{states}`.{n})" for n in names)})")


def _struct(**values: str) -> str:
    return f"named_struct({', '.join(f"'{n}', {v}" for n, v in values.items())})"


# Whole numbers of up to 38 digits. One side of each step is of that type, and so is the result.


def _wide(value: str) -> str:
    return f"CAST({value} AS {_WIDE})"


def _times(a: str, b: str) -> str:
    return f"try_multiply({a}, {b})"


def _plus(a: str, b: str) -> str:
    return f"try_add({a}, {b})"


def _less(a: str, b: str) -> str:
    return f"try_subtract({a}, {b})"


def _shifted(value: str, halves: int = 1) -> str:
    return _times(value, f"{2 ** (_HALF * halves)}L")


def _spread(m: str) -> str:
    """``n``, ``d`` and ``r``: the squared distances from the mean sum to d - r * r / n.

    With the whole mean M and what is left of the sum, r, the squares less
    M * (sum + r) are d. All terms are split at bit 31, so that the large parts,
    which cancel, never become one number of more than 38 digits.
    """
    halves = {p: _plus(_shifted(_wide(f"{m}.{p}_high")), f"{m}.{p}_low") for p in ("uu", "ud", "dd")}
    sums = _struct(n=_wide(f"{m}.n"), up=_wide(f"{m}.up"), down=_wide(f"{m}.down"), **halves)
    mean = let_sql(_plus(_shifted("w.up"), "w.down"), "t", _struct(total="t", mean="t div w.n"))
    split = _struct(
        rest=_less("a.total", _times("w.n", "a.mean")),
        up=_wide(f"shiftright(a.mean, {_HALF})"),
        down=_wide(f"a.mean & {2**_HALF - 1}L"),
    )
    far = _struct(
        up=_less(_times("w.up", "2"), _times("w.n", "b.up")),
        down=_less(_times("w.down", "2"), _times("w.n", "b.down")),
    )
    top = _less("w.uu", _times("b.up", "c.up"))
    middle = _less(_times("w.ud", "2"), _times("b.up", "c.down"))
    middle = _less(middle, _times("b.down", "c.up"))
    low = _less("w.dd", _times("b.down", "c.down"))
    found = _struct(n="w.n", d=_plus(_plus(_shifted(top, 2), _shifted(middle)), low), r="b.rest")
    return let_sql(sums, "w", let_sql(let_sql(mean, "a", split), "b", let_sql(far, "c", found)))


def _from_spread(s: str, places: int) -> str:
    """The root of the exact variance in doubles, then moved to where the exact one is."""
    unit = 10 ** (9 - places)
    left = f"CAST({s}.r AS DOUBLE) * CAST({s}.r AS DOUBLE) / CAST({s}.n AS DOUBLE)"
    variance = f"greatest(CAST({s}.d AS DOUBLE) - {left}, 0D) / (CAST({s}.n AS DOUBLE) - 1D)"
    steps = f"CAST(rint(sqrt({variance}) / {unit}D) AS BIGINT)"
    # Whether the deviation is at least the limit below and the limit above, in halves of a step.
    above = let_sql(
        _times("h", f"{unit // 2}L"), "z", _less(f"{s}.d", _times(_times("z", "z"), f"({s}.n - 1)"))
    )
    reached = (
        f"CASE WHEN x < 0 THEN false WHEN x >= {s}.n THEN true"
        f" ELSE {_times('x', f'{s}.n')} >= {_times(f'{s}.r', f'{s}.r')} END"
    )
    limits = f"array({_wide('2 * j - 1')}, {_wide('2 * j + 1')})"
    both = f"transform({limits}, h -> {let_sql(above, 'x', reached)})"
    moved = "CASE WHEN e[1] THEN j + 1 WHEN j > 0 AND NOT e[0] THEN j - 1 ELSE j END"
    published = f"CAST({let_sql(steps, 'j', let_sql(both, 'e', moved))} AS DOUBLE) / {float(10**places)}D"
    return f"CASE WHEN {s}.d IS NOT NULL THEN {published} END"


def _rough(m: str, places: int) -> str:
    """From sums of doubles: of what is outside, and of the rest by its exact sums."""
    shift = f"{float(2**_HALF)}D"
    half = lambda a: f"(CAST({m}.{a}_high AS DOUBLE) * {shift} + CAST({m}.{a}_low AS DOUBLE))"
    total = f"(CAST({m}.up AS DOUBLE) * {shift} + CAST({m}.down AS DOUBLE)) * 1e-9D + {m}.rough"
    squares = f"({half('uu')} * {shift} + 2D * {half('ud')}) * {shift} + {half('dd')}"
    squares = f"({squares}) * 1e-9D * 1e-9D + {m}.rough_squares"
    sums = _struct(t=total, q=squares, n=f"CAST({m}.n + {m}.outside AS DOUBLE)")
    spread = "CASE WHEN isnan(y.q) THEN y.q ELSE greatest(y.q - y.t * y.t / y.n, 0D) END"
    return let_sql(sums, "y", f"round(sqrt({spread} / (y.n - 1D)), {places})")


def sample_deviation(m: Column, places: int = 4) -> Column:
    """The sample deviation, rounded half-up once; NULL below two values."""
    exact = let_sql(_spread("m"), "s", _from_spread("s", places))
    exact = f"CASE WHEN m.outside = 0 AND m.n > 1 THEN {exact} END"
    rough = f"CASE WHEN m.n + m.outside > 1 THEN {_rough('m', places)} END"
    return let(m, "m", f"coalesce({exact}, {rough})")
