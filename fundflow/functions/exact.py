"""Sums and means of doubles that do not depend on the order of the rows.

Adding doubles gives a last digit that changes with partitioning, task retries
and adaptive re-planning; after rounding to cents that becomes a wrong cent.
``exact_sum`` adds decimal digits instead: those of the shortest text of each
double. It stays inside a hash aggregate, whose buffers are all longs:

* A value with at most four decimals and below 10**8 is a whole number of
  ten-thousandths, added as the part above bit 20 and the 20 bits below.
* Of any other value below 10**36 the whole part below 10**18 is added as the part
  above bit 30 and the 30 bits below, what is above in two groups of nine digits,
  and the fraction in groups of nine, nine and eight digits.

No sum can overflow below 2**33 rows in a group. Outside this range, and counted
in ``outside``, are values from 10**36 on, NaN, values with digits past 26 places (which have
to be below 10**-9), and sums that leave ``decimal(38)``. Only a group that holds one
of them is published from the plain sum.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_GRID_LIMIT = 2**40
_LOW = 2**20
_HALF = 30
_PARTS = ("high", "low", "up", "down", "top", "next", "first", "second", "third")
_FRACTION = "DECIMAL(27,26)"
# A total that can be published with a digit to spare, and with that digit.
_TOTAL = "DECIMAL(36,10)"
_STICKY = "DECIMAL(37,11)"


def exact_sum(column: str) -> Column:
    """Exact sum of the non-NULL values as a struct for ``settle``, ``mean_of`` and ``minus``.

    NULL if there are none.
    """
    x = f"`{column}`"
    steps = f"rint({x} * 10000D)"
    on_grid = f"({steps} / 10000D = {x} AND abs({steps}) < {_GRID_LIMIT}D)"
    grid = f"CASE WHEN {on_grid} THEN CAST({steps} AS BIGINT) END"

    def off(value: str, condition: str) -> str:
        return f"CASE WHEN NOT {on_grid} AND {condition} THEN {value} END"

    quintillion = "CAST(1000000000000000000BD AS DECIMAL(19,0))"
    digits = f"CAST({x} AS DECIMAL(38,0))"
    whole = (
        f"CASE WHEN abs({x}) < 1e18D THEN CAST({x} AS BIGINT)"
        f" ELSE CAST({digits} % {quintillion} AS BIGINT) END"
    )
    whole = off(whole, f"abs({x}) < 1e36D")
    above = f"({digits} div {quintillion})"
    huge = f"abs({x}) >= 1e18D AND abs({x}) < 1e36D"
    # From 10**10 on a double has fewer than nine decimals.
    fraction = (
        f"CASE WHEN abs({x}) < 1e10D THEN CAST(CAST({x} AS DECIMAL(38,26)) % 1BD AS {_FRACTION})"
        f" ELSE CAST(CAST({x} AS DECIMAL(38,9)) % 1BD AS {_FRACTION}) END"
    )
    nine = "CAST(1000000000BD AS DECIMAL(10,0))"
    one = f"({fraction}) * {nine}"
    two = f"CAST({one} % 1BD AS {_FRACTION}) * {nine}"
    three = f"CAST({two} % 1BD AS {_FRACTION}) * CAST(100000000BD AS DECIMAL(9,0))"
    has_fraction = f"abs({x}) < 1e18D AND {x} <> rint({x})"
    lost = (
        f"abs({x}) >= 1e36D"
        f" OR (abs({x}) < 1e-9D AND CAST(CAST({x} AS DECIMAL(38,26)) AS DOUBLE) <> {x})"
    )
    sums = {
        "high": f"shiftright({grid}, 20)",
        "low": f"({grid}) & {_LOW - 1}",
        "up": f"shiftright({whole}, {_HALF})",
        "down": f"({whole}) & {2**_HALF - 1}",
        "top": off(f"{above} div 1000000000", huge),
        "next": off(f"{above} % 1000000000", huge),
        "first": off(f"CAST({one} AS BIGINT)", has_fraction),
        "second": off(f"CAST({two} AS BIGINT)", has_fraction),
        "third": off(f"CAST({three} AS BIGINT)", has_fraction),
    }
    fields = ", ".join(f"'{name}', coalesce(sum({value}), 0L)" for name, value in sums.items())
    return F.expr(
        f"CASE WHEN count({x}) > 0 THEN named_struct({fields},"
        f" 'outside', count_if({lost}), 'rough', sum({x})) END"
    )


def add_up(column: str) -> Column:
    """Aggregate: the sums in a column as one, zero if there are none."""
    fields = ", ".join(f"'{n}', coalesce(sum(`{column}`.{n}), 0L)" for n in (*_PARTS, "outside"))
    return F.expr(f"named_struct({fields}, 'rough', coalesce(sum(`{column}`.rough), 0D))")


def minus(a: str, b: str) -> Column:
    """Difference of two columns of sums; NULL if one is."""
    fields = ", ".join(f"'{n}', `{a}`.{n} - `{b}`.{n}" for n in (*_PARTS, "outside", "rough"))
    fields = fields.replace(f"`{a}`.outside - ", f"`{a}`.outside + ")
    return F.expr(f"CASE WHEN `{a}` IS NOT NULL AND `{b}` IS NOT NULL THEN named_struct({fields}) END")


def let(value: Column, name: str, then: str) -> Column:
    """``then``, an expression in SQL, with the value computed once and known by a name.

    Publishing is done once per group; kept out of the generated code of the
    aggregate, its many decimal steps do not make that too long to compile. As text
    it is one call to the JVM instead of hundreds.
    """
    return F.get(F.call_function("transform", F.array(value), F.expr(f"{name} -> {then}")), F.lit(0))


def let_sql(value: str, name: str, then: str) -> str:
    """``let`` within another such expression."""
    return f"get(transform(array({value}), {name} -> {then}), 0)"


def _number(part: str) -> str:
    return f"CAST({part} AS DECIMAL(19,0))"


def _base(t: str) -> str:
    whole = f"({_number(f'{t}.high')} * CAST({_LOW}BD AS DECIMAL(10,0)) + {_number(f'{t}.low')})"
    return f"CAST({whole} * 0.0001BD AS DECIMAL(38,10))"


def _whole(t: str) -> str:
    below = f"CAST({_number(f'{t}.up')} * CAST({2**_HALF}BD AS DECIMAL(10,0)) + {_number(f'{t}.down')} AS DECIMAL(37,0))"
    nine = "CAST(1000000000BD AS DECIMAL(10,0))"
    above = f"CAST({_number(f'{t}.top')} * {nine} + {_number(f'{t}.next')} AS DECIMAL(30,0))"
    scale = "CAST(1000000000000000000BD AS DECIMAL(19,0))"
    above = f"TRY_CAST(try_multiply({above}, {scale}) AS DECIMAL(37,0))"
    return f"TRY_CAST(try_add({below}, {above}) AS DECIMAL(38,0))"


def _fine(t: str) -> str:
    nano, kind = "0.000000001BD", "DECIMAL(36,26)"
    first = f"CAST({_number(f'{t}.first')} * {nano} AS {kind})"
    second = f"CAST(CAST({_number(f'{t}.second')} * {nano} AS DECIMAL(19,9)) * {nano} AS {kind})"
    third = f"CAST({_number(f'{t}.third')} * {nano} AS DECIMAL(19,9)) * {nano}"
    third = f"CAST(CAST({third} AS DECIMAL(19,18)) * 0.00000001BD AS {kind})"
    return f"CAST({first} + {second} + {third} AS DECIMAL(38,26))"


def base_of(total: Column) -> Column:
    """What the values with at most four decimals add up to."""
    return let(total, "t", _base("t"))


def whole_of(total: Column) -> Column:
    """The whole parts of the other values; NULL beyond 38 digits."""
    return let(total, "t", _whole("t"))


def fraction_of(total: Column) -> Column:
    """Their fractions."""
    return let(total, "t", _fine("t"))


def _parts(t: str, name: str, then: str) -> str:
    """``then`` with the three parts of a sum, each computed once."""
    parts = f"named_struct('base', {_base(t)}, 'whole', {_whole(t)}, 'fine', {_fine(t)})"
    return let_sql(parts, name, then)


def _sticky(p: str) -> str:
    """The sum with an eleventh decimal that only says whether more follows.

    Enough to round once to ten places or fewer. NULL from 10**26 on.
    """
    sums = f"try_add(TRY_CAST({p}.base AS {_TOTAL}), TRY_CAST({p}.whole AS {_TOTAL}))"
    more = f"CASE WHEN {p}.fine > d THEN 0.00000000001BD ELSE 0.00000000000BD END"
    exact = f"CAST(TRY_CAST(try_add({sums}, d) AS {_TOTAL}) AS {_STICKY})"
    sticky = f"TRY_CAST(try_add({exact}, {more}) AS {_STICKY})"
    return let_sql(f"CAST(floor({p}.fine, 10) AS DECIMAL(20,10))", "d", sticky)


def _coarse(p: str) -> str:
    return f"CAST(try_add({p}.whole, TRY_CAST({p}.base AS DECIMAL(38,0))) AS DOUBLE)"


def _published(t: str, fine: str, coarse: str, rough: str) -> str:
    exact = _parts(t, "p", f"coalesce(CAST({fine} AS DOUBLE), {coarse})")
    return f"coalesce(CASE WHEN {t}.outside = 0 THEN {exact} END, {rough})"


def _on_grid(total: Column, unit: int) -> Column:
    """Whether a sum has only four-decimal values, and few enough units to be a double exactly."""
    parts = total["outside"]
    for name in _PARTS[2:]:
        parts = parts.bitwiseOR(total[name])
    return (parts == 0) & (F.abs(total["high"]) < F.lit(2**33 * unit))


def _steps(total: Column) -> Column:
    """A sum on the grid as a whole number of ten-thousandths."""
    return total["high"] * F.lit(_LOW) + total["low"]


def _signed(size: Column, steps: Column, places: int) -> Column:
    value = F.when(steps < 0, -size).otherwise(size)
    return value.cast("double") / F.lit(float(10**places))


def settle(total: Column, places: int) -> Column:
    """A sum rounded half-up once, as double.

    From 10**26 on the fraction is dropped: a double has no digits for it. Sums of
    four-decimal values, nearly all, are rounded as whole numbers.
    """
    rough = f"round(t.rough, {places})"
    exact = _published("t", f"round({_sticky('p')}, {places})", _coarse("p"), rough)
    if places > 4:
        return let(total, "t", exact)
    unit = 10 ** (4 - places)
    steps = _steps(total)
    size = F.call_function("div", F.abs(steps) + F.lit(unit // 2), F.lit(unit))
    plain = _signed(size, steps, places)
    return F.when(_on_grid(total, unit), plain).otherwise(let(total, "t", exact))


def _rounded(value: str, n: str, places: int) -> str:
    """``value / n``, half up.

    Spark's quotient has eleven decimals, rounded. If those end in a tie, the
    product with ``n`` tells in whole numbers whether the true mean lies below it.
    """
    scaled = "TRY_CAST(try_multiply(TRY_CAST(round(q, 5) AS DECIMAL(30,5)), 100000) AS DECIMAL(19,0))"
    product = f"try_multiply({scaled}, CAST({n} AS DECIMAL(19,0)))"
    exact = f"TRY_CAST(try_multiply(abs({value}), 100000) AS DECIMAL(38,6))"
    below = f"coalesce(round(q, 5) = q AND {product} > {exact}, false)"
    decided = f"round(CASE WHEN {below} THEN q - 0.00000000001BD ELSE q END, {places})"
    quotient = f"TRY_CAST(try_divide(abs({value}), CAST({n} AS DECIMAL(19,0))) AS DECIMAL(36,11))"
    rounded = let_sql(quotient, "q", decided)
    return let_sql(rounded, "r", f"CASE WHEN {value} < 0 THEN -r ELSE r END")


def mean_of(total: Column, n: Column, places: int) -> Column:
    """The mean rounded half-up once, to at most four places; NULL if there are no values."""
    unit = 10 ** (4 - places)
    steps, whole = _steps(total), n * F.lit(unit)
    # Half up: twice the sum and the count, by twice the count.
    size = F.call_function("div", F.abs(steps) * 2 + whole, whole * 2)
    exact = let_sql(_sticky("p"), "v", _rounded("v", "s.n", places))
    rough = f"round(try_divide(s.t.rough, s.n), {places})"
    slow = _published("s.t", exact, f"try_divide({_coarse('p')}, s.n)", rough)
    plain = (n > 0) & (n < F.lit(2**40)) & _on_grid(total, unit)
    whole_way = let(F.struct(total.alias("t"), n.alias("n")), "s", f"CASE WHEN s.n > 0 THEN {slow} END")
    return F.when(plain, _signed(size, steps, places)).otherwise(whole_way)


def exact_mean(column: str, places: int) -> Column:
    """Mean of the non-NULL values, rounded half-up once; NULL if there are none."""
    return mean_of(exact_sum(column), F.count(column), places)
