"""Number checks, and averages whose rounding does not depend on the order of the rows.

The averages are SQL text over a column with a short internal name ``x``: its parts are called ``x_n``, ``x_sum``
and so on. Built this way a query with many measures costs the driver a few parser calls.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A scaled value is summed as three integers ("limbs"): its low LOW_BITS bits, the HIGH_BITS above them, and what is beyond
# (``top``, with the sign; values below LARGEST_SCALED keep their sign in ``high`` and have no top). Every limb of a row stays
# below 2**HIGH_BITS, so its sum holds for 2**33 rows. Before sums are weighted or summed once more, what they have beyond their limb's
# width is carried to the next one, and a fourth limb (``over``) takes the last carry. Products with a weight are split in
# the same way, and their upper halves add up to no more than the number of joined rows. So no row needs a decimal.
LOW_BITS, HIGH_BITS = 20, 30
LARGEST_SCALED = 2 ** (LOW_BITS + HIGH_BITS)
LARGEST_EXACT = 10**24
# Up to this average, in scaled units, the rounding is done in integers.
LARGEST_ROUNDED = 10**15
LIMBS = ("low", "high", "top", "over")


def is_number(column: Column, finite_only: bool = False) -> Column:
    """True where ``column`` parses as a double, false otherwise (null included).

    Spark also parses ``NaN``, ``inf``, `` 180 ``, ``1e3`` and ``180d``. ``finite_only`` turns away NaN
    and the infinities.
    """
    number = column.try_cast("double")
    if finite_only:
        # NaN sorts above every number, so one upper bound excludes it together with the infinities.
        return F.coalesce(F.abs(number) < F.lit(float("inf")), F.lit(False))
    return number.isNotNull()


def scaled(x: str, scale: int) -> str:
    """``x * 10**scale`` to the nearest integer, halves away from zero, without its multiples of LARGEST_SCALED; null beyond the exact range."""
    limit, most = LARGEST_SCALED / 10**scale, LARGEST_EXACT / 10**scale
    whole = f"{x} * {10**scale}.0D"
    return (
        f"CASE WHEN abs({x}) < {limit!r}D THEN CAST({whole} + 0.5D * sign({x}) AS BIGINT) "
        f"WHEN abs({x}) < {most!r}D THEN CAST(({whole}) % {LARGEST_SCALED}.0D + 0.5D * sign({x}) AS BIGINT) END"
    )


def value_parts(x: str, exact_scale: int | None) -> dict[str, str]:
    """What one row adds to the average of the double ``x``: the part's suffix and its SQL.

    Always ``n`` (1 unless null) and ``sum``. With ``exact_scale``, over a column ``x_scaled`` made by :func:`scaled`,
    ``low``, ``high`` and ``top`` are the limbs of the scaled value, and ``sum`` is left to the values that are not summed
    exactly (NaN, infinite, beyond LARGEST_EXACT); its total is null if there are none.
    """
    if exact_scale is None:
        return {"n": f"CAST({x} IS NOT NULL AS BIGINT)", "sum": x}
    least, most = LARGEST_SCALED / 10**exact_scale, LARGEST_EXACT / 10**exact_scale
    above = f"CAST({x} * {10**exact_scale}.0D / {LARGEST_SCALED}.0D AS BIGINT)"
    return {
        "n": f"CAST({x} IS NOT NULL AS BIGINT)",
        "sum": f"CASE WHEN abs({x}) >= {most!r}D THEN {x} END",
        "low": f"{x}_scaled & {2**LOW_BITS - 1}L",
        "high": f"shiftright({x}_scaled, {LOW_BITS})",
        "top": f"CASE WHEN abs({x}) >= {least!r}D AND abs({x}) < {most!r}D THEN {above} END",
    }


def average_parts(x: str, exact_scale: int | None) -> list[str]:
    """Aggregates ``x_n``, ``x_sum`` and so on, from which the average of ``x`` is finished or merged further."""
    return [f"sum({part}) AS {x}_{name}" for name, part in value_parts(x, exact_scale).items()]


def _low(value: str, bits: int) -> str:
    return f"(({value}) & {2**bits - 1}L)"


def _carry(value: str, bits: int) -> str:
    return f"shiftright({value}, {bits})"


def carried_parts(x: str, exact_scale: int | None) -> list[str]:
    """The parts of ``x`` after a sum, each limb brought back within its width by carrying to the next."""
    if exact_scale is None:
        return [f"{x}_n", f"{x}_sum"]
    top = f"coalesce({x}_top, 0L)"
    high = f"({x}_high + {_carry(f'{x}_low', LOW_BITS)})"
    beyond = f"({top} + {_carry(high, HIGH_BITS)})"
    limbs = (_low(f"{x}_low", LOW_BITS), _low(high, HIGH_BITS), _low(beyond, HIGH_BITS), _carry(beyond, HIGH_BITS))
    return [f"{x}_n", f"{x}_sum", *(f"{limb} AS {x}_{name}" for name, limb in zip(LIMBS, limbs))]


def merged_parts(x: str, weight: str | None, exact_scale: int | None, summed: bool) -> list[str]:
    """Aggregates that merge parts of ``x``, each counted ``weight`` (below 2**33) times, or once.

    ``summed`` says that the parts come from :func:`carried_parts`, and not from single rows.
    """

    def times(part: str) -> str:
        return f"{x}_{part}" if weight is None else f"{x}_{part} * {weight}"

    merged = [f"sum({times(part)}) AS {x}_{part}" for part in ("n", "sum")]
    if exact_scale is None:
        return merged
    low, high, top = (times(limb) for limb in LIMBS[:3])
    over = [times("over")] if summed else []
    if weight is None:
        limbs = [[low], [high], [top], over]
    else:
        limbs = [
            [_low(low, LOW_BITS)],
            [_carry(low, LOW_BITS), _low(high, HIGH_BITS)],
            [_carry(high, HIGH_BITS), f"coalesce({_low(top, HIGH_BITS)}, 0L)"],
            [f"coalesce({_carry(top, HIGH_BITS)}, 0L)", *over],
        ]
    return merged + [f"sum({' + '.join(terms or ['0L'])}) AS {x}_{name}" for name, terms in zip(LIMBS, limbs)]


def exact_total(x: str, limbs: int) -> str:
    """The sums of the first ``limbs`` limbs put together, once per group."""
    units = (0, LOW_BITS, LOW_BITS + HIGH_BITS, LOW_BITS + 2 * HIGH_BITS)
    terms = [f"coalesce(CAST({x}_{name} AS DECIMAL(38,0)), 0) * {2**unit}" for name, unit in zip(LIMBS[:limbs], units)]
    return f"CAST({' + '.join(terms)} AS DECIMAL(38,0)) AS {x}_total"


def plain_average(x: str, digits: int) -> str:
    """Double average rounded half up; null where nothing was counted."""
    return f"CASE WHEN {x}_n > 0 THEN round({x}_sum / {x}_n, {digits}) END"


def exact_average(x: str, digits: int, exact_scale: int) -> str:
    """Average from ``x_total``, rounded to ``digits`` in integer arithmetic: round(a / b) = (2a + b) div 2b.

    Beyond LARGEST_ROUNDED the exact total is divided as a double. A group with a value that is not summed exactly gets
    the rounded double average.
    """
    up, down = 10 ** max(digits - exact_scale, 0), 10 ** max(exact_scale - digits, 0)
    units = f"(abs({x}_total) * {2 * up} + {x}_n * {down}) div ({x}_n * {2 * down})"
    double_total = f"CAST({x}_total AS DOUBLE) / {10**exact_scale}.0D"
    small = f"abs(CAST({x}_total AS DOUBLE)) < {x}_n * {LARGEST_ROUNDED}.0D"
    return (
        f"CASE WHEN {x}_n = 0 THEN NULL WHEN {x}_sum IS NOT NULL THEN round(({x}_sum + {double_total}) / {x}_n, {digits}) "
        f"WHEN NOT {small} THEN round({double_total} / {x}_n, {digits}) "
        f"ELSE CAST(sign({x}_total) AS INT) * ({units}) / {10**digits}.0D END"
    )
