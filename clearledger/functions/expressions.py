"""Column expressions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(column: Column | str) -> Column:
    """A sum of money: added up in exact decimals, so the order of rows doesn't matter, and returned as double."""
    return F.sum(F.col(column).cast("decimal(18,2)") if isinstance(column, str) else column.cast("decimal(18,2)")).cast("double")


def ids(column: str = "line_id") -> Column:
    """The sorted distinct line ids of a group."""
    return F.array_sort(F.collect_set(column))


def quantile(column: str, p: float, exact: bool = True, accuracy: int = 10_000) -> Column:
    """Percentile with linear interpolation, or an approximate element of the data."""
    return F.percentile(column, F.lit(p)) if exact else F.percentile_approx(column, p, accuracy).cast("double")


def minutes_per_unit(description: Column) -> Column:
    """Minutes that one unit stands for, read from a procedure's description; null if it is not billed by time. A number of any length is read."""
    d, unit = F.upper(description), r"(?:PER|UP TO|EACH)\s+"
    minutes, hours = unit + r"(\d+)\s*MINUTE", unit + r"(\d+)\s*HOUR"
    return (
        F.when(d.rlike(minutes), F.regexp_extract(d, minutes, 1).try_cast("double"))
        .when(d.rlike(hours), F.regexp_extract(d, hours, 1).try_cast("double") * 60)
        .when(d.rlike(unit + "HOUR"), F.lit(60.0))
    )


def up_to(description: Column) -> Column:
    """Whether the description gives an upper bound and not an exact unit."""
    return F.upper(description).rlike(r"UP TO\s+\d+")


def span_days(first: Column, last: Column) -> Column:
    """Days that a line covers, one at least."""
    return F.greatest(F.datediff(F.coalesce(last, first), first) + 1, F.lit(1))


def lob_allowed(lob: Column, excluded: tuple[str, ...]) -> Column:
    """Keeps lines without a payer; a plain NOT IN would drop them."""
    return lob.isNull() | ~lob.isin(*excluded) if excluded else F.lit(True)


def in_group(modifiers: list[Column], group: tuple[str, ...]) -> Column:
    """Whether any modifier marks a group session."""
    out = F.lit(False)
    for m in modifiers:
        out = out | F.coalesce(m, F.lit("")).isin(*group)
    return out


def ratio(target: Column, peer: Column) -> Column:
    """target / peer rounded to 1 place where the peer value is positive, else null."""
    return F.when(peer > 0, F.round(F.try_divide(target, peer), 1))


def share_over(value: Column, level: float) -> Column:
    """Percentage of rows above a level. All rows count below; with nothing but nulls the result is null."""
    over = F.sum(F.when(value > level, 1).when(value.isNotNull(), 0))
    return F.try_divide(over * F.lit(100.0), F.count(F.lit(1)))
