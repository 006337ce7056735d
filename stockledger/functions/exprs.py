"""Small column expressions shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITESPACE = " \t\r\n\x0b\x0c"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_is(df: DataFrame) -> DataFrame:
    return df


def sum0(c: Column | str) -> Column:
    """Sum in which a group without values gives 0 and not NULL."""
    return F.coalesce(F.sum(c), F.lit(0))


def mean(c: Column | str) -> Column:
    """Mean as one division of the whole sum, so decimal input gives the same double in any order."""
    return F.try_divide(F.sum(c).cast("double"), F.count(c))


def n_unique(c: Column | str) -> Column:
    """Distinct values, NULL counted as one of them."""
    return F.count_distinct(c) + F.max(F.when(as_column(c).isNull(), 1).otherwise(0))


def ratio(num: Column | str, den: Column | str) -> Column:
    """Quotient in double; NULL where the denominator is 0."""
    return F.try_divide(as_column(num).cast("double"), as_column(den).cast("double"))


def ratio_if_positive(num: Column | str, den: Column | str) -> Column:
    den = as_column(den)
    return F.when(den > 0, ratio(num, den))


def round_cents(c: Column) -> Column:
    """Two decimals, ties to even on the scaled double."""
    return F.rint(c * 100) / 100


def signed(c: Column | str, sign: Column) -> Column:
    """`c` with the sign of `sign`. Negating keeps a decimal's type, multiplying would widen it."""
    c = as_column(c)
    return F.when(sign > 0, c).when(sign < 0, -c)


def first_match(rules: list[tuple[Column, Column | str]], otherwise: Column | str) -> Column:
    """CASE with the first rule that holds; a NULL condition does not hold."""

    def value(v: Column | str) -> Column:
        return F.lit(v) if isinstance(v, str) else v

    (cond, then), *rest = rules
    chain = reduce(lambda acc, rule: acc.when(rule[0], value(rule[1])), rest, F.when(cond, value(then)))
    return chain.otherwise(value(otherwise))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def joined_key(a: Column | str, b: Column | str) -> Column:
    """`a-b`, NULL when either part is NULL."""
    return F.concat(as_column(a).cast("string"), F.lit("-"), as_column(b).cast("string"))


def spread_null_key(key: Column | str, side: str, over: list[str]) -> Column:
    """The join key with NULLs replaced by texts that match nothing.

    NULL keys never join, but they all hash alike and would fill one shuffle partition; the
    side's name keeps left and right apart and the hash spreads them.
    """
    filler = F.concat(F.lit(f"\x00{side}\x00"), F.pmod(F.xxhash64(*over), F.lit(4096)).cast("string"))
    return F.coalesce(as_column(key), filler)


def split_key(key: str) -> Column:
    """A second join key that follows the first.

    A side that was just aggregated on the key would join without a shuffle of its own, and
    adaptive execution splits a hot key only between two fresh shuffles. Joining on key and hash
    gives both sides one.
    """
    return F.xxhash64(key)


def zero_nulls(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULL to 0 in numeric columns, key columns too; text columns keep their NULLs."""
    return df.fillna(0, subset=columns)


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Joins on equal keys, NULL keys matching each other; the left keys stay."""
    renamed = right.withColumnsRenamed({k: f"_{k}_r" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}_r")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_{k}_r" for k in keys])


def n_unique_small(c: str) -> Column:
    """`n_unique` for a column with few values per group, kept as a set in the same aggregation."""
    return F.size(F.collect_set(F.struct(c))).cast("bigint")
