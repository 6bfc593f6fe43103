"""Row-level data-quality rules compiled into one projection.

A :class:`Rule` carries two predicates over the same columns:

* ``ok``   - the rule's contribution to the verdict (Kleene logic, may be NULL);
* ``fail`` - when its message is emitted.

The verdict is the Kleene AND of every ``ok``; the error text is the ``|``-joined
messages of the rules whose ``fail`` is TRUE, in rule order, and is set only where
the verdict is FALSE.  A NULL verdict ("undecided") arises when a rule whose
operand is NULL yields NULL instead of FALSE (a *strict* rule), and no other rule
fails.  Everything compiles to built-in expressions, so the whole rule set stays
inside one whole-stage-codegen projection.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from velolake.constants import ERROR_SEPARATOR


@dataclass(frozen=True)
class Rule:
    column: str
    message: str
    ok: Column
    fail: Column


def not_null(c: str, message: str) -> Rule:
    """Required field: NULL fails."""
    x = F.col(c)
    return Rule(c, message, x.isNotNull(), x.isNull())


def in_range(c: str, lo, hi, message: str, optional: bool = False) -> Rule:
    """``lo <= c <= hi``.  Optional: NULL passes.  Strict: NULL is undecided."""
    x = F.col(c)
    inside = (x >= lo) & (x <= hi)
    outside = (x < lo) | (x > hi)
    if optional:
        return Rule(c, message, x.isNull() | inside, x.isNotNull() & outside)
    return Rule(c, message, inside, outside)


def at_least(c: str, lo, message: str, optional: bool = False) -> Rule:
    x = F.col(c)
    if optional:
        return Rule(c, message, x.isNull() | (x >= lo), x.isNotNull() & (x < lo))
    return Rule(c, message, x >= lo, x < lo)


def greater_than(c: str, lo, message: str) -> Rule:
    """Strict ``c > lo`` (NULL undecided; pair with :func:`not_null` to make it fail)."""
    x = F.col(c)
    return Rule(c, message, x > lo, x <= lo)


def one_of(c: str, allowed: list, message: str, optional: bool = False) -> Rule:
    x = F.col(c)
    member = x.isin(allowed)
    if optional:
        return Rule(c, message, x.isNull() | member, x.isNotNull() & ~member)
    return Rule(c, message, member, ~member)


def verdict(rules: list[Rule]) -> Column:
    return reduce(lambda a, b: a & b, [r.ok for r in rules])


def error_text(rules: list[Rule]) -> Column:
    return F.concat_ws(ERROR_SEPARATOR, *[F.when(r.fail, F.lit(r.message)) for r in rules])


def apply_rules(df, rules: list[Rule], verdict_col: str = "is_valid", error_col: str = "error_message"):
    """Add the verdict and error message columns in a single projection."""
    return with_checks(df, verdict(rules), error_text(rules), verdict_col, error_col)


def with_checks(df, ok: Column, text: Column, verdict_col: str = "is_valid", error_col: str = "error_message"):
    """``df`` plus the verdict and, where it is FALSE, the error text."""
    return df.select(
        "*",
        ok.alias(verdict_col),
        F.when(~ok, text).otherwise(F.lit(None).cast("string")).alias(error_col),
    )
