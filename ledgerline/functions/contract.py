"""The silver data contract: an ordered list of (reason, predicate) rules.

``classify`` folds the list into one ``CASE WHEN`` so the first breach wins
and a clean row gets NULL.  The rules are data, so a caller can extend or
reorder them without touching the fold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The six quarantine reasons, in evaluation order.
REASONS = (
    "null_account_key",
    "invalid_step",
    "unparseable_amount",
    "negative_amount",
    "negative_balance",
    "unknown_actor_type",
)

# Recognised account-id prefixes (customer, merchant).
ACTOR_PREFIXES = ("C", "M")


def _blank(c: Column) -> Column:
    return c.isNull() | (c == F.lit(""))


def _neg(c: Column) -> Column:
    return F.coalesce(c, F.lit(0)) < F.lit(0)


def default_rules(name_orig: Column, name_dest: Column, step_num: Column, amount: Column,
                  balances: Sequence[Column]) -> list[tuple[str, Column]]:
    """The contract over typed columns (raw ids kept only for validation)."""
    first_orig = F.substring(name_orig, 1, 1)
    first_dest = F.substring(name_dest, 1, 1)
    any_negative = _neg(balances[0])
    for b in balances[1:]:
        any_negative = any_negative | _neg(b)
    return [
        ("null_account_key", _blank(name_orig) | _blank(name_dest)),
        ("invalid_step", step_num.isNull() | (step_num < F.lit(1))),
        ("unparseable_amount", amount.isNull()),
        ("negative_amount", amount < F.lit(0)),
        ("negative_balance", any_negative),
        ("unknown_actor_type", ~first_orig.isin(*ACTOR_PREFIXES) | ~first_dest.isin(*ACTOR_PREFIXES)),
    ]


def classify(rules: Sequence[tuple[str, Column]]) -> Column:
    """First matching rule's reason, else NULL.  A NULL predicate is a miss."""
    if not rules:
        return F.lit(None).cast("string")
    expr = None
    for reason, predicate in rules:
        expr = F.when(predicate, F.lit(reason)) if expr is None else expr.when(predicate, F.lit(reason))
    return expr
