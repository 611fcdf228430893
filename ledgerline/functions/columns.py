"""Column expressions used by the silver and gold jobs.

All of these are built-in ``pyspark.sql.functions`` so they stay inside
whole-stage codegen; none needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 2)

# The event-clock anchor (step 1 = the first simulated hour).
EVENT_CLOCK_ANCHOR = "2023-01-01 00:00:00"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def try_int(col: str | Column) -> Column:
    """String -> INT; an unparseable value becomes NULL instead of failing."""
    return _c(col).try_cast("int")


def try_money(col: str | Column) -> Column:
    """String -> DECIMAL(18,2) (half-up); unparseable or overflow -> NULL."""
    return _c(col).try_cast(MONEY)


def flag(col: str | Column) -> Column:
    """'1' -> true, other integers -> false, unparseable -> NULL."""
    return try_int(col) == F.lit(1)


def grain_key(step_num: Column, txn_type: Column, name_orig: Column,
              name_dest: Column, amount: Column) -> Column:
    """sha2-256 of the natural grain ``step|type|orig|dest|amount``.

    ``concat_ws`` skips NULL parts, so the key is only a real key for rows
    that pass the contract (all parts but ``type`` non-NULL).
    """
    return F.sha2(F.concat_ws("|", step_num.cast("string"), txn_type, name_orig,
                              name_dest, amount.cast("string")), 256)


def tokenise(col: str | Column, secret: str | None = None) -> Column:
    """Pseudonymous account key.  Unsalted sha2-256 by default; a keyed
    variant (secret prefix) resists dictionary attacks on short ids."""
    c = _c(col)
    if secret:
        c = F.concat(F.lit(secret), c)
    return F.sha2(c, 256)


def actor_type(col: str | Column) -> Column:
    """First letter 'M' -> merchant, anything else (NULL too) -> customer."""
    return F.when(F.substring(_c(col), 1, 1) == F.lit("M"), F.lit("merchant")) \
        .otherwise(F.lit("customer"))


def event_clock(step_num: str | Column) -> Column:
    """Event timestamp: anchor + (step - 1) hours, as TIMESTAMP_NTZ."""
    anchor = F.lit(EVENT_CLOCK_ANCHOR).cast("timestamp_ntz")
    return F.timestamp_add("HOUR", _c(step_num) - F.lit(1), anchor)


def as_ntz(value) -> Column:
    """A timestamp literal as TIMESTAMP_NTZ (no session-zone dependence)."""
    if hasattr(value, "isoformat"):
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")
