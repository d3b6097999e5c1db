"""Keys, money and tiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"

# Price limits and their names; prices from the last limit on are "Luxury".
PRICE_TIERS = [(50, "Budget"), (200, "Mid-range"), (500, "Premium")]
TOP_PRICE_TIER = "Luxury"
# Fixed value: stands for a NULL part of a key of several parts.
NULL_PART = "_null_"


def surrogate_key(*cols: Column) -> Column:
    """MD5 hex of the decimal text of an id; several parts are joined by a dash, a NULL part counts as ``_null_``."""
    texts = [c.cast("string") for c in cols]
    return F.md5(texts[0] if len(texts) == 1 else F.concat_ws("-", *[F.coalesce(t, F.lit(NULL_PART)) for t in texts]))


def version_of(updated: Column, created: Column | None = None) -> Column:
    """Epoch second of the last change, 0 when nothing is known."""
    known = [F.unix_timestamp(updated)] + ([] if created is None else [F.unix_timestamp(created)])
    return F.coalesce(*known, F.lit(0).cast("long"))


def money(col: Column) -> Column:
    return col.cast(MONEY)


def price_tier(price: Column) -> Column:
    tier = None
    for limit, name in PRICE_TIERS:
        tier = F.when(price < limit, name) if tier is None else tier.when(price < limit, name)
    return tier.otherwise(TOP_PRICE_TIER)


def amount_if(status: Column, wanted: list[str], amount: Column) -> Column:
    """The amount as money when the status is one of ``wanted``, else 0."""
    return F.when(status.isin(*wanted), money(amount)).otherwise(F.lit(0).cast(MONEY))


def synthetic_bucket(key: Column, n: int) -> Column:
    """1-based bucket of a 1-based id."""
    return F.pmod(key - 1, F.lit(n)) + 1


def growth_pct(current: Column, previous: Column, digits: int = 1) -> Column:
    """Percent change; NULL unless the previous value is positive."""
    now, before = current.cast("double"), previous.cast("double")
    return F.when(before > 0, F.round((now - before) / before * 100, digits))
