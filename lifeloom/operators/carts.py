"""Cart abandonment, recovery and recovery-code allocation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifeloom.functions.ranking import first_k, positions
from lifeloom.functions.times import Moment, as_ts, shift
from lifeloom.sources.tables import deleted_where, updated_from, updated_where


def reachable(subscribers: DataFrame) -> DataFrame:
    return subscribers.filter((F.col("SubscriberStatus") == "Active") & F.col("EmailOptIn"))


def detect_abandoned(
    carts: DataFrame, subscribers: DataFrame, as_of: Moment, idle_minutes: int = 30, expire_days: int = 14
) -> DataFrame:
    """Idle active carts become Abandoned; then abandoned carts past their life become Expired.

    The second step reads the first one's result, so an old active cart passes both.
    """
    idle = (
        (F.col("CartStatus") == "Active")
        & (F.col("ItemCount") > 0)
        & (F.col("CartLastUpdatedDate") <= shift(as_of, -idle_minutes, "minute"))
    )
    owners = reachable(subscribers).select("SubscriberKey").distinct()
    abandoned = updated_from(carts, owners, ["SubscriberKey"], idle, {"CartStatus": F.lit("Abandoned")})
    stale = (F.col("CartStatus") == "Abandoned") & (
        F.col("CartLastUpdatedDate") <= shift(as_of, -expire_days, "day")
    )
    return updated_where(abandoned, stale, {"CartStatus": F.lit("Expired")})


def recover(carts: DataFrame, checkouts: DataFrame, as_of: Moment) -> DataFrame:
    """Checked-out carts become Converted; RecoveredDate only where the cart had been abandoned."""
    was_abandoned = F.col("CartStatus") == "Abandoned"
    return updated_from(
        carts,
        checkouts.select("CartId").distinct(),
        ["CartId"],
        F.lit(True),
        {
            "CartStatus": F.lit("Converted"),
            "RecoveredDate": F.when(was_abandoned, as_ts(as_of)).otherwise(F.col("RecoveredDate")),
        },
    )


def journey_entries(carts: DataFrame) -> DataFrame:
    """Carts that qualify for the recovery series."""
    return carts.filter((F.col("CartStatus") == "Abandoned") & (F.col("RecoveryEmailsSent") == 0))


def product_blocks(cart_lines: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` newest lines of each cart with the live price and stock of the product."""
    newest = first_k(cart_lines, ["CartId"], [F.col("AddedToCartDate").desc(), F.col("CartLineItemId")], k, "Slot")
    live = products.select("SKU", "ProductName", "Price", "SalePrice", F.col("InStock").alias("_stock"))
    return newest.join(live, "SKU", "left").select(
        "CartId",
        "Slot",
        "SKU",
        "Quantity",
        "ProductName",
        "Price",
        "SalePrice",
        F.coalesce("_stock", F.lit(False)).alias("InStock"),
        F.coalesce((F.col("SalePrice") > 0) & (F.col("SalePrice") < F.col("Price")), F.lit(False)).alias("OnSale"),
    )


# -- discount codes -----------------------------------------------------------
# Life of an allocated code in days, and the shared code used when a pool is empty.
CODE_DAYS = {"AbandonedCart15": 1}
CODE_DAYS_DEFAULT = 7
SHARED_CODES = {"AbandonedCart15": "CARTSAVE15"}
SHARED_CODE_DEFAULT = "CARTSAVE10"


def _by_campaign(table: dict, default: object) -> Column:
    expr = None
    for name, value in table.items():
        hit = F.col("CampaignType") == name
        expr = F.when(hit, F.lit(value)) if expr is None else expr.when(hit, F.lit(value))
    return expr.otherwise(F.lit(default))


def allocate_codes(requests: DataFrame, pool: DataFrame, as_of: Moment) -> DataFrame:
    """The n-th request of a campaign takes its n-th free code; later ones share the fallback code.

    ``requests``: RequestId, SubscriberKey, CampaignType, RequestedDate.  Both sides are
    numbered without a per-campaign task and meet in one equi-join, so no code can be
    given twice.
    """
    asked = positions(requests, ["CampaignType"], [F.col("RequestedDate"), F.col("RequestId")])
    free = positions(
        pool.filter(~F.col("IsUsed")).select("CampaignType", "DiscountCode"), ["CampaignType"], [F.col("DiscountCode")]
    )
    days = _by_campaign(CODE_DAYS, CODE_DAYS_DEFAULT)
    allocated = F.col("DiscountCode").isNotNull()
    return asked.join(free, ["CampaignType", "Position"], "left").select(
        "RequestId",
        "SubscriberKey",
        "CampaignType",
        F.coalesce("DiscountCode", _by_campaign(SHARED_CODES, SHARED_CODE_DEFAULT)).alias("DiscountCode"),
        allocated.alias("Allocated"),
        F.when(allocated, F.date_add(F.to_date(as_ts(as_of)), days)).alias("ExpiresOn"),
    )


def mark_allocated(pool: DataFrame, allocations: DataFrame, as_of: Moment) -> DataFrame:
    """Pool with the allocated codes marked used."""
    taken = allocations.filter("Allocated").select(
        "DiscountCode", F.col("SubscriberKey").alias("_to"), F.col("CampaignType").alias("_campaign")
    )
    now = as_ts(as_of)
    short = F.col("_campaign").isin(*CODE_DAYS)
    expires = F.when(short, shift(as_of, 1, "day")).otherwise(shift(as_of, CODE_DAYS_DEFAULT, "day"))
    return updated_from(
        pool,
        taken,
        ["DiscountCode"],
        ~F.col("IsUsed"),
        {
            "IsUsed": F.lit(True),
            "AllocatedToSubscriberKey": F.col("_to"),
            "AllocatedDate": now,
            "ExpirationDate": expires,
        },
    )


def replenish(pool: DataFrame, staged: DataFrame, as_of: Moment, valid_days: int = 90) -> DataFrame:
    """Add staged codes the pool does not have, then purge unused expired ones."""
    fresh = staged.dropDuplicates(["DiscountCode"]).join(pool.select("DiscountCode"), "DiscountCode", "left_anti")
    added = fresh.select(
        "DiscountCode",
        "CampaignType",
        "DiscountPercent",
        F.lit(False).alias("IsUsed"),
        shift(as_of, valid_days, "day").alias("ExpirationDate"),
    )
    both = pool.unionByName(added, allowMissingColumns=True)
    return deleted_where(both, ~F.col("IsUsed") & (F.col("ExpirationDate") < as_ts(as_of)))


def short_pools(pool: DataFrame, minimum: int = 5000) -> DataFrame:
    """Campaigns whose stock of free codes is below the buffer."""
    free = F.sum(F.when(~F.col("IsUsed"), 1).otherwise(0))
    return pool.groupBy("CampaignType").agg(free.alias("FreeCodes")).filter(F.col("FreeCodes") < minimum)
