"""Product picks per recipient: welcome grid and cross-sell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifeloom.functions.joins import sized
from lifeloom.functions.ranking import first_k

# How many products a category list holds and how many are shown.
GRID = 4
CROSS_SELL_POOL = 8
DEFAULT_CATEGORY = "Womens"


def top_in_stock(products: DataFrame, k: int) -> DataFrame:
    """Best-rated in-stock products of every category: at most ``k`` rows per category."""
    return first_k(
        products.filter("InStock").select("SKU", "ProductName", "Category", "Price", "SalePrice", "AvgRating"),
        ["Category"],
        [F.col("AvgRating").desc(), F.col("SKU")],
        k,
        "Slot",
    )


def primary_category(subscribers: DataFrame, preferences: DataFrame, default: str = DEFAULT_CATEGORY) -> DataFrame:
    """Womens, else Mens, else the default; without a preference row both count as chosen."""
    prefs = preferences.select("SubscriberKey", "CategoryWomens", "CategoryMens")
    womens = F.coalesce("CategoryWomens", F.col("CategoryMens").isNull())
    category = F.when(womens, "Womens").when(F.col("CategoryMens"), "Mens").otherwise(default)
    return subscribers.select("SubscriberKey").join(prefs, "SubscriberKey", "left").select(
        "SubscriberKey", category.alias("Category")
    )


def welcome_products(
    subscribers: DataFrame, preferences: DataFrame, products: DataFrame, default: str = DEFAULT_CATEGORY
) -> DataFrame:
    """Four best in-stock products of each recipient's primary category."""
    chosen = primary_category(subscribers, preferences, default)
    return chosen.join(sized(grid_list(products, GRID)), "Category").select(
        "SubscriberKey", "Category", F.explode("_grid").alias("_p")
    ).select("SubscriberKey", "Category", "_p.Slot", "_p.SKU")


def grid_list(products: DataFrame, k: int) -> DataFrame:
    """One row per category with its ranked list of at most ``k`` products.

    Few categories meet many recipients: with a list side proven small the recipients need
    not be moved to the few partitions their categories would hash to.
    """
    item = F.struct("Slot", "SKU")
    return top_in_stock(products, k).groupBy("Category").agg(F.array_sort(F.collect_list(item)).alias("_grid"))


def cross_sell(
    order_lines: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    default: str = DEFAULT_CATEGORY,
    keep: int = GRID,
    pool: int = CROSS_SELL_POOL,
) -> DataFrame:
    """Per order: products of its first category, minus what was bought, best rated first.

    Only the SKUs that are on some category list matter for the exclusion, so a large
    order never collects all its lines: they are reduced against the lists first.
    """
    listed = top_in_stock(products, pool).select("Category", F.col("Slot").alias("_slot"), "SKU")
    lists = listed.groupBy("Category").agg(F.array_sort(F.collect_list(F.struct("_slot", "SKU"))).alias("_list"))
    # One exchange of the lines: listed SKUs are marked before it, the order's first category and its listed SKUs come out of it.
    marks = listed.select(F.col("SKU").alias("_mark")).distinct()
    marked = order_lines.select("OrderId", "LineItemId", "Category", "SKU").join(marks, F.col("SKU") == F.col("_mark"), "left")
    lines = marked.groupBy("OrderId").agg(F.min_by("Category", "LineItemId").alias("_category"), F.collect_set("_mark").alias("_bought"))
    wanted = orders.select("OrderId").join(lines, "OrderId", "left").select(
        "OrderId", F.coalesce(F.nullif("_category", F.lit("")), F.lit(default)).alias("Category"), "_bought"
    )
    rest = F.filter("_list", lambda p: ~F.array_contains(F.coalesce("_bought", F.array().cast("array<string>")), p["SKU"]))
    return (
        wanted.join(lists, "Category")
        .select("OrderId", "Category", F.posexplode(F.slice(rest, 1, keep)).alias("_pos", "_p"))
        .select("OrderId", "Category", (F.col("_pos") + 1).cast("bigint").alias("Slot"), F.col("_p.SKU").alias("SKU"))
    )
