"""The ten OLAP reports over the star, each ``f(star, **params) -> DataFrame``.

Plan shape shared by all of them: aggregate the fact on integer keys (map-side
partial aggregation, one shuffle on the group keys), then look descriptive
columns up on the reduced result. Whole-partition window aggregates whose
partitions would grow with the data are written as an aggregate plus a join
of the totals; windows are kept only where a partition is bounded by the
calendar (at most one row per day/month/quarter per key) or cut by a rank
limit (``WindowGroupLimit`` runs before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.functions import (
    growth_pct, half_year, money, round2, safe_divide, season,
    season_order, spike_label, volatility_pct, year_month,
)
from sparkmart.operators.joins import attach, join_bounded
from sparkmart.operators.rollup import rollup_distinct
from sparkmart.sources.testdata import Star


def _year_range(year: int):
    """YEAR(d) = y as a date range, so the filter reaches the Parquet scan."""
    d = F.col("order_date")
    return (d >= F.lit(f"{year:04d}-01-01").cast("date")) & \
        (d < F.lit(f"{year + 1:04d}-01-01").cast("date"))


# Q1 -------------------------------------------------------------------------
def q01_top_products_by_day_type(star: Star, top_n: int = 5) -> DataFrame:
    """Top products by revenue per year, month and weekday/weekend.

    RANK keeps ties, so a group may return more than ``top_n`` rows.
    """
    f = star.fact.select("date_id", "order_date", "product_id", "total_sale")
    d = star.dim_date.select("date_id", "is_weekend")
    agg = (join_bounded(f, d, "date_id")
           .groupBy(F.year("order_date").alias("sale_year"),
                    F.month("order_date").alias("sale_month"),
                    "is_weekend", "product_id")
           .agg(F.sum("total_sale").alias("revenue")))
    w = Window.partitionBy("sale_year", "sale_month", "is_weekend").orderBy(F.desc("revenue"))
    top = agg.withColumn("revenue_rank", F.rank().over(w)).filter(F.col("revenue_rank") <= top_n)
    out = attach(top, star.dim_product, "product_id", ["product_name"])
    return (out.select(
        "sale_year", "sale_month",
        F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("day_type"),
        "product_name",
        round2("revenue").alias("total_revenue"),
        "is_weekend")
        .orderBy("sale_year", "sale_month", "is_weekend", F.desc("total_revenue"), "product_name")
        .drop("is_weekend"))


def available_years(star: Star) -> DataFrame:
    return (star.fact.select(F.year("order_date").alias("available_years"))
            .distinct().orderBy("available_years"))


# Q2 -------------------------------------------------------------------------
def q02_store_quarter_growth(star: Star, year: int = 1997) -> DataFrame:
    """Quarter-on-quarter revenue growth per store within one year.

    The year filter applies before LAG, so each store's first quarter of the
    year has no previous value. LAG is by row, not by calendar.
    """
    f = star.fact.filter(_year_range(year)).select("store_id", "order_date", "total_sale")
    agg = (f.groupBy("store_id", F.quarter("order_date").alias("quarter"))
           .agg(F.sum("total_sale").alias("rev")))
    agg = attach(agg, star.dim_store, "store_id", ["store_name"], bounded=True)
    w = Window.partitionBy("store_id").orderBy("quarter")
    agg = agg.withColumn("prev", F.lag("rev").over(w))
    return (agg.select(
        "store_name", "quarter",
        round2("rev").alias("quarterly_revenue"),
        round2("prev").alias("prev_quarter_revenue"),
        growth_pct("rev", "prev").alias("growth_rate_percentage"))
        .orderBy("store_name", "quarter"))


# Q3 -------------------------------------------------------------------------
def q03_supplier_contribution(star: Star) -> DataFrame:
    """Each product's share of its store's revenue.

    SUM(SUM(x)) OVER (PARTITION BY store) is computed as a per-store total
    (one row per store, broadcast) instead of a window whose partition would
    hold every product of a store in one task.
    """
    by_prod = (star.fact.groupBy("store_id", "product_id")
               .agg(F.sum("total_sale").alias("sales")))
    totals = by_prod.groupBy("store_id").agg(F.sum("sales").alias("store_total"))
    j = join_bounded(by_prod, totals, "store_id")
    j = attach(j, star.dim_store, "store_id", ["store_name"], bounded=True)
    j = attach(j, star.dim_product, "product_id",
               ["supplier_id", "supplier_name", "product_name"])
    return (j.select(
        "store_name", "supplier_name", "product_name",
        round2("sales").alias("total_sales"),
        round2(safe_divide("sales", "store_total") * 100).alias("contribution_percentage"))
        .orderBy("store_name", "supplier_name", F.desc("total_sales"), "product_name"))


# Q4 -------------------------------------------------------------------------
def q04_seasonal_sales(star: Star) -> DataFrame:
    """Sales per product and season, all years merged."""
    agg = (star.fact.groupBy("product_id", season("order_date").alias("season"))
           .agg(F.sum("total_sale").alias("sales"), F.count(F.lit(1)).alias("number_of_sales")))
    agg = attach(agg, star.dim_product, "product_id", ["product_name"])
    return (agg.select(
        "product_name", "season",
        round2("sales").alias("total_sales"),
        "number_of_sales",
        round2(safe_divide("sales", "number_of_sales")).alias("avg_sale_per_transaction"))
        .orderBy("product_name", season_order("season")))


# Q5 -------------------------------------------------------------------------
def q05_monthly_volatility(star: Star) -> DataFrame:
    """Absolute month-on-month revenue change per store and supplier.

    The fact is first reduced per (store, product, month); the product lookup
    then runs on that aggregate. LAG is partitioned by supplier id and name,
    so an id that carries two names never reads the other name's month.
    """
    by_prod = (star.fact.groupBy("store_id", "product_id",
                                 year_month("order_date").alias("sales_month"))
               .agg(F.sum("total_sale").alias("rev")))
    by_prod = attach(by_prod, star.dim_product, "product_id", ["supplier_id", "supplier_name"])
    agg = (by_prod.groupBy("store_id", "supplier_id", "supplier_name", "sales_month")
           .agg(F.sum("rev").alias("rev")))
    agg = attach(agg, star.dim_store, "store_id", ["store_name"], bounded=True)
    w = Window.partitionBy("store_id", "supplier_id", "supplier_name").orderBy("sales_month")
    agg = agg.withColumn("prev", F.lag("rev").over(w))
    return (agg.select(
        "store_name", "supplier_name", "sales_month",
        round2("rev").alias("monthly_revenue"),
        round2("prev").alias("prev_month_revenue"),
        volatility_pct("rev", "prev").alias("volatility_percentage"))
        .orderBy("store_name", "supplier_name", "sales_month"))


# Q7 -------------------------------------------------------------------------
def q07_revenue_rollup(star: Star, include_grand_total: bool = True) -> DataFrame:
    """Revenue, distinct orders and order value at five ROLLUP levels.

    The fact is rolled up on ids, level from level (``rollup_distinct``); names
    are joined to the sums. Subtotal rows are labelled by their level, never by
    NULL tests, so a real NULL key cannot be mistaken for a subtotal. The literal
    reference keeps the grand total (its HAVING tests a never-NULL alias);
    ``include_grand_total=False`` gives the intended variant.
    """
    # rows of one name are one group: the smallest id of a name stands for it
    stores, products = star.dim_store, star.dim_product
    named = {key: dim.groupBy(name).agg(F.min(dim_id).alias(key)) for key, dim, dim_id, name in (
        ("st", stores, "store_id", "store_name"), ("su", products, "supplier_id", "supplier_name"),
        ("pr", products, "product_id", "product_name"))}

    def with_id(dim: DataFrame, name: str, key: str) -> DataFrame:
        ids = named[key].withColumnRenamed(name, "__name")
        return dim.join(ids, dim[name].eqNullSafe(F.col("__name"))).drop("__name")

    products = with_id(with_id(products, "product_name", "pr"), "supplier_name", "su")
    f = star.fact.select(F.year("order_date").alias("y"), "order_id", "store_id", "product_id", "total_sale")
    f = attach(f, with_id(stores, "store_name", "st"), "store_id", ["st"])
    f = attach(f, products, "product_id", ["pr", "su"])
    sums = rollup_distinct(f, ["y", "st", "su", "pr"], "order_id", "total_sale")
    if not include_grand_total:
        sums = sums.filter(F.col("level") > 0)
    for key, lookup in named.items():
        sums = sums.join(lookup, key, "left")

    def label(c: str, kept: int, text: str):
        return F.when(F.col("level") < kept, F.lit(text)).otherwise(F.col(c).cast("string"))

    return (sums.select(
        label("y", 1, "Total").alias("year"),
        label("store_name", 2, "All Stores").alias("store_name"),
        label("supplier_name", 3, "All Suppliers").alias("supplier_name"),
        label("product_name", 4, "All Products").alias("product_name"),
        round2("total").alias("total_revenue"),
        F.col("n").alias("number_of_orders"),
        round2(safe_divide("total", "n")).alias("avg_order_value"))
        .orderBy("year", "store_name", "supplier_name", "product_name"))


# Q8 -------------------------------------------------------------------------
def q08_half_year(star: Star) -> DataFrame:
    """H1/H2 quantity and revenue per product name and year."""
    by_prod = (star.fact.groupBy("product_id", F.year("order_date").alias("sale_year"),
                                 half_year("order_date").alias("half"))
               .agg(F.sum("quantity").alias("q"), F.sum("total_sale").alias("r")))
    by_prod = attach(by_prod, star.dim_product, "product_id", ["product_name"])
    h1 = F.col("half") == "H1"
    h2 = F.col("half") == "H2"
    agg = (by_prod.groupBy("product_name", "sale_year").agg(
        F.sum(F.when(h1, F.col("q")).otherwise(0)).alias("h1_quantity"),
        F.sum(F.when(h1, F.col("r")).otherwise(0)).alias("h1r"),
        F.sum(F.when(h2, F.col("q")).otherwise(0)).alias("h2_quantity"),
        F.sum(F.when(h2, F.col("r")).otherwise(0)).alias("h2r"),
        F.sum("q").alias("yearly_quantity"),
        F.sum("r").alias("yr")))
    return (agg.select(
        "product_name", "sale_year",
        "h1_quantity", money("h1r").alias("h1_revenue"),
        "h2_quantity", money("h2r").alias("h2_revenue"),
        "yearly_quantity", money("yr").alias("yearly_revenue"),
        round2(safe_divide(F.col("h2r") - F.col("h1r"), "h1r") * 100)
        .alias("revenue_growth_percentage"))
        .orderBy("sale_year", F.desc("yearly_revenue"), "product_name"))


# Q9 -------------------------------------------------------------------------
def daily_product_stats(star: Star) -> DataFrame:
    """Per product and day: daily sales, and the product's n, sum, sum of squares.

    A product has at most one row per calendar day, so the per-product window
    is bounded by the calendar even for the hottest product.
    """
    daily = (star.fact.groupBy("product_id", "order_date")
             .agg(F.sum("total_sale").alias("daily")))
    w = Window.partitionBy("product_id")
    return (daily
            .withColumn("n", F.count(F.lit(1)).over(w))
            .withColumn("total", F.sum("daily").over(w))
            .withColumn("sumsq", F.sum(F.col("daily") * F.col("daily")).over(w)))


def q09_revenue_spikes(star: Star, only_high: bool = True) -> DataFrame:
    """Days on which a product sold more than twice its mean over sales days.

    Mean and population standard deviation are computed from exact decimal
    sums: mean = total/n, sd = sqrt(n*sumsq - total^2)/n, and the spike test
    is daily*n > 2*total, so no row at exactly twice the mean can flip.
    """
    s = daily_product_stats(star)
    if only_high:
        s = s.filter(F.col("daily") * F.col("n") > F.col("total") * 2)
    s = attach(s, star.dim_product, "product_id", ["product_name"])
    dev = F.col("daily") * F.col("n") - F.col("total")            # n*(x - mean), exact
    spread = F.col("sumsq") * F.col("n") - F.col("total") * F.col("total")  # n^2 * var, exact
    return (s.select(
        "product_name", "order_date",
        round2("daily").alias("daily_sales"),
        round2(safe_divide("total", "n")).alias("average_daily_sales"),
        round2(safe_divide(dev, F.sqrt(spread.cast("double")))).alias("z_score"),
        spike_label("daily", "total", "n").alias("sales_pattern"),
        round2(safe_divide(dev, "total") * 100).alias("percentage_deviation"))
        .orderBy(F.desc("percentage_deviation"), "product_name", "order_date"))


# Q10 ------------------------------------------------------------------------
def q10_store_quarter_view(star: Star, year: int | None = None) -> DataFrame:
    """Store quarterly metrics (the STORE_QUARTERLY_SALES view).

    Three distinct counts are split into two aggregates joined on the small
    (store, year, quarter) key: orders are counted in one pass over the fact;
    products and suppliers are counted on the distinct (store, quarter,
    product) set, after which the product lookup is cheap.
    """
    f = star.fact
    if year is not None:
        f = f.filter(_year_range(year))
        if "sale_year" in f.columns:
            f = f.filter(F.col("sale_year") == year)
    stored = "sale_year" in f.columns  # a stored fact is partitioned by it: a filter on it prunes
    f = f.select("store_id", "sale_year" if stored else F.year("order_date").alias("sale_year"),
                 F.quarter("order_date").alias("quarter"),
                 "order_id", "product_id", "quantity", "total_sale")
    keys = ["store_id", "sale_year", "quarter"]
    a = f.groupBy(*keys).agg(F.sum("total_sale").alias("rev"),
                             F.countDistinct("order_id").alias("number_of_orders"),
                             F.sum("quantity").alias("total_units_sold"))
    prods = f.select(*keys, "product_id").distinct()
    prods = attach(prods, star.dim_product, "product_id", ["supplier_id"])
    b = prods.groupBy(*keys).agg(F.countDistinct("supplier_id").alias("number_of_suppliers"),
                                 F.count(F.lit(1)).alias("number_of_products"))
    j = a.join(b, keys)
    j = attach(j, star.dim_store, "store_id", ["store_name"], bounded=True)
    return (j.select(
        "store_name", "sale_year", "quarter",
        round2("rev").alias("quarterly_revenue"),
        "number_of_orders", "total_units_sold",
        round2(safe_divide("rev", "number_of_orders")).alias("avg_order_value"),
        "number_of_suppliers", "number_of_products",
        round2(safe_divide("rev", "total_units_sold")).alias("revenue_per_unit"),
        round2(safe_divide("rev", "number_of_orders")).alias("revenue_per_order"))
        .orderBy("store_name", "sale_year", "quarter"))
