"""Data-quality rules: the DDL constraints and the loader's tuple checks,
applied as column expressions and aggregates instead of failed inserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.dates import date_key
from sparkmart.schemas import GENDERS

# The days of the week (Sunday is 1) that are weekend.
WEEKEND = (1, 7)


def _key_set(c: str) -> Column:
    """A key counts as set when present and non-negative. The loader tests
    ``id > 0`` because an unset Java int is 0; typed columns mark an unset
    key with NULL, so 0 stays a valid key (the test tables start at 0)."""
    return F.coalesce(F.col(c) >= 0, F.lit(False))


def valid_tuple(has_customer: Column | str = "has_customer",
                has_product: Column | str = "has_product") -> Column:
    """The loader's tuple check: keys set, non-negative total and both
    dimension sides found; quantity must also be positive (the fact CHECK)."""
    failed = F.lit(False)
    for _, fails in _rules(has_customer, has_product):
        failed = failed | fails
    return ~failed


def _rules(has_customer: Column | str = "has_customer", has_product: Column | str = "has_product",
           date_from: str | None = None, date_to: str | None = None) -> list[tuple[str, Column]]:
    """(reason, fails) in the order they are tested; never null, so a missing
    value fails its rule."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    no = lambda x: ~F.coalesce(x, F.lit(False))
    d = F.col("order_date")
    dated = d.isNotNull() if date_from is None else \
        d.between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date"))
    return [("unknown customer_id", no(c(has_customer)) | ~_key_set("customer_id")),
            ("unknown product_id", no(c(has_product)) | ~_key_set("product_id")),
            ("quantity not positive", no(F.col("quantity") > 0)),
            ("order_date out of range", no(dated)),
            ("no store", ~_key_set("store_id")),
            ("unit_price not positive", no(F.col("product_price") > 0))]


def reject_reason(date_from: str, date_to: str) -> Column:
    """First failing rule of an enriched transaction, NULL when valid."""
    reason = F.when(F.col("parse_reason").isNotNull(), F.col("parse_reason"))
    for name, fails in _rules(date_from=date_from, date_to=date_to):
        reason = reason.when(fails, F.lit(name))
    return reason


def enrich_with_flags(tx: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Left joins that keep every transaction and flag which side matched.

    Customer keys are reduced to distinct ids first, so the left join cannot
    multiply rows; the product side is unique by id.
    """
    cust = customers.select("customer_id").distinct().withColumn("has_customer", F.lit(True))
    prod = products.select("product_id", "product_price", "store_id") \
        .withColumn("has_product", F.lit(True))
    j = tx.join(cust, "customer_id", "left").join(prod, "product_id", "left")
    return (j.withColumn("has_customer", F.coalesce("has_customer", F.lit(False)))
            .withColumn("has_product", F.coalesce("has_product", F.lit(False)))
            .withColumn("date_id", date_key("order_date"))
            .withColumn("total_sale",
                        (F.col("product_price") * F.col("quantity")).cast("decimal(18,2)")))


def _not_null(table: str, *columns: str) -> list[tuple[str, Column]]:
    return [(f"{table}.{c} not null", F.col(c).isNull()) for c in columns]


def _check(rule: str, holds: Column) -> list[tuple[str, Column]]:
    """A CHECK: what is unknown passes."""
    return [(rule, ~F.coalesce(holds, F.lit(True)))]


def _reference(table: str, key: str, parent: str) -> list[tuple[str, str]]:
    """A foreign key, by the name of its column; a null key refers to nothing."""
    return [(f"{table}.{key} -> {parent}", key)]


def _profile(table: str, rows: DataFrame, pk: str, rules: list[tuple[str, Column | str]],
             parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """(rule, violations) of one table in one pass: flags of all rules are summed
    by primary key, which counts repeats of the key as well, then over all keys.
    The first sum is combined on the mappers, so one hot key is no large group.
    A row breaks the primary key if its key is null or another row has it too
    (of n such rows, n - 1).

    What a row breaks by itself is a bit each of ``own``, so that the joins with
    ``parents`` (key -> table) shuffle only that, the primary and the foreign keys.
    Keys of parents are made distinct, so no row comes twice."""
    own = F.lit(0).cast("long")
    for i, (_, broken) in enumerate(rules):
        if isinstance(broken, Column):
            own = own.bitwiseOR(F.when(broken, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    flagged = rows.select(F.col(pk).alias("k"), own.alias("own"), *(parents or {}))
    for key, parent in (parents or {}).items():
        flagged = flagged.join(parent.select(key).distinct().withColumn(f"__{key}", F.lit(True)), key, "left")
    flags = [f"f{i}" for i in range(len(rules))]
    flagged = flagged.select("k", *[
        (F.shiftright("own", i).bitwiseAND(F.lit(1).cast("long")) if isinstance(broken, Column)
         else (F.col(broken).isNotNull() & F.col(f"__{broken}").isNull())).cast("int").alias(f)
        for i, (f, (_, broken)) in enumerate(zip(flags, rules))])
    by_key = flagged.groupBy("k").agg(F.count("*").alias("n"), *[F.sum(f).alias(f) for f in flags])
    repeats = F.sum(F.when(F.col("k").isNull(), F.col("n")).otherwise(F.col("n") - 1))
    total = by_key.agg(repeats.alias("k"), *[F.sum(f).alias(f) for f in flags])
    named = [(f"{table} primary key", "k"), *((rule, f) for f, (rule, _) in zip(flags, rules))]
    return total.select(F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias("violations"))
        for rule, c in named])).alias("r")).select("r.rule", "r.violations")


def constraint_violations(fact: DataFrame, product: DataFrame, store: DataFrame,
                          dates: DataFrame, customer: DataFrame, transactions: DataFrame,
                          date_from: str, date_to: str, gender: str = "gender",
                          genders: tuple[str, ...] = GENDERS) -> DataFrame:
    """One (rule, violations) row for each NOT NULL, CHECK, primary key and foreign
    key of the schema. Each table is read once: all its rules are flags of one
    scan, its foreign keys flags of left joins with the parents' keys."""
    in_range = F.col("full_date").between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date"))
    parts = [
        _profile("dim_customer", customer, "customer_id",
                 _not_null("dim_customer", "customer_name")
                 + _check(f"dim_customer.{gender} allowed", F.col(gender).isin(*genders))),
        _profile("dim_store", store, "store_id", _not_null("dim_store", "store_name")),
        _profile("dim_product", product, "product_id",
                 _not_null("dim_product", "product_name", "product_price", "supplier_id", "supplier_name")
                 + _reference("dim_product", "store_id", "dim_store"), {"store_id": store}),
        _profile("dim_date", dates, "date_id",
                 _not_null("dim_date", "full_date", "year", "quarter", "month", "month_name", "day_of_month",
                           "day_of_week", "day_name")
                 + _check("dim_date.is_weekend generated",
                          F.col("is_weekend") == F.col("day_of_week").isin(*WEEKEND))
                 + _check("dim_date.date_range", in_range)),
        _profile("transactions", transactions, "order_id",
                 _not_null("transactions", "order_date", "product_id", "customer_id", "quantity")
                 + _reference("transactions", "product_id", "dim_product")
                 + _reference("transactions", "customer_id", "dim_customer"),
                 {"product_id": product, "customer_id": customer}),
        _profile("fact", fact, "sale_id",
                 _not_null("fact", "order_id", "order_date", "quantity", "unit_price")
                 + _check("fact.quantity > 0", F.col("quantity") > 0)
                 + _check("fact.unit_price > 0", F.col("unit_price") > 0)
                 + _reference("fact", "date_id", "dim_date") + _reference("fact", "customer_id", "dim_customer")
                 + _reference("fact", "product_id", "dim_product") + _reference("fact", "store_id", "dim_store"),
                 {"date_id": dates, "customer_id": customer, "product_id": product, "store_id": store}),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
