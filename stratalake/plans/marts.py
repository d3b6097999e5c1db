"""Marts: one aggregate table per function, on gold facts and staging tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.dates import as_date, in_last, shift_timestamp
from stratalake.functions.text import percent_of
from stratalake.functions.values import growth_pct
from stratalake.operators.dedup import first_n
from stratalake.operators.scd import current_only

GROWTH_DAYS = 180
ROLLING_DAYS = 30
LOYAL_ORDERS, LOYAL_REVENUE = 5, 1000


def month_of(ts: str) -> Column:
    return F.trunc(ts, "month")


def count_of(column: str, value: str) -> Column:
    return F.count_if(F.col(column) == value)


# ---- subscription business -------------------------------------------------------------------------


def fct_daily_active_users(events: DataFrame) -> DataFrame:
    return events.groupBy("event_date").agg(
        F.count_distinct("user_id").alias("dau"),
        F.count("*").alias("total_events"),
        count_of("event_type", "login").alias("logins"),
        count_of("event_type", "signup").alias("signups"),
        count_of("event_type", "upgrade").alias("upgrades"),
        count_of("event_type", "payment_failed").alias("payment_failures"),
    )


def fct_event_funnel(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(
        F.count("*").alias("total_events"),
        F.count_distinct("user_id").alias("unique_users"),
        F.to_date(F.min("occurred_at")).alias("first_seen"),
        F.to_date(F.max("occurred_at")).alias("last_seen"),
    )


def funnel_pct(funnel: DataFrame) -> DataFrame:
    """Users of every step in percent of the top step; the top is one scalar, not a global window."""
    top = funnel.agg(F.max("unique_users").alias("top")).scalar()
    return funnel.select("event_type", "total_events", "unique_users", percent_of(F.col("unique_users"), top).alias("pct_of_top"))


def fct_mrr(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.groupBy("plan", "billing_cycle").agg(
        F.count("*").alias("total_subscribers"),
        F.sum("mrr").alias("total_mrr"),
        F.avg("mrr").alias("avg_mrr"),
        count_of("status", "active").alias("active_subscribers"),
        count_of("status", "cancelled").alias("churned_subscribers"),
    )


def fct_mrr_by_plan(mrr: DataFrame) -> DataFrame:
    return mrr.groupBy("plan").agg(F.sum("total_mrr").alias("total_mrr"))


def fct_customer_churn_rate(subscriptions: DataFrame) -> DataFrame:
    monthly = subscriptions.groupBy(month_of("started_at").alias("month")).agg(
        count_of("status", "cancelled").alias("churned"), F.count("*").alias("total")
    )
    return monthly.select("month", percent_of(F.col("churned"), F.col("total")).alias("churn_rate"), "churned", "total")


def fct_revenue_by_plan(subscriptions: DataFrame) -> DataFrame:
    started = subscriptions.filter(F.col("started_at").isNotNull())
    return started.groupBy("plan", month_of("started_at").alias("month")).agg(F.round(F.sum("mrr"), 2).alias("revenue"))


def cohort_days(subscriptions: DataFrame) -> DataFrame:
    """One row per user and active day with the user's first day.

    Days are collapsed before the window, so a user's group is bounded by the calendar.
    """
    active = subscriptions.select("user_id", F.to_date("started_at").alias("day")).distinct()
    return active.withColumn("cohort_day", F.min("day").over(Window.partitionBy("user_id")))


def fct_weekly_active_users(subscriptions: DataFrame, rows: int = 7) -> DataFrame:
    """Distinct users among the last ``rows`` rows of a cohort, ordered by day and user.

    A cohort can be very large, so it never becomes one window. Users are distinct within a (cohort, day):
    from its row number ``rows`` on, every row sees exactly ``rows`` users. Only the first ``rows - 1`` rows
    of a day look back across days, and for them the last ``rows - 1`` rows of each day are enough. These
    edge rows are picked per map task before the shuffle, and only they go through the cohort window.
    """
    edge = rows - 1
    active = cohort_days(subscriptions)
    day_keys = ["cohort_day", "day"]
    heads = first_n(active, day_keys, [F.col("user_id").asc()], edge).withColumn("is_head", F.lit(1))
    tails = first_n(active, day_keys, [F.col("user_id").desc()], edge).withColumn("is_tail", F.lit(1))
    edges = heads.join(tails, [*day_keys, "user_id"], "full_outer")
    frame = Window.partitionBy("cohort_day").orderBy("day", "user_id").rowsBetween(-edge, 0)
    counted = (
        edges.withColumn("seen", F.size(F.collect_set("user_id").over(frame)))
        .filter(F.col("is_head") == 1)
        .select(*day_keys, "user_id", "seen")
    )
    return active.join(counted, [*day_keys, "user_id"], "left").select(
        "user_id", "day", "cohort_day", F.coalesce("seen", F.lit(rows)).cast("bigint").alias("active_users_7d")
    )


def best_plan(unified: DataFrame) -> DataFrame:
    """The plan with the highest monthly revenue per e-mail."""
    ranked = first_n(
        unified.filter(F.col("email").isNotNull()),
        ["email"],
        [F.col("saas_mrr").desc(), F.col("user_id").asc_nulls_last(), F.col("customer_id").asc_nulls_last()],
        1,
    )
    return ranked.select("email", F.col("saas_plan").alias("plan"), F.col("saas_mrr").alias("mrr"), "total_shopflow_revenue")


def fct_customer_journey(users: DataFrame, unified: DataFrame, churned_status: str = "cancelled") -> DataFrame:
    signup = users.select(
        "email", F.col("created_at").alias("signup_date"), F.col("plan").alias("initial_plan"), F.col("mrr").alias("initial_mrr")
    )
    churn = users.filter(F.col("status") == churned_status).select("email", "status", F.col("ended_at").alias("churn_date"))
    return (
        signup.join(best_plan(unified), "email", "left")
        .join(churn, "email", "left")
        .select(
            "email",
            "signup_date",
            "initial_plan",
            "initial_mrr",
            "plan",
            "mrr",
            "total_shopflow_revenue",
            "churn_date",
            F.when(F.col("status") == churned_status, 1).otherwise(0).alias("is_churned"),
        )
    )


# ---- store -------------------------------------------------------------------------------------------


def with_customer(fact: DataFrame, customers: DataFrame, *cols: str) -> DataFrame:
    """Inner join to the current customer version."""
    return fact.join(current_only(customers).select("customer_id", *cols), "customer_id")


def with_product(fact: DataFrame, products: DataFrame, *cols: str) -> DataFrame:
    return fact.join(products.select("product_id", *cols), "product_id")


def revenue_sum(name: str = "revenue") -> Column:
    return F.round(F.sum("revenue"), 2).alias(name)


def per_customer_revenue(fact: DataFrame) -> DataFrame:
    """Revenue and order count per customer, before any join: the join then moves one row per customer."""
    return fact.groupBy("customer_id").agg(F.sum("revenue").alias("revenue"), F.count("order_id").alias("orders"))


def fct_loyal_customers(fact: DataFrame, customers: DataFrame) -> DataFrame:
    totals = per_customer_revenue(fact).filter((F.col("orders") > LOYAL_ORDERS) & (F.col("revenue") > LOYAL_REVENUE))
    return with_customer(totals, customers, "customer_key", "full_name", "country").select(
        "customer_key", "full_name", "country", F.col("revenue").alias("total_revenue"), F.col("orders").alias("order_count")
    )


def fct_clv_by_segment(fact: DataFrame, customers: DataFrame) -> DataFrame:
    joined = with_customer(per_customer_revenue(fact), customers, "segment")
    return joined.groupBy("segment").agg(F.sum("revenue").alias("lifetime_value"))


def fct_monthly_revenue_by_category(fact: DataFrame, products: DataFrame) -> DataFrame:
    per_product = fact.groupBy("product_id", month_of("order_date").alias("month")).agg(F.sum("revenue").alias("revenue"))
    return with_product(per_product, products, "category").groupBy("month", "category").agg(revenue_sum())


def fct_revenue_by_category(fact: DataFrame) -> DataFrame:
    """Daily revenue per category; the day column is called ``order_month`` in this mart."""
    return fact.groupBy("product_category", F.to_date("order_date").alias("order_month")).agg(
        F.sum("revenue").alias("total_revenue")
    )


def fct_rolling_revenue_by_category(fact: DataFrame, as_of) -> DataFrame:
    recent = fact.filter((F.col("status") == "completed") & in_last(F.col("order_date_day"), ROLLING_DAYS, "day", as_of))
    return recent.groupBy("product_category").agg(F.sum("revenue").alias("total_revenue"))


def monthly_revenue_by(fact: DataFrame, *dims: Column) -> DataFrame:
    return fact.groupBy(month_of("order_date").alias("month"), *dims).agg(revenue_sum())


def month_over_month(current: DataFrame, all_months: DataFrame, dims: list[str]) -> DataFrame:
    """Each month next to the one before it, by an equi join on the shifted month."""
    before = all_months.select(
        F.add_months("month", 1).alias("month"), *dims, F.col("revenue").alias("prev_revenue")
    )
    return current.join(before, ["month", *dims], "left").select(
        "month", *dims, "revenue", "prev_revenue", growth_pct(F.col("revenue"), F.col("prev_revenue")).alias("mom_growth_pct")
    )


def fct_monthly_revenue_trend(fact: DataFrame, as_of) -> DataFrame:
    category = F.col("product_category").alias("category")
    recent = fact.filter(F.col("order_date") >= F.date_sub(as_date(as_of), GROWTH_DAYS))
    return month_over_month(monthly_revenue_by(recent, category), monthly_revenue_by(fact, category), ["category"])


def mom_self_join(fact: DataFrame, as_of) -> DataFrame:
    """The same without a dimension."""
    recent = fact.filter(F.col("order_date") >= F.date_sub(as_date(as_of), GROWTH_DAYS))
    return month_over_month(monthly_revenue_by(recent), monthly_revenue_by(fact), [])


def mom_lag(fact: DataFrame, months: int, as_of) -> DataFrame:
    """Previous month by ``lag`` over the monthly series, for the last ``months`` whole months.

    The window runs over one row per month. Equal to the self join only when no month is missing.
    """
    series = monthly_revenue_by(fact.filter(in_last(F.col("order_date"), months + 1, "month", as_of)))
    previous = F.lag("revenue").over(Window.partitionBy(F.lit(1)).orderBy("month"))
    ranked = series.withColumn("prev_revenue", previous).filter(in_last(F.col("month"), months, "month", as_of))
    return ranked.withColumn("mom_growth_pct", growth_pct(F.col("revenue"), F.col("prev_revenue")))


def fct_top_customers_by_spend(fact: DataFrame, customers: DataFrame, n: int = 10) -> DataFrame:
    totals = with_customer(per_customer_revenue(fact), customers, "full_name")
    spend = totals.select("customer_id", F.col("full_name").alias("name"), F.round("revenue", 2).alias("total_spend"))
    return spend.orderBy(F.desc("total_spend"), "customer_id").limit(n)


def fct_vendor_performance(procurement: DataFrame, vendors: DataFrame, promised_days: int | None = None) -> DataFrame:
    """On-time share and average order size per vendor.

    An order is on time when it arrives within its own lead time (always so for complete dates), or
    within ``promised_days`` when given.
    """
    allowed = F.col("lead_time_days") if promised_days is None else F.lit(promised_days)
    on_time = F.col("delivery_date") <= shift_timestamp(F.col("po_date"), allowed)
    totals = procurement.groupBy("vendor_id", "vendor_key").agg(
        F.count_if(on_time).alias("on_time_deliveries"),
        F.count("*").alias("total_orders"),
        F.sum("amount").alias("total_amount"),
        F.count("po_id").alias("order_count"),
    )
    names = vendors.select("vendor_id", F.col("name").alias("vendor_name"))
    return totals.join(names, "vendor_id", "left").select(
        "vendor_key",
        "vendor_name",
        "total_orders",
        "on_time_deliveries",
        percent_of(F.col("on_time_deliveries"), F.col("total_orders")).alias("on_time_delivery_rate"),
        F.round(F.try_divide(F.col("total_amount").cast("double"), F.col("order_count")), 2).alias("average_order_size"),
    )
