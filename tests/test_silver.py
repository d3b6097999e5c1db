import datetime as dt


from stratalake.plans import gold, marts, profile360, silver
from stratalake.sources import bronze

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
CUSTOMER = "customer_id bigint, first_name string, last_name string, email string, phone string, segment string, country string, city string, created_at timestamp, updated_at timestamp"
ORDER = "order_id bigint, customer_id bigint, product_id bigint, amount double, quantity int, status string, order_date timestamp, updated_at timestamp"


def customer(key, email="a@b.com", segment="B2B", updated=T0, **other):
    row = {"first": " Ann ", "last": "Lee", "phone": "", "country": " de ", "city": "Ulm", **other}
    return (key, row["first"], row["last"], email, row["phone"], segment, row["country"], row["city"], T0, updated)


def test_customers_are_cleaned_and_deduplicated(spark):
    df = spark.createDataFrame(
        [
            customer(1, " a@b.com ", "vip"),
            customer(1, "new@b.com", "other", updated=T1),
            customer(0),
            customer(2, ""),
            customer(3, "no-at-sign"),
        ],
        CUSTOMER,
    )
    out = silver.stg_customers(df, "2024-01-11").collect()
    assert len(out) == 1
    row = out[0]
    assert (row.customer_id, row.email, row.segment, row.full_name) == (1, "new@b.com", "B2C", "Ann Lee")
    assert (row.phone, row.country, row.days_since_signup) == (None, "DE", 10)


def test_order_status_and_revenue(spark):
    df = spark.createDataFrame(
        [
            (1, 1, 1, 10.0, 1, "COMPLETED", T0, T0),
            (2, 1, 1, 10.0, 1, "refunded", T0, T0),
            (3, 1, 1, 10.0, 1, "pending", T0, T0),
            (3, 1, 1, 12.0, 1, "completed", T0, T1),
            (4, 1, None, 10.0, 1, "completed", T0, T0),
            (5, 1, 1, 0.0, 1, "completed", T0, T0),
        ],
        ORDER,
    )
    out = {r.order_id: (r.status, float(r.revenue)) for r in silver.stg_orders(df).collect()}
    assert out == {1: ("completed", 10.0), 2: ("pending", 0.0), 3: ("completed", 12.0)}
    assert silver.stg_orders(df, require_product=False).filter("order_id = 4").count() == 1


def test_products_floor_stock_and_tier(spark):
    df = spark.createDataFrame(
        [(1, " pen ", "e-commerce", 49.99, -3, " ab-1 ", T0, T0)],
        "product_id bigint, name string, category string, price double, stock_qty int, sku string, created_at timestamp, updated_at timestamp",
    )
    row = silver.stg_products(df).first()
    assert (row["name"], row.category, row.stock_qty, row.sku, row.price_tier) == ("pen", "E-Commerce", 0, "AB-1", "Budget")
    assert gold.dim_products(silver.stg_products(df)).first().is_in_stock == 0


def test_soft_deleted_rows_stay_out(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "2024-01-01")], "id int, _ab_cdc_deleted_at string")
    assert sorted(r.id for r in bronze.not_deleted(df).collect()) == [1, 2]


def test_user_with_two_subscriptions_appears_once(spark):
    users = spark.createDataFrame(
        [(1, "u@x", "pro", 9.0, "churned", "DE", "C", T0, 3)],
        "user_id bigint, email string, plan string, mrr double, status string, country string, company string, created_at timestamp, days_since_signup int",
    )
    subs = spark.createDataFrame(
        [(10, 1, "monthly", T0, T1), (11, 1, "annual", T1, T1)],
        "subscription_id bigint, user_id bigint, billing_cycle string, started_at timestamp, ended_at timestamp",
    )
    out = gold.dim_users(users, subs).collect()
    assert [(r.billing_cycle, r.is_churned, r.is_free) for r in out] == [("annual", 1, 0)]


def unified(spark, customers, users, orders):
    c = spark.createDataFrame(customers, "customer_id bigint, email string, full_name string, segment string, country string, city string, is_current int")
    u = spark.createDataFrame(users, "user_id bigint, email string, plan string, mrr double, status string, company string, country string, is_churned int")
    o = spark.createDataFrame(orders, "customer_id bigint, revenue bigint")
    return profile360.unified_customers(c, u, o, "2024-01-01")


def test_three_customer_types(spark):
    df = unified(
        spark,
        [(1, "a@x", "A", "VIP", "DE", None, 1), (2, "b@x", "B", "VIP", "DE", None, 1), (3, "c@x", "C", "VIP", "DE", None, 0)],
        [(7, " A@X ", "pro", 9.0, "active", "Co", "US", 0), (8, "z@x", "pro", 9.0, "active", "Co", "US", 1)],
        [(1, 5), (1, 6)],
    )
    out = {r.email: r for r in df.collect()}
    assert {e: r.customer_type for e, r in out.items()} == {"a@x": "cross_domain", "b@x": "shopflow_only", "z@x": "saas_only"}
    assert (out["a@x"].shopflow_order_count, out["a@x"].total_shopflow_revenue) == (2, 11.0)
    assert (out["b@x"].shopflow_order_count, out["b@x"].saas_mrr, out["b@x"].is_churned) == (0, 0.0, 0)


def test_union_form_equals_the_full_outer_join(spark):
    """NULL and repeated e-mails on both sides behave as in a full outer join."""
    emails = ["a@x", "a@x", "b@x", None]
    customers = [(i, e, "n", "VIP", "DE", None, 1) for i, e in enumerate(emails)]
    users = [(i + 10, e, "pro", 1.0, "active", "Co", "US", 0) for i, e in enumerate(["a@x", "a@x", "c@x", None])]
    df = unified(spark, customers, users, [(0, 1)])
    left = spark.createDataFrame([(c[0], c[1]) for c in customers], "customer_id bigint, email string")
    right = spark.createDataFrame([(u[0], u[1]) for u in users], "user_id bigint, email string")
    expected = left.join(right, "email", "full_outer").select("customer_id", "user_id", "email")
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, df.select("customer_id", "user_id", "email").collect()), key=key) == sorted(map(tuple, expected.collect()), key=key)


def test_weekly_actives_equal_the_plain_window(spark):
    """Against brute force, with one cohort that holds most rows."""
    pairs = {(u, d) for u in range(40) for d in range(1, 9) if (u * 7 + d * 3) % 5 < 2 or d == 1}
    pairs |= {(u, d) for u in range(100, 112) for d in range(3, 12) if (u + d) % 3}
    rows = [(u, dt.datetime(2024, 1, d, 5)) for u, d in pairs]
    out = marts.fct_weekly_active_users(spark.createDataFrame(rows, "user_id bigint, started_at timestamp")).collect()
    first = {}
    for u, d in pairs:
        first[u] = min(first.get(u, d), d)
    expected = {}
    for cohort in set(first.values()):
        ordered = sorted((d, u) for u, d in pairs if first[u] == cohort)
        for i, (d, u) in enumerate(ordered):
            expected[(u, d)] = len({x[1] for x in ordered[max(0, i - 6) : i + 1]})
    assert {(r.user_id, r.day.day): r.active_users_7d for r in out} == expected


def test_churn_of_an_empty_month_is_null_not_an_error(spark):
    df = spark.createDataFrame([], "user_id bigint, started_at timestamp, status string")
    assert marts.fct_customer_churn_rate(df).count() == 0


def test_month_over_month_skips_missing_months(spark):
    rows = [(1, dt.datetime(2024, 1, 5), 100), (2, dt.datetime(2024, 3, 5), 50), (3, dt.datetime(2024, 4, 5), 75)]
    fact = spark.createDataFrame(rows, "order_id bigint, order_date timestamp, revenue bigint")
    out = {r.month.month: r.mom_growth_pct for r in marts.mom_self_join(fact, "2024-04-30").collect()}
    assert out == {1: None, 3: None, 4: 50.0}


def test_left_join_keeps_orders_of_unknown_customers(spark):
    orders = spark.createDataFrame([(1, 1), (2, 9)], "order_id bigint, customer_id bigint")
    customers = spark.createDataFrame([(1, "VIP", 1), (9, "B2B", 0)], "customer_id bigint, segment string, is_current int")
    from stratalake.plans.recipes import left_join_current

    out = {r.segment: r.orders for r in left_join_current(orders, customers).collect()}
    assert out == {"VIP": 1, None: 1}
