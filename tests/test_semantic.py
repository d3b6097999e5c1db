"""Dimensions of other models, over the entities that models declare."""

import dataclasses

import pytest

from stratalake.plans import semantic
from stratalake.plans.semantic import REGISTRY, FanOut, Measure, Metric, Registry, SemanticModel, Step, join_path


def model(table, entities, dimensions=(), primary=None, condition=None):
    return SemanticModel(table, "at", entities, {d: d for d in dimensions}, {"rows": Measure("count", "id"), "total": Measure("sum", "x")}, condition, primary)


CHAIN = Registry(
    models={
        "lines": model("lines", {"line": "id", "shop": "shop_id", "buyer": "buyer_id"}, ["kind"], "line"),
        "shops": model("shops", {"shop": "id", "town": "town_id"}, ["size"], "shop", "open = 1"),
        "towns": model("towns", {"town": "id"}, ["region", "rank"], "town"),
        "buyers": model("buyers", {"buyer": "id", "town": "home_id"}, ["age"], "buyer"),
        "alone": model("alone", {"x": "id"}, ["colour"], "x"),
    },
    metrics={"lines": Metric("lines", "rows"), "sales": Metric("lines", "total"), "shops": Metric("shops", "rows"), "sales_per_shop": Metric(ratio=("sales", "shops"))},
)


def test_shortest_ways():
    assert join_path(CHAIN, "lines", "kind") == ()
    assert join_path(CHAIN, "lines", "size") == (Step("shop", "shop_id", "shops"),)
    assert join_path(REGISTRY, "orders", "city") == (Step("customer", "customer_key", "customers"),)
    assert join_path(REGISTRY, "orders", "country") == () != join_path(REGISTRY, "orders", "customer__country")
    assert [s.model for s in join_path(REGISTRY, "saas_events", "user_country")] == ["users"]


def test_two_shortest_ways_are_ambiguous():
    with pytest.raises(ValueError, match="ambiguous.*buyer -> town.*shop -> town"):
        join_path(CHAIN, "lines", "region")
    one = dataclasses.replace(CHAIN, models={**CHAIN.models, "buyers": model("buyers", {"buyer": "id"}, ["age"], "buyer")})
    assert [s.entity for s in join_path(one, "lines", "region")] == ["shop", "town"]


@pytest.mark.parametrize("start, dimension", [("shops", "kind"), ("customers", "order_status"), ("towns", "size")])
def test_ways_that_multiply_rows_are_refused(start, dimension):
    with pytest.raises(FanOut, match="many rows"):
        join_path(CHAIN if start in CHAIN.models else REGISTRY, start, dimension)


def test_unknown_and_unconnected_dimensions():
    with pytest.raises(KeyError):
        join_path(CHAIN, "lines", "weight")
    with pytest.raises(FanOut, match="not connected"):
        join_path(CHAIN, "lines", "colour")
    with pytest.raises(FanOut):
        join_path(CHAIN, "lines", "nobody__size")


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "lines": spark.createDataFrame([(1, 1, 1, "a", 5), (2, 1, 2, "b", 7), (3, 2, 1, "a", 11), (4, 9, None, "a", 13), (5, None, 2, "b", 17)], "id int, shop_id int, buyer_id int, kind string, x int"),
        "shops": spark.createDataFrame([(1, 10, "big", 1), (2, 20, "small", 1), (9, 10, "shut", 0)], "id int, town_id int, size string, open int"),
        "towns": spark.createDataFrame([(10, "north", 1), (20, "south", 2)], "id int, region string, rank int"),
        "buyers": spark.createDataFrame([(1, 20, 30), (2, 10, 40)], "id int, home_id int, age int"),
    }


def test_rows_are_kept_and_never_multiplied(tables, rows):
    assert rows(semantic.query_metric(tables, "sales", ["size"], registry=CHAIN)) == sorted([("big", 12), ("small", 11), (None, 30)], key=str)
    both = semantic.query_metric(tables, "sales", ["size", "age", "kind"], registry=CHAIN)
    assert sum(r.sales for r in both.collect()) == 53 and both.columns == ["size", "age", "kind", "sales"]


def test_two_ways_to_one_model(spark, tables, rows):
    """Both ways at once, each asked for by a model that only one way leads to."""
    models = {**CHAIN.models, "homes": model("towns", {"home": "id"}, ["region"], "home"), "buyers": model("buyers", {"buyer": "id", "home": "home_id"}, ["age"], "buyer")}
    registry = dataclasses.replace(CHAIN, models=models)
    found = semantic.query_metric(tables, "lines", ["town__region", "home__region"], registry=registry)
    assert rows(found) == sorted([("north", "south", 1), ("north", "north", 1), ("south", "south", 1), (None, None, 1), (None, "north", 1)], key=str)


def test_ratio_over_a_dimension_of_both_models(tables, rows):
    found = semantic.query_metric(tables, "sales_per_shop", ["size"], registry=CHAIN)
    assert rows(found) == sorted([("big", 12, 1, 12.0), ("small", 11, 1, 11.0), (None, 30, None, None)], key=str)


def test_only_needed_columns_are_joined(tables):
    text = semantic.query_metric(tables, "sales", ["size"], registry=CHAIN)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join") == 1 and "town_id" not in text.split("Project")[1]
