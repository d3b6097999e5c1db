"""Semantic layer: measures and metrics declared once, queried by any dimension and time grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.dates import as_date
from stratalake.operators.quality import union_all, unpivot_rows

AGGREGATES = {"count": F.count, "sum": F.sum, "average": F.avg, "count_distinct": F.count_distinct}


@dataclass(frozen=True)
class Measure:
    agg: str
    expr: str

    def column(self) -> Column:
        return AGGREGATES[self.agg](F.col(self.expr))


@dataclass(frozen=True)
class SemanticModel:
    """A table with its default time column, entities and dimensions (name -> column) and measures.

    ``primary`` names the entity that identifies a row; the other entities refer to the models in which they are primary.
    """

    table: str
    time: str
    entities: Mapping[str, str]
    dimensions: Mapping[str, str]
    measures: Mapping[str, Measure]
    condition: str | None = None
    primary: str | None = None


@dataclass(frozen=True)
class Metric:
    """A measure of a model, or a ratio of two metrics."""

    model: str | None = None
    measure: str | None = None
    ratio: tuple[str, str] | None = None


@dataclass(frozen=True)
class Registry:
    models: Mapping[str, SemanticModel]
    metrics: Mapping[str, Metric]
    names: tuple[str, ...] = field(default=())

    def metric(self, name: str) -> Metric:
        if name not in self.metrics:
            raise KeyError(f"unknown metric {name!r}; known: {sorted(self.metrics)}")
        return self.metrics[name]


REGISTRY = Registry(
    models={
        "orders": SemanticModel(
            table="fct_orders",
            time="order_date",
            entities={"order": "order_id", "customer": "customer_key", "product": "product_key"},
            dimensions={"order_status": "status", "customer_segment": "customer_segment", "country": "customer_country"},
            primary="order",
            measures={
                "total_orders": Measure("count", "order_id"),
                "total_revenue": Measure("sum", "revenue"),
                "avg_order_value": Measure("average", "revenue"),
            },
        ),
        "customers": SemanticModel(
            table="dim_customers",
            time="valid_from",
            entities={"customer": "customer_key"},
            dimensions={"country": "country", "customer_segment": "segment", "city": "city"},
            measures={"total_customers": Measure("count", "customer_key")},
            condition="is_current = 1",
            primary="customer",
        ),
        "products": SemanticModel(
            table="dim_products",
            time="created_at",
            entities={"product": "product_key"},
            dimensions={"category": "category", "price_tier": "price_tier"},
            measures={"total_products": Measure("count", "product_key")},
            primary="product",
        ),
        "users": SemanticModel(
            table="dim_users",
            time="created_at",
            entities={"user": "user_id"},
            dimensions={"user_country": "country", "user_plan": "plan", "billing_cycle": "billing_cycle"},
            measures={"total_users": Measure("count", "user_id")},
            primary="user",
        ),
        "saas_subscriptions": SemanticModel(
            table="stg_subscriptions",
            time="started_at",
            entities={"subscription": "subscription_id", "user": "user_id"},
            primary="subscription",
            dimensions={"plan": "plan"},
            measures={"mrr": Measure("sum", "mrr"), "subscriber_count": Measure("count_distinct", "user_id")},
        ),
        "saas_events": SemanticModel(
            table="stg_events",
            time="occurred_at",
            entities={"user": "user_id"},
            dimensions={"event_type": "event_type", "page": "page"},
            measures={"daily_active_users": Measure("count_distinct", "user_id")},
        ),
    },
    metrics={
        "revenue": Metric("orders", "total_revenue"),
        "orders_count": Metric("orders", "total_orders"),
        "avg_order_value": Metric("orders", "avg_order_value"),
        "active_customers": Metric("customers", "total_customers"),
        "mrr": Metric("saas_subscriptions", "mrr"),
        "subscribers": Metric("saas_subscriptions", "subscriber_count"),
        "dau": Metric("saas_events", "daily_active_users"),
        "revenue_per_customer": Metric(ratio=("revenue", "active_customers")),
    },
)


def _grain(time: str, grain: str) -> Column:
    """Start of the period as a date."""
    return F.to_date(F.date_trunc(grain, F.col(time)))


class FanOut(ValueError):
    """A dimension can only be reached by a step that would multiply the rows of the metric."""


@dataclass(frozen=True)
class Step:
    """A many-to-one join: the column that refers to an entity, and the model that the entity identifies."""

    entity: str
    column: str
    model: str


def join_path(registry: Registry, start: str, dimension: str) -> tuple[Step, ...]:
    """The shortest way of many-to-one steps from a model to one that declares ``dimension``; empty if it is the model itself.

    ``entity__dimension`` asks for the way whose last step is that entity. Two shortest ways are an error, as is a way that exists only
    against the direction of the references.
    """
    entity, _, name = dimension.rpartition("__")
    owners = {m for m, model in registry.models.items() if name in model.dimensions}
    if not owners:
        raise KeyError(f"no model declares dimension {name!r}")
    if start in owners and not entity:
        return ()
    level: list[tuple[str, tuple[Step, ...]]] = [(start, ())]
    seen = {start}
    while level:
        found, following = [], []
        for at, path in level:
            for step in _steps(registry, at):
                if step.model not in seen:
                    following.append((step.model, (*path, step)))
        found = [path for to, path in following if to in owners and entity in ("", path[-1].entity)]
        if len(found) > 1:
            raise ValueError(f"{dimension!r} of {start!r} is ambiguous: {sorted(' -> '.join(s.entity for s in p) for p in found)}")
        if found:
            return found[0]
        seen |= {to for to, _ in following}
        level = following
    raise FanOut(f"{dimension!r} of {start!r}: only reached by steps to many rows" if _connected(registry, start, owners) else f"{dimension!r} is not connected to {start!r}")


def _steps(registry: Registry, at: str) -> list[Step]:
    """Steps to the models that the entities of a model identify."""
    model = registry.models[at]
    return [Step(e, column, name) for e, column in model.entities.items() if e != model.primary for name, other in registry.models.items() if name != at and other.primary == e]


def _connected(registry: Registry, start: str, owners: set[str]) -> bool:
    """Whether entities in common, in either direction, lead from ``start`` to one of ``owners``."""
    reached, models = {start}, registry.models
    while True:
        more = {n for n, m in models.items() if any(set(m.entities) & set(models[r].entities) for r in reached)} | reached
        if more == reached:
            return bool(reached & owners)
        reached = more


def _rows(tables: Mapping[str, DataFrame], model: SemanticModel) -> DataFrame:
    df = tables[model.table]
    return df.filter(model.condition) if model.condition else df


def with_dimensions(tables: Mapping[str, DataFrame], start: str, by: Sequence[str], registry: Registry) -> tuple[DataFrame, dict[str, str]]:
    """The rows of a model with the dimensions of others joined to them, and the column of each dimension.

    Each way is joined once, however many dimensions it leads to, and only their columns are taken along. Rows without a partner
    keep NULL dimensions.
    """
    df, columns, joined = _rows(tables, registry.models[start]), {}, {}
    paths = {d: join_path(registry, start, d) for d in by}
    for dimension, path in paths.items():
        name = dimension.rpartition("__")[2]
        if not path:
            columns[dimension] = registry.models[start].dimensions[name]
            continue
        for length, step in enumerate(path, 1):
            key = path[:length]
            if key in joined:
                continue
            model, prefix = registry.models[step.model], f"{'__'.join(s.entity for s in key)}__"
            needed = {registry.models[step.model].dimensions[d.rpartition("__")[2]] for d, p in paths.items() if p == key}
            needed |= {p[length].column for p in paths.values() if p[:length] == key and len(p) > length}
            identity = model.entities[step.entity]
            side = _rows(tables, model).select(F.col(identity).alias(f"{prefix}key"), *[F.col(c).alias(f"{prefix}{c}") for c in sorted(needed)])
            left = step.column if length == 1 else f"{joined[path[: length - 1]]}{step.column}"
            df = df.join(side, df[left] == side[f"{prefix}key"], "left").drop(f"{prefix}key")
            joined[key] = prefix
        columns[dimension] = f"{joined[path]}{registry.models[path[-1].model].dimensions[name]}"
    return df, columns


def query_metric(
    tables: Mapping[str, DataFrame],
    name: str,
    by: Sequence[str] = (),
    grain: str | None = None,
    registry: Registry = REGISTRY,
) -> DataFrame:
    """One metric grouped by dimensions and, when a grain is given, by ``period``.

    Dimensions may be those of another model that the metric's model leads to (``join_path``).
    """
    metric = registry.metric(name)
    if metric.ratio:
        return query_ratio(tables, name, by, grain, registry)
    model = registry.models[metric.model]
    df, columns = with_dimensions(tables, metric.model, by, registry)
    keys = [F.col(columns[d]).alias(d) for d in by]
    if grain:
        keys.append(_grain(model.time, grain).alias("period"))
    return df.groupBy(*keys).agg(model.measures[metric.measure].column().alias(name))


def query_ratio(
    tables: Mapping[str, DataFrame],
    name: str,
    by: Sequence[str] = (),
    grain: str | None = None,
    registry: Registry = REGISTRY,
) -> DataFrame:
    """Quotient of two metrics; each is aggregated first, then the small results are joined."""
    top, bottom = registry.metric(name).ratio
    upper = query_metric(tables, top, by, grain, registry)
    lower = query_metric(tables, bottom, by, grain, registry)
    keys = [*by, *(["period"] if grain else [])]
    if keys:
        both = upper.join(lower, keys, "left")
    else:
        both = upper.withColumn(bottom, lower.scalar())
    quotient = F.try_divide(F.col(top).cast("double"), F.col(bottom).cast("double"))
    return both.select(*keys, top, bottom, quotient.alias(name))


def all_metrics(tables: Mapping[str, DataFrame], registry: Registry = REGISTRY) -> DataFrame:
    """(metric, value) of every metric without grouping: one aggregation per model, ratios from the one row of all of them."""
    plain = {name: m for name, m in registry.metrics.items() if not m.ratio}
    parts = []
    for key, model in registry.models.items():
        own = {name: m for name, m in plain.items() if m.model == key}
        if not own:
            continue
        row = _rows(tables, model).agg(*[model.measures[m.measure].column().cast("double").alias(n) for n, m in own.items()])
        parts.append(unpivot_rows(row, [{"metric": F.lit(n), "value": F.col(n)} for n in own]))
    stacked = union_all(parts)
    row = stacked.agg(*[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in plain])
    entries = [{"metric": F.lit(n), "value": F.col(n)} for n in plain]
    entries += [{"metric": F.lit(n), "value": F.try_divide(*[F.col(x) for x in m.ratio])} for n, m in registry.metrics.items() if m.ratio]
    return unpivot_rows(row, entries)


def time_spine(like: DataFrame, start, end) -> DataFrame:
    """One row per day from start to end, both included (dates or date columns of one row)."""
    days = F.sequence(as_date(start), as_date(end))
    return like.sparkSession.range(1).select(F.explode(days).alias("date_day"))


def spine_of(df: DataFrame, ts: str) -> DataFrame:
    """One row per day between the first and the last day of a table."""
    ends = df.agg(F.to_date(F.min(ts)).alias("first"), F.to_date(F.max(ts)).alias("last"))
    return ends.select(F.explode(F.sequence("first", "last")).alias("date_day"))


def densify(series: DataFrame, spine: DataFrame, day: str, zero: Sequence[str] = ()) -> DataFrame:
    """A row for every day of the spine; the named measures are 0 on empty days, the others NULL."""
    full = spine.join(series, spine["date_day"] == series[day], "left").drop(day)
    return full.fillna(0, subset=list(zero)) if zero else full
