"""Analytical queries over the detail tables and marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odsflow.functions.measures import count_where, mean, percent, ratio
from odsflow.functions.times import Moment, as_moment, recent
from odsflow.operators.joins import fits_broadcast, lookup_join
from odsflow.plans.clickstream import events_of_sessions_since, session_base, sessions, window_number, window_summary
from odsflow.plans.sales import sales_summary, since_newest_hours

# -- recent activity ---------------------------------------------------------


def funnel(sessions: DataFrame, as_of: Moment, interval: str = "1 HOUR") -> DataFrame:
    """Sessions that started in the last hour, and how many reached each step."""
    total = F.countDistinct("session_id")
    viewed, carted, bought = (count_where(F.col(c)) for c in ("saw_product", "added_to_cart", "purchased"))
    return recent(sessions, "session_start", interval, as_of).agg(
        total.alias("total_sessions"),
        viewed.alias("viewed_product_sessions"),
        carted.alias("add_to_cart_sessions"),
        bought.alias("purchase_sessions"),
        percent(viewed, total).alias("view_rate_pct"),
        percent(carted, viewed).alias("cart_add_rate_pct"),
        percent(bought, carted).alias("purchase_rate_pct"),
    )


def recent_funnel(events: DataFrame, as_of: Moment, interval: str = "1 HOUR") -> DataFrame:
    """The funnel straight from events, of which only those of the sessions in question are summed up."""
    start = as_moment(as_of) - F.expr(f"INTERVAL {interval}")
    return funnel(session_base(events_of_sessions_since(events, start)), as_of, interval)


def freshness(events: DataFrame, as_of: Moment | None = None, seconds: int = 300) -> DataFrame:
    """Arrivals, rate and lag of the last five minutes."""
    lag = "event_lag_seconds"
    return recent(events, "ingested_at", f"{seconds} SECONDS", as_of).agg(
        F.count("event_id").alias("events_ingested"),
        (F.count("event_id").cast("double") / F.lit(float(seconds))).alias("avg_throughput_eps"),
        mean(lag).alias("avg_latency_seconds"),
        F.min(lag).alias("min_latency_seconds"),
        F.max(lag).alias("max_latency_seconds"),
    )


def trending(
    events: DataFrame, products: DataFrame, as_of: Moment | None = None, interval: str = "15 MINUTES", top: int = 10
) -> DataFrame:
    """Most viewed products of the last 15 minutes."""
    names = products.select(
        "product_id",
        F.col("category").alias("product_category"),
        F.col("brand").alias("product_brand"),
        F.col("name").alias("product_name"),
    )
    keys = ["product_category", "product_brand", "product_name"]
    # The moment is taken from all events, so the filter comes before the event type.
    shown = recent(events, "event_timestamp", interval, as_of, "event_date").where(F.col("event_type") == "product")
    # One row per product and session meets the catalogue, however often a product was shown.
    seen = shown.groupBy("product_id", "session_id").agg(F.count("event_id").alias("views"))
    named = lookup_join(seen, names, "product_id", "inner").groupBy(*keys)
    counted = named.agg(F.sum("views").alias("total_views"), F.countDistinct("session_id").alias("unique_view_sessions"))
    return counted.orderBy(F.desc("total_views"), *keys).limit(top)


def latest_hourly_rows(hourly: DataFrame, top: int = 24) -> DataFrame:
    """Newest rows of the hourly summary: one row per hour *and* group."""
    keys = ["product_category", "product_department", "user_country", "user_gender"]
    return (
        hourly.orderBy(F.desc("order_hour"), *[F.col(k).asc_nulls_last() for k in keys])
        .limit(top)
        .select(
            "order_hour",
            "total_orders",
            "total_revenue",
            "total_profit",
            "returned_items",
            percent(F.col("total_profit"), F.col("total_revenue")).alias("profit_margin_percent"),
        )
    )


def latest_hours(items: DataFrame, products: DataFrame, users: DataFrame, top: int = 24) -> DataFrame:
    """Newest hours, one row each. Orders are counted from the items, not added up."""
    measures = ("total_orders", "total_revenue", "total_profit", "returned_items")
    return (
        sales_summary(since_newest_hours(items, top), products, users, ("order_hour",), measures)
        .orderBy(F.desc("order_hour"))
        .limit(top)
        .withColumn("profit_margin_percent", percent(F.col("total_profit"), F.col("total_revenue")))
    )


# -- click reports -----------------------------------------------------------


def click_totals(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count(F.lit(1)).alias("total_events"), F.countDistinct("session_id").alias("unique_sessions")
    )


def clicks_by_type(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("event_type")
        .agg(
            F.count("event_id").alias("event_count"),
            F.countDistinct("session_id").alias("unique_sessions"),
        )
        .orderBy(F.desc("event_count"), "event_type")
    )


def top_sources(events: DataFrame, top: int = 10) -> DataFrame:
    return (
        events.groupBy("traffic_source")
        .agg(
            F.countDistinct("session_id").alias("sessions"),
            count_where(F.col("event_type") == "purchase").alias("purchases"),
        )
        .orderBy(F.desc("purchases"), F.col("traffic_source").asc_nulls_last())
        .limit(top)
    )


def read_windows(windows: DataFrame, top: int = 50) -> DataFrame:
    keys = ("window_start", "traffic_source", "browser", "event_type", "page_type")
    return (
        windows.orderBy(*keys)
        .limit(top)
        .select("window_start", "window_end", "traffic_source", "total_events", "unique_sessions")
    )


def read_sessions(sessions: DataFrame, top: int = 50) -> DataFrame:
    return (
        sessions.orderBy("session_id")
        .limit(top)
        .select("session_id", "session_duration_seconds", "event_count", "purchased", "top_category")
    )


def of_first_keys(events: DataFrame, keys: dict[str, Column], top: int = 50) -> DataFrame:
    """Events of the first ``top`` combinations of ``keys``, which a summary by these keys would show first.

    The combinations are found from the key columns alone; the events of others are filtered out
    before anything is summed up. The first key also bounds the scan.
    """
    named = [column.alias(f"first_{name}") for name, column in keys.items()]
    first = events.select(*named).distinct().orderBy(*[f"first_{name}" for name in keys]).limit(top)
    name, leading = next(iter(keys.items()))
    last = first.agg(F.max(f"first_{name}")).scalar()
    bounded = events.where(leading.isNull() | (leading <= last))
    same = [column.eqNullSafe(F.col(f"first_{name}")) for name, column in keys.items()]
    condition = same[0]
    for other in same[1:]:
        condition = condition & other
    return bounded.join(F.broadcast(first), condition, "left_semi")  # ``top`` rows


def first_windows(events: DataFrame, top: int = 50) -> DataFrame:
    """The first rows of the window summary, of which only those are computed."""
    labels = ("traffic_source", "browser", "event_type", "page_type")
    start = window_number(F.col("event_timestamp"))
    # An event without a time is in no window.
    events = events.where(F.col("event_timestamp").isNotNull())
    return read_windows(window_summary(of_first_keys(events, {"start": start, **{n: F.col(n) for n in labels}}, top)), top)


def first_sessions(events: DataFrame, products: DataFrame, top: int = 50) -> DataFrame:
    """The first rows of the session summary, of which only those are computed."""
    return read_sessions(sessions(of_first_keys(events, {"session_id": F.col("session_id")}, top), products), top)


# -- order reports -----------------------------------------------------------


def orders_by_status(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy("status")
        .agg(F.count(F.lit(1)).alias("order_count"))
        .orderBy(F.desc("order_count"), "status")
    )


def revenue_by_category(items: DataFrame, products: DataFrame, top: int = 10) -> DataFrame:
    """Items and revenue per product category, for items whose product is known."""
    partial = {"items_sold": F.count("id"), "total_revenue": F.sum("sale_price")}
    return (
        _grouped_lookup(items, products.select("product_id", "category"), "product_id", ("category",), partial)
        .orderBy(F.desc("total_revenue"), "category")
        .limit(top)
    )


def demographics(users: DataFrame, top: int = 20) -> DataFrame:
    return (
        users.groupBy("country", "gender")
        .agg(F.count(F.lit(1)).alias("user_count"))
        .orderBy(F.desc("user_count"), "country", "gender")
        .limit(top)
    )


def orders_by_demographic(orders: DataFrame, users: DataFrame, top: int = 15) -> DataFrame:
    """Orders and items per order, by country and gender of the user."""
    keys = ("country", "gender")
    partial = {
        "total_orders": F.count("order_id"),
        "items": F.sum("num_of_item"),
        "counted": F.count("num_of_item"),
    }
    return (
        _grouped_lookup(orders.drop("gender"), users.select("user_id", *keys), "user_id", keys, partial)
        .select(*keys, "total_orders", ratio(F.col("items"), F.col("counted")).alias("avg_items_per_order"))
        .orderBy(F.desc("total_orders"), *keys)
        .limit(top)
    )


def stock_by_centre(inventory: DataFrame, products: DataFrame, centres: DataFrame) -> DataFrame:
    """Unsold items per distribution centre."""
    names = centres.select(
        F.col("id").alias("distribution_center_id"), F.col("name").alias("distribution_center")
    )
    placed = lookup_join(
        products.select("product_id", "distribution_center_id"), names, "distribution_center_id", "inner"
    ).select("product_id", "distribution_center")
    unsold = inventory.where(F.col("sold_at").isNull())
    return _grouped_lookup(
        unsold, placed, "product_id", ("distribution_center",), {"stock_items": F.count("id")}
    )


def _grouped_lookup(
    fact: DataFrame, dim: DataFrame, key: str, keys: tuple[str, ...], partial: dict[str, Column]
) -> DataFrame:
    """Inner join to ``dim``, then sums and counts by columns of ``dim``.

    When ``dim`` is too large to broadcast, the fact is grouped by the join key first: the
    shuffle then carries one row per key and task, and no key is heavier than another.
    """
    aggregates = [value.alias(name) for name, value in partial.items()]
    if not fits_broadcast(dim):
        fact = fact.groupBy(key).agg(*aggregates)
        aggregates = [F.sum(name).alias(name) for name in partial]
    return lookup_join(fact, dim, key, "inner").groupBy(*keys).agg(*aggregates)


# -- ingest health -----------------------------------------------------------


def _plausible(events: DataFrame) -> DataFrame:
    lag = F.col("event_lag_seconds")
    return events.where(lag.isNotNull() & (lag >= 0) & (lag < 3600))


def _newest_hours(hours: DataFrame, newest: int) -> Column:
    """Start of the last hour that is needed for ``newest`` events, from rows (hour, n)."""
    after = Window.orderBy(F.desc("hour")).rowsBetween(Window.unboundedPreceding, -1)  # a row per hour
    needed = hours.withColumn("newer", F.coalesce(F.sum("n").over(after), F.lit(0))).where(F.col("newer") < newest)
    return needed.agg(F.min("hour")).scalar()


def recent_lag(events: DataFrame, newest: int = 5000) -> DataFrame:
    """Lag of the newest events with a plausible lag.

    How many hours hold them is found from two columns; only the events of these hours are sorted.
    """
    valid = _plausible(events)
    hour = F.date_trunc("hour", F.col("event_timestamp").cast("timestamp")).cast("timestamp_ntz").alias("hour")
    hours = valid.where(F.col("event_timestamp").isNotNull()).groupBy(hour).agg(F.count(F.lit(1)).alias("n"))
    start = F.coalesce(_newest_hours(hours, newest), F.lit("0001-01-01").cast("timestamp_ntz"))
    # Events without a time count as the oldest, where there are too few others.
    untimed = F.col("event_timestamp").isNull() & (F.coalesce(hours.agg(F.sum("n")).scalar(), F.lit(0)) < newest)
    sample = (
        valid.where((F.col("event_timestamp") >= start) | untimed)
        .orderBy(F.desc("event_timestamp"), F.desc("event_id"))
        .limit(newest)
        .select("event_lag_seconds")
    )
    return sample.agg(
        F.count(F.lit(1)).alias("sample_size"),
        mean("event_lag_seconds").alias("avg_lag"),
        *[F.percentile("event_lag_seconds", p / 100).alias(f"p{p}_lag") for p in (50, 95, 99)],
        F.max("event_lag_seconds").alias("max_lag"),
    )


#: Size of a stored sketch of lags. Ranks of its quantiles are off by less than ``RANK_ERROR`` of all values
#: (three times the published 99 % bound for this size), however many sketches are merged.
SKETCH_SIZE = 1024
RANK_ERROR = 0.01
LAG_QUANTILES = (50, 95, 99)


def lag_hours(events: DataFrame) -> DataFrame:
    """Lag of every hour, to be stored: counts, sums, and a mergeable sketch of its quantiles."""
    lag = F.col("event_lag_seconds")
    hour = F.date_trunc("hour", F.col("event_timestamp").cast("timestamp")).alias("hour")
    return _plausible(events).groupBy(hour).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(lag).alias("total"),
        F.max(lag).alias("max_lag"),
        F.kll_sketch_agg_double(lag.cast("double"), SKETCH_SIZE).alias("sketch"),
    )


def lag_summary(hours: DataFrame, period: str | None = "day") -> DataFrame:
    """Lag by ``day`` or another unit (in total without one), from the stored hours alone."""
    start = F.lit(None).cast("timestamp") if period is None else F.date_trunc(period, "hour")
    merged = hours.groupBy(start.alias("period")).agg(
        F.sum("n").alias("sample_size"),
        ratio(F.sum("total"), F.sum("n")).alias("avg_lag"),
        F.max("max_lag").alias("max_lag"),
        F.kll_merge_agg_double("sketch", SKETCH_SIZE).alias("sketch"),
    )
    quantiles = [F.kll_sketch_get_quantile_double("sketch", F.lit(p / 100)).alias(f"p{p}_lag") for p in LAG_QUANTILES]
    return merged.select("period", "sample_size", "avg_lag", *quantiles, "max_lag")


def newest_lag(hours: DataFrame, newest: int = 5000) -> DataFrame:
    """Lag of the newest whole hours that hold ``newest`` events, from the stored hours alone."""
    plain = hours.withColumn("hour", F.col("hour").cast("timestamp_ntz"))
    return lag_summary(plain.where(F.col("hour") >= _newest_hours(plain.select("hour", "n"), newest)), None).drop("period")


def rank_errors(summary: DataFrame, events: DataFrame, period: str = "day") -> DataFrame:
    """How far the ranks of estimated quantiles are from the wanted ones, as shares of the period's events.

    A quantile is as good as the nearest rank it may stand for: equal lags share theirs.
    """
    start = F.date_trunc(period, F.col("event_timestamp").cast("timestamp")).alias("period")
    lags = _plausible(events).select(start, F.col("event_lag_seconds").cast("double").alias("lag"))
    known = summary.select(F.col("period").alias("of"), *[f"p{p}_lag" for p in LAG_QUANTILES])
    joined = lags.join(known, F.col("period").eqNullSafe(F.col("of")))
    share = lambda kept: F.count_if(kept) / F.count(F.lit(1))
    off = []
    for p in LAG_QUANTILES:
        under, upto = share(F.col("lag") < F.col(f"p{p}_lag")), share(F.col("lag") <= F.col(f"p{p}_lag"))
        off.append(F.greatest(F.lit(0.0), under - p / 100, F.lit(p / 100) - upto).alias(f"p{p}_off"))
    return joined.groupBy("period").agg(*off)


def throughput(events: DataFrame, interval: str = "1 hour") -> DataFrame:
    """Mean and spread of the event rate over intervals that have events; steady below 20 %."""
    seconds = F.unix_timestamp(F.col("w.end").cast("timestamp")) - F.unix_timestamp(F.col("w.start").cast("timestamp"))
    rates = (
        events.groupBy(F.window("event_timestamp", interval).alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select((F.col("n").cast("double") / seconds.cast("double")).alias("rate"))
    )
    return rates.agg(
        F.count(F.lit(1)).alias("samples"),
        F.avg("rate").alias("mean_rate"),
        F.coalesce(F.stddev_samp("rate"), F.lit(0.0)).alias("stdev_rate"),
    ).withColumn(
        "is_stable",
        (F.col("mean_rate") == 0) | (ratio(F.col("stdev_rate"), F.col("mean_rate")) < 0.2),
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
