"""Data-quality rules on events and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import Catalogue, table
from oreflow.operators.quality import Expectation, apply_expectations, assertions, pass_rates, rule_catalog
from oreflow.session import work_dir
from oreflow.sinks.publish import ExpectationFailed, publish, published_version, read_published, rule_history
from oreflow.streaming import await_all, read_rule_counts, start_checked

CATALOGUE = Catalogue()
register = CATALOGUE.register

EVENT_RULES = [
    Expectation("has_event_id", "event_id IS NOT NULL", "drop"),
    Expectation("known_type", "event_type IS NOT NULL AND event_type RLIKE '^(view|click|purchase|signup)$'", "drop"),
    Expectation("value_in_range", "value BETWEEN 1 AND 100", "drop"),
    Expectation("has_props", "props != ''"),
    Expectation("large_k", "try_cast(get_json_object(props, '$.k') AS INT) > 9"),
    Expectation("has_row", "true"),
]
# the same predicates in the oracle's dialect
EVENT_SQL = {
    "has_event_id": ("drop", "event_id IS NOT NULL"),
    "known_type": ("drop", "event_type IS NOT NULL AND regexp_matches(event_type, '^(view|click|purchase|signup)$')"),
    "value_in_range": ("drop", "value BETWEEN 1 AND 100"),
    "has_props": ("warn", "props != ''"),
    "large_k": ("warn", "TRY_CAST(regexp_extract(props, '\"k\": (-?[0-9]+)', 1) AS INTEGER) > 9"),
    "has_row": ("warn", "true"),
}
ORDER_RULES = [
    Expectation("has_key", "o_orderkey IS NOT NULL", "fail"),
    Expectation("positive_price", "o_totalprice > 0", "fail"),
    Expectation("valid_year", "year(o_orderdate) BETWEEN 1900 AND 2100", "fail"),
    Expectation("finished", "o_orderstatus = 'F'"),
]
ORDER_SQL = {
    "has_key": ("fail", "o_orderkey IS NOT NULL"),
    "positive_price": ("fail", "o_totalprice > 0"),
    "valid_year": ("fail", "year(o_orderdate) BETWEEN 1900 AND 2100"),
    "finished": ("warn", "o_orderstatus = 'F'"),
}
KEPT = " AND ".join(f"coalesce({p}, false)" for action, p in EVENT_SQL.values() if action == "drop")


def metrics_sql(rules: dict, source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS rule, '{action}' AS action, count(*) AS rows,
            CAST(sum(CASE WHEN coalesce({predicate}, false) THEN 0 ELSE 1 END) AS BIGINT) AS violations FROM {source}"""
        for name, (action, predicate) in rules.items()
    )


def checked_events(spark, sf_dir):
    return apply_expectations(table(spark, sf_dir, "events"), EVENT_RULES)


@register("dq_warn", metrics_sql(EVENT_SQL, "events"))
def dq_warn(spark, sf_dir):
    return checked_events(spark, sf_dir).metrics


@register("dq_drop", f"SELECT event_id, user_id, event_type, value FROM events WHERE {KEPT}")
def dq_drop(spark, sf_dir):
    return checked_events(spark, sf_dir).valid.select("event_id", "user_id", "event_type", "value")


FAILED = ", ".join(
    f"CASE WHEN NOT coalesce({p}, false) THEN '{name}' END" for name, (action, p) in EVENT_SQL.items() if action == "drop"
)


@register(
    "dq_quarantine",
    f"SELECT event_id, event_type, value, concat_ws(',', {FAILED}) AS failed_rules FROM events WHERE NOT ({KEPT})",
)
def dq_quarantine(spark, sf_dir):
    bad = checked_events(spark, sf_dir).quarantine
    return bad.select("event_id", "event_type", "value", F.concat_ws(",", "failed_rules").alias("failed_rules"))


@register("dq_fail", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def dq_fail(spark, sf_dir):
    """Staged, checked against the fail rules, published, read back."""
    root = work_dir(spark, "dq-fail")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    publish(apply_expectations(orders, [rule for rule in ORDER_RULES if rule.action == "fail"]), root)
    return read_published(spark, root)


# --- counts that are taken while rows are written ---
def counted_sql(rules: dict, source: str) -> str:
    """Drop rules over all rows, the others over the rows that are kept."""
    kept = " AND ".join(f"coalesce({p}, false)" for action, p in rules.values() if action == "drop")
    parts = [
        metrics_sql({name: (action, p)}, source if action == "drop" else f"(SELECT * FROM {source} WHERE {kept})")
        for name, (action, p) in rules.items()
    ]
    return " UNION ALL ".join(parts)


@register("dq_stream_counts", counted_sql(EVENT_SQL, "events"))
def dq_stream_counts(spark, sf_dir):
    """Events arrive in two lots and are appended by three runs, the last of which finds nothing new."""
    root = work_dir(spark, "dq-stream")
    events = table(spark, sf_dir, "events")
    stream = None
    for lot in ("ts < '2024-01-11'", "ts >= '2024-01-11'", None):
        if lot:
            events.filter(lot).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 4).parquet(f"{root}/in")
        await_all([start_checked(apply_expectations(stream, EVENT_RULES), f"{root}/out", f"{root}/metrics", f"{root}/checkpoint")])
    return read_rule_counts(spark, f"{root}/metrics")


@register(
    "dq_stream_kept",
    f"SELECT event_id, event_type, value FROM events WHERE {KEPT}",
)
def dq_stream_kept(spark, sf_dir):
    """The rows that such a stream leaves, a day's events as a partition."""
    root = work_dir(spark, "dq-stream-rows")
    events = table(spark, sf_dir, "events")
    events.write.parquet(f"{root}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{root}/in").withColumn("day", F.to_date("ts"))
    await_all([start_checked(apply_expectations(stream, EVENT_RULES), f"{root}/out", f"{root}/metrics", f"{root}/checkpoint", ("day",))])
    return spark.read.parquet(f"{root}/out").select("event_id", "event_type", "value")


@register(
    "dq_publish_counts",
    f"SELECT CAST(version AS INTEGER) AS version, c.* FROM ({counted_sql(EVENT_SQL, 'events')}) c, (VALUES (1), (2)) v(version)",
)
def dq_publish_counts(spark, sf_dir):
    """A clustered table, published twice: what each rule found in each version, dropped rows included."""
    root = work_dir(spark, "dq-publish")
    for _ in range(2):
        publish(checked_events(spark, sf_dir), root, cluster_by=("event_id",))
    return rule_history(spark, root).select("version", "rule", "action", "rows", "violations")


@register("dq_table_gate", "SELECT o_orderkey, o_totalprice FROM orders")
def dq_table_gate(spark, sf_dir):
    """A version that repeats keys is refused as a whole; readers keep the one before."""
    root = work_dir(spark, "dq-gate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    once = {"one_row_per_order": "count(*) = count(DISTINCT o_orderkey)", "has_rows": "count(*) > 0"}
    publish(apply_expectations(orders, []), root, table_rules=once)
    try:
        publish(apply_expectations(orders.unionByName(orders.filter("o_orderkey % 100 = 0")), []), root, table_rules=once)
    except ExpectationFailed:
        return read_published(spark, root)
    raise AssertionError("a version that repeats keys was published")


HISTORY_SQL = {
    "not_pending": ("drop", "o_orderstatus <> 'P'"),
    "before_2000": ("fail", "o_orderdate < '2000-01-01'"),
    "large": ("warn", "o_totalprice > 100000"),
}
ORDERS_BEFORE = "(SELECT * FROM orders WHERE o_orderdate < '{}')"


@register(
    "dq_rule_history",
    " UNION ALL ".join(
        f"""SELECT CAST({version} AS INTEGER) AS version, {version} = 1 AS published, rule, action, rows, violations,
            CASE WHEN rows > 0 THEN 1 - CAST(violations AS DOUBLE) / rows END AS pass_rate
            FROM ({counted_sql(HISTORY_SQL, ORDERS_BEFORE.format(day))})"""
        for version, day in ((1, "2000-01-01"), (2, "2001-01-01"))
    ),
)
def dq_rule_history(spark, sf_dir):
    """Two versions of one table: the second breaks a fail rule, and its counts are kept as well."""
    root = work_dir(spark, "dq-history")
    rules = [Expectation(name, predicate, action) for name, (action, predicate) in HISTORY_SQL.items()]
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    for day in ("2000-01-01", "2001-01-01"):
        try:
            publish(apply_expectations(orders.filter(F.col("o_orderdate") < day), rules), root)
        except ExpectationFailed:
            pass  # seen below by its missing marker
    published = F.col("version") <= F.lit(published_version(spark, root))
    return rule_history(spark, root).select("version", published.alias("published"), "rule", "action", "rows", "violations", "pass_rate")


@register(
    "dq_assertions",
    """SELECT 'has_rows' AS check_name, count(*) > 0 AS passed FROM orders
       UNION ALL SELECT 'no_null_keys', count(*) FILTER (o_orderkey IS NULL OR o_custkey IS NULL) = 0 FROM orders
       UNION ALL SELECT 'seven_years', count(DISTINCT year(o_orderdate)) = 7 FROM orders
       UNION ALL SELECT 'nothing_pending', count(*) FILTER (o_orderstatus = 'P') = 0 FROM orders""",
)
def dq_assertions(spark, sf_dir):
    return assertions(
        table(spark, sf_dir, "orders"),
        {
            "has_rows": "count(*) > 0",
            "no_null_keys": "count_if(o_orderkey IS NULL OR o_custkey IS NULL) = 0",
            "seven_years": "count(DISTINCT year(o_orderdate)) = 7",
            "nothing_pending": "count_if(o_orderstatus = 'P') = 0",
        },
    ).select("check_name", "passed")


@register(
    "dq_rule_catalog",
    f"""SELECT 'events' AS dataset, * FROM ({metrics_sql(EVENT_SQL, 'events')})
        UNION ALL SELECT 'orders', * FROM ({metrics_sql(ORDER_SQL, 'orders')})""",
)
def dq_rule_catalog(spark, sf_dir):
    """Every rule in use with what it finds."""
    datasets = {"events": EVENT_RULES, "orders": ORDER_RULES}
    found = [
        apply_expectations(table(spark, sf_dir, name), rules).metrics.withColumn("dataset", F.lit(name)).drop("action")
        for name, rules in datasets.items()
    ]
    rules = rule_catalog(spark, datasets).drop("predicate")
    return rules.join(found[0].unionByName(found[1]), ["dataset", "rule"], "left")


PER_DAY = " UNION ALL ".join(
    f"""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, '{name}' AS rule, '{action}' AS action, count(*) AS rows,
        CAST(sum(CASE WHEN coalesce({p}, false) THEN 1 ELSE 0 END) AS BIGINT) AS passed FROM events GROUP BY 1"""
    for name, (action, p) in EVENT_SQL.items()
)


@register(
    "dq_pass_rate",
    f"SELECT *, CAST(passed AS DOUBLE) / rows AS pass_rate FROM ({PER_DAY})",
)
def dq_pass_rate(spark, sf_dir):
    return pass_rates(table(spark, sf_dir, "events"), EVENT_RULES, {"day": F.to_date("ts").cast("string")})
