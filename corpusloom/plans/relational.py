"""Relational queries over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import aggregates, counts, integrity, loading
from corpusloom.session import table


def authority_counts(spark: SparkSession, d: str) -> DataFrame:
    customers = table(spark, d, "customer").select("c_custkey", "c_name")
    return counts.child_counts(customers, table(spark, d, "orders").select("o_custkey"), "c_custkey", "o_custkey", "n_orders")


def orphans(spark: SparkSession, d: str) -> DataFrame:
    return integrity.orphans(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), table(spark, d, "orders").filter("o_orderstatus <> 'P'"), "l_orderkey", "o_orderkey")


def fk_check(spark: SparkSession, d: str) -> DataFrame:
    t = {n: table(spark, d, n) for n in ("lineitem", "orders", "part", "supplier", "customer", "nation")}
    return integrity.foreign_key_violations([
        ("lineitem_order", t["lineitem"], "l_orderkey", t["orders"].filter("o_orderstatus <> 'P'"), "o_orderkey"),
        ("lineitem_part", t["lineitem"], "l_partkey", t["part"], "p_partkey"),
        ("lineitem_supplier", t["lineitem"], "l_suppkey", t["supplier"].filter("s_acctbal >= 0"), "s_suppkey"),
        ("order_customer", t["orders"], "o_custkey", t["customer"], "c_custkey"),
        ("customer_nation", t["customer"], "c_nationkey", t["nation"], "n_nationkey"),
    ])


def unexpected_authority(spark: SparkSession, d: str) -> DataFrame:
    return integrity.not_listed(table(spark, d, "customer").select("c_custkey", "c_nationkey"), "c_nationkey", table(spark, d, "nation").filter("n_regionkey < 4"), "n_nationkey")


def dependents_count(spark: SparkSession, d: str) -> DataFrame:
    return integrity.dependants(table(spark, d, "orders"), ["o_custkey"], table(spark, d, "customer").filter("c_mktsegment = 'MACHINERY'"), ["c_custkey"])


def dependents_composite(spark: SparkSession, d: str) -> DataFrame:
    cheap = table(spark, d, "lineitem").filter("l_quantity < 5").select("l_orderkey", "l_returnflag")
    return integrity.dependants(table(spark, d, "lineitem"), ["l_orderkey", "l_returnflag"], cheap, ["l_orderkey", "l_returnflag"])


def census(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select(F.when(F.col("o_orderkey") % 7 == 0, None).otherwise(F.col("o_orderkey") - 50).alias("ident"), "o_custkey")
    return aggregates.census(rows, "ident", "o_custkey")


def measures(spark: SparkSession, d: str) -> DataFrame:
    line = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("k"), "l_returnflag")
    events = table(spark, d, "events").select(F.col("user_id").alias("k"), "event_type")
    return aggregates.measures({"lines": (line, F.col("l_returnflag") == "R"), "events": (events, F.col("event_type") == "error")}, "k")


def summary_pivot(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.summary_by_kind(table(spark, d, "events"), "user_id", "event_type", ["signup", "click", "view", "purchase", "error"])


def accounting_gaps(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.accounting(summary_pivot(spark, d), "total", ["signup", "click", "view", "purchase"]).select("user_id", "total")


def totals_rollup(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.totals(table(spark, d, "lineitem"), "l_returnflag", {"quantity": F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double"), "n_orders": F.count_distinct("l_orderkey")})


def warnings_minus_approved(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_type")
    capped = table(spark, d, "events").filter("event_id % 3 = 0").select("user_id", "event_type")
    return integrity.multiset_minus(e, capped)


def positional_diff(spark: SparkSession, d: str) -> DataFrame:
    left = table(spark, d, "conversations").select("conv_id", "turn", "role")
    right = left.filter("turn <> 1 or conv_id % 5 <> 0")
    return integrity.positional_differences(left, right, ["conv_id"], ["turn"], ["role"])


def keyed_comparison(spark: SparkSession, d: str) -> DataFrame:
    base = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    actual = base.filter("c_custkey % 11 <> 0").withColumn("c_nationkey", F.when(F.col("c_custkey") % 13 == 0, F.lit(None)).otherwise(F.col("c_nationkey")))
    return integrity.compare_keyed(base.filter("c_custkey % 17 <> 0"), actual, "c_custkey", ["c_mktsegment", "c_nationkey"])


def id_namespace(spark: SparkSession, d: str) -> DataFrame:
    part = lambda name, key, nation: (table(spark, d, name), F.col(nation) if nation else F.lit(0), F.col(key))
    return integrity.shared_namespace([part("customer", "c_custkey", "c_nationkey"), part("supplier", "s_suppkey", "s_nationkey")])


def repeated_keys(spark: SparkSession, d: str) -> DataFrame:
    return integrity.repeated_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_partkey"])


def monotonic_check(spark: SparkSession, d: str) -> DataFrame:
    return integrity.not_increasing(table(spark, d, "events").select("user_id", "event_id", "ts", "value"), ["user_id"], ["ts", "event_id"], "value").select("user_id", "event_id")


def contiguous_check(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").filter("conv_id % 4 <> 1 or turn <> 0").select("conv_id", "turn")
    return integrity.not_contiguous(rows, ["conv_id"], ["turn"], "turn")


def marker_bijection(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").filter("l_quantity > 30").select(F.col("l_orderkey").alias("unit"))
    events = table(spark, d, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("unit"))
    return integrity.marker_bijection(lines, events, "unit")


def first_wins(spark: SparkSession, d: str) -> DataFrame:
    return integrity.first_wins(table(spark, d, "events").select("user_id", "event_type", "ts", "event_id"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


def upsert_replace(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    new = orders.filter("o_custkey % 10 = 3 and o_orderkey % 2 = 0").withColumn("o_totalprice", F.lit(1.0))
    return loading.replace_by_key(orders, new, "o_custkey")


def cascade_delete(spark: SparkSession, d: str) -> DataFrame:
    gone = table(spark, d, "orders").filter("o_orderstatus = 'P'")
    return loading.cascade(gone, "o_orderkey", table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_orderkey")


def set_null(spark: SparkSession, d: str) -> DataFrame:
    return loading.set_null(table(spark, d, "nation").filter("n_regionkey = 1"), "n_nationkey", table(spark, d, "supplier").select("s_suppkey", "s_nationkey"), "s_nationkey")


def backfill_columns(spark: SparkSession, d: str) -> DataFrame:
    spec = [("n_nationkey", "int", None), ("n_name", "string", None), ("attaches_to", "string", ""), ("source_unit_id", "long", None), ("present", "int", 0)]
    return loading.backfill(table(spark, d, "nation"), spec)


def surrogate_ids(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return loading.surrogate_ids(rows.withColumn("rank", -F.col("c_nationkey")), "rank", "c_custkey", "c_nationkey").select("c_custkey", "id")


def sibling_positions(spark: SparkSession, d: str) -> DataFrame:
    return loading.positions(table(spark, d, "supplier").select("s_suppkey", "s_nationkey"), "s_nationkey", "s_suppkey", table(spark, d, "nation"), "n_nationkey", "n_regionkey", "n_name", "s_nationkey")


def ordinal_restamp(spark: SparkSession, d: str) -> DataFrame:
    return loading.restamp(table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey"), "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey").groupBy("l_suppkey").agg(F.max("ordinal").alias("last"), F.count(F.lit(1)).alias("n"))


def schema_diff(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import types as T

    expected = T.StructType([T.StructField("n_nationkey", T.LongType()), T.StructField("N_NAME", T.StringType()), T.StructField("n_regionkey", T.IntegerType()), T.StructField("n_comment", T.StringType())])
    return spark.createDataFrame(loading.schema_differences(table(spark, d, "nation"), expected, "nation"), "relation string, column string, problem string")


def override_counts(spark: SparkSession, d: str) -> DataFrame:
    seed = table(spark, d, "nation").select(F.col("n_name").alias("slug"), (F.col("n_nationkey") * 10).cast("long").alias("expected"))
    over = table(spark, d, "nation").filter("n_regionkey = 2").select(F.col("n_name").alias("_s"), (F.col("n_nationkey") * 10 + 1).cast("long").alias("_o"))
    joined = seed.join(over, F.col("slug") == F.col("_s"), "left")
    return aggregates.totals(joined.select("slug", F.coalesce("_o", "expected").alias("v"), "expected"), "slug", {"articles": F.sum("v"), "delta": F.sum(F.col("v") - F.col("expected"))})


QUERIES = {
    "authority_counts": (authority_counts, "SELECT c_custkey, c_name, CAST(count(o_orderkey) AS BIGINT) AS n_orders FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name"),
    "orphans": (orphans, "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')"),
    "fk_check": (
        fk_check,
        "SELECT 'lineitem_order' AS \"constraint\", count(*) AS n FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P') "
        "UNION ALL SELECT 'lineitem_part', count(*) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey) "
        "UNION ALL SELECT 'lineitem_supplier', count(*) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_acctbal >= 0) "
        "UNION ALL SELECT 'order_customer', count(*) FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey) "
        "UNION ALL SELECT 'customer_nation', count(*) FROM customer WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = c_nationkey)",
    ),
    "unexpected_authority": (unexpected_authority, "SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 4)"),
    "dependents_count": (dependents_count, "SELECT count(*) AS n_dependants FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')"),
    "dependents_composite": (dependents_composite, "SELECT count(*) AS n_dependants FROM lineitem a WHERE EXISTS (SELECT 1 FROM lineitem b WHERE b.l_quantity < 5 AND b.l_orderkey = a.l_orderkey AND b.l_returnflag = a.l_returnflag)"),
    "census": (
        census,
        "SELECT count(*) AS n_rows, CAST(coalesce(sum(CASE WHEN i IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_null, CAST(coalesce(sum(CASE WHEN i > 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_positive, "
        "count(DISTINCT CASE WHEN i > 0 THEN o_custkey END) AS n_owners FROM (SELECT CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey - 50 END AS i, o_custkey FROM orders) x",
    ),
    "measures": (
        measures,
        "SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, 0) AS n_lines, coalesce(a.s, 0) AS n_lines_set, coalesce(b.n, 0) AS n_events, coalesce(b.s, 0) AS n_events_set FROM "
        "(SELECT l_suppkey AS k, count(*) AS n, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS s FROM lineitem GROUP BY 1) a FULL JOIN "
        "(SELECT user_id AS k, count(*) AS n, count(CASE WHEN event_type = 'error' THEN 1 END) AS s FROM events GROUP BY 1) b ON a.k = b.k",
    ),
    "summary_pivot": (summary_pivot, "SELECT user_id, " + ", ".join(f"count(CASE WHEN event_type = '{k}' THEN 1 END) AS {k}" for k in ("signup", "click", "view", "purchase", "error")) + ", count(*) AS total FROM events GROUP BY user_id"),
    "accounting_gaps": (accounting_gaps, "SELECT user_id, count(*) AS total FROM events GROUP BY user_id HAVING count(CASE WHEN event_type IN ('signup', 'click', 'view', 'purchase') THEN 1 END) <> count(*)"),
    "totals_rollup": (totals_rollup, "SELECT l_returnflag, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity, count(DISTINCT l_orderkey) AS n_orders FROM lineitem GROUP BY ROLLUP (l_returnflag)"),
    "warnings_minus_approved": (warnings_minus_approved, "SELECT user_id, event_type FROM events EXCEPT ALL SELECT user_id, event_type FROM events WHERE event_id % 3 = 0"),
    "positional_diff": (
        positional_diff,
        "WITH a AS (SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS position, role FROM conversations), "
        "b AS (SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS position, role FROM conversations WHERE turn <> 1 OR conv_id % 5 <> 0) "
        "SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, coalesce(a.position, b.position) AS position, a.conv_id IS NOT NULL AS in_left, b.conv_id IS NOT NULL AS in_right "
        "FROM a FULL JOIN b ON a.conv_id = b.conv_id AND a.position = b.position WHERE a.role IS DISTINCT FROM b.role",
    ),
    "keyed_comparison": (
        keyed_comparison,
        "WITH e AS (SELECT c_custkey, c_mktsegment, c_nationkey FROM customer WHERE c_custkey % 17 <> 0), "
        "a AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey FROM customer WHERE c_custkey % 11 <> 0) "
        "SELECT coalesce(e.c_custkey, a.c_custkey) AS c_custkey, CASE WHEN a.c_custkey IS NULL THEN 'missing' WHEN e.c_custkey IS NULL THEN 'unexpected' ELSE 'c_nationkey' END AS problems "
        "FROM e FULL JOIN a ON e.c_custkey = a.c_custkey WHERE a.c_custkey IS NULL OR e.c_custkey IS NULL OR e.c_nationkey IS DISTINCT FROM a.c_nationkey",
    ),
    "id_namespace": (
        id_namespace,
        "SELECT owner, id, count(*) AS n FROM (SELECT c_nationkey AS owner, c_custkey AS id FROM customer UNION ALL SELECT s_nationkey, s_suppkey FROM supplier) x WHERE id IS NOT NULL GROUP BY owner, id HAVING count(*) > 1",
    ),
    "repeated_keys": (repeated_keys, "SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"),
    "monotonic_check": (
        monotonic_check,
        "SELECT user_id, event_id FROM (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events) x WHERE b IS NOT NULL AND value <= b",
    ),
    "contiguous_check": (
        contiguous_check,
        "SELECT conv_id, turn FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS p FROM conversations WHERE conv_id % 4 <> 1 OR turn <> 0) x WHERE p <> turn",
    ),
    "marker_bijection": (
        marker_bijection,
        "WITH l AS (SELECT l_orderkey AS unit, count(*) AS n FROM lineitem WHERE l_quantity > 30 GROUP BY 1), e AS (SELECT o_orderkey AS unit, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1), "
        "x AS (SELECT coalesce(l.unit, e.unit) AS unit, CASE WHEN e.unit IS NULL THEN 'unknown' WHEN l.unit IS NULL THEN 'lost' WHEN l.n > 1 THEN 'repeated_line' WHEN e.n > 1 THEN 'repeated_event' END AS violation FROM l FULL JOIN e ON l.unit = e.unit) "
        "SELECT * FROM x WHERE violation IS NOT NULL",
    ),
    "first_wins": (first_wins, "SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) x WHERE rn = 1"),
    "upsert_replace": (
        upsert_replace,
        "WITH n AS (SELECT o_orderkey, o_custkey, CAST(1.0 AS DOUBLE) AS o_totalprice FROM orders WHERE o_custkey % 10 = 3 AND o_orderkey % 2 = 0) "
        "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.o_custkey = orders.o_custkey) UNION ALL SELECT * FROM n",
    ),
    "cascade_delete": (cascade_delete, "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'P')"),
    "set_null": (set_null, "SELECT s_suppkey, CASE WHEN s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) THEN NULL ELSE s_nationkey END AS s_nationkey FROM supplier"),
    "backfill_columns": (backfill_columns, "SELECT CAST(n_nationkey AS INTEGER) AS n_nationkey, n_name, '' AS attaches_to, CAST(NULL AS BIGINT) AS source_unit_id, CAST(0 AS INTEGER) AS present FROM nation"),
    "surrogate_ids": (surrogate_ids, "SELECT c_custkey, CAST(row_number() OVER (ORDER BY -c_nationkey, c_custkey) AS BIGINT) AS id FROM customer"),
    "sibling_positions": (
        sibling_positions,
        "SELECT s_suppkey, s_nationkey, p.position FROM supplier LEFT JOIN (SELECT n_nationkey, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) - 1 AS BIGINT) AS position FROM nation) p ON n_nationkey = s_nationkey",
    ),
    "ordinal_restamp": (ordinal_restamp, "SELECT l_suppkey, CAST(count(*) - 1 AS BIGINT) AS last, count(*) AS n FROM lineitem GROUP BY 1"),
    "schema_diff": (schema_diff, "SELECT * FROM (VALUES ('nation', 'n_nationkey', 'type'), ('nation', 'N_NAME', 'case'), ('nation', 'n_comment', 'missing')) t(relation, \"column\", problem)"),
    "override_counts": (
        override_counts,
        "SELECT n_name AS slug, CAST(sum(n_nationkey * 10 + CASE WHEN n_regionkey = 2 THEN 1 ELSE 0 END) AS BIGINT) AS articles, CAST(sum(CASE WHEN n_regionkey = 2 THEN 1 ELSE 0 END) AS BIGINT) AS delta, count(*) AS n FROM nation GROUP BY ROLLUP (n_name)",
    ),
}
