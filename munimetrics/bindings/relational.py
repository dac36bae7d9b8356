"""Joins, aggregates, sorts and dashboard queries over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from munimetrics.bindings import standins as roles
from munimetrics.bindings.registry import bound, table
from munimetrics.operators import aggregates as agg
from munimetrics.operators import joins, serving
from munimetrics.session import cut_lineage


@bound(
    "join_prefix_key",
    """SELECT o_orderkey, c_acctbal AS total FROM orders LEFT JOIN customer
  ON substring(lpad(CAST(c_custkey AS VARCHAR), greatest(6, length(CAST(c_custkey AS VARCHAR)))::INTEGER, '0') || '9', 1, 6) = lpad(CAST(o_custkey AS VARCHAR), greatest(6, length(CAST(o_custkey AS VARCHAR)))::INTEGER, '0')""",
)
def join_prefix_key(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", roles.padded(F.col("o_custkey"), 6).alias("codigo"))
    census = table(spark, folder, "customer").select(
        F.concat(roles.padded(F.col("c_custkey"), 6), F.lit("9")).alias("codigo7"), "c_acctbal"
    )
    return joins.wide_left_joins(orders, "codigo", {"census": (census, "codigo7", {"c_acctbal": "total"})}).drop("codigo")


@bound(
    "join_admissions",
    """SELECT CAST(c_custkey AS VARCHAR) AS codigo_municipio, c_acctbal, CAST(n AS BIGINT) AS total_internacoes, days AS total_diarias
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, coalesce(CAST(sum(CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 97 END) AS BIGINT), 0) AS days
  FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""",
)
def join_admissions(spark: SparkSession, folder: str) -> DataFrame:
    admissions = table(spark, folder, "orders").groupBy(F.col("o_custkey").cast("string").alias("codigo_municipio")).agg(
        F.count(F.lit(1)).alias("total_internacoes"),
        F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey") % 97)).alias("total_diarias"),
    )
    base = table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("codigo_municipio"), "c_acctbal")
    return joins.join_admissions(base, admissions)


@bound(
    "geo_left_join",
    """SELECT CAST(page_id AS VARCHAR) AS code_muni_abrev, octet_length(encode(html)) AS geometry_bytes, md5(html) AS geometry_md5, cluster
FROM pages LEFT JOIN (SELECT c_custkey, c_nationkey AS cluster FROM customer WHERE c_custkey % 3 = 0) ON c_custkey = page_id""",
)
def geo_left_join(spark: SparkSession, folder: str) -> DataFrame:
    shapes = table(spark, folder, "pages").select(
        F.col("page_id").cast("string").alias("code_muni_abrev"), F.encode("html", "UTF-8").alias("geometry")
    )
    code = F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey").cast("string"))
    data = table(spark, folder, "customer").select(code.alias("codigo_municipio"), F.col("c_nationkey").alias("cluster"))
    joined = joins.attach_geometry(shapes, data)
    return joined.select(
        "code_muni_abrev",
        F.octet_length("geometry").cast("bigint").alias("geometry_bytes"),
        F.md5("geometry").alias("geometry_md5"),
        "cluster",
    )


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_PRIORITY_SQL = ", ".join(
    f"""CAST(nullif(count(*) FILTER (WHERE o_orderpriority = '{p}'), 0) AS BIGINT) AS "{p}" """ for p in _PRIORITIES
)


@bound(
    "wide_with_pivot",
    f"""SELECT c_custkey, c_acctbal, p.* EXCLUDE (o_custkey) FROM customer
LEFT JOIN (SELECT o_custkey, {_PRIORITY_SQL} FROM orders GROUP BY o_custkey) p ON o_custkey = c_custkey""",
)
def wide_with_pivot(spark: SparkSession, folder: str) -> DataFrame:
    counts = agg.pivot_fixed(table(spark, folder, "orders"), ["o_custkey"], "o_orderpriority", values=_PRIORITIES)
    return joins.join_pivot(table(spark, folder, "customer").select("c_custkey", "c_acctbal"), counts, "c_custkey", "o_custkey")


@bound(
    "wide_with_pivot_inner",
    f"""SELECT c_custkey, c_acctbal, p.* EXCLUDE (o_custkey) FROM customer
JOIN (SELECT o_custkey, {_PRIORITY_SQL} FROM orders GROUP BY o_custkey) p ON o_custkey = c_custkey""",
)
def wide_with_pivot_inner(spark: SparkSession, folder: str) -> DataFrame:
    counts = agg.pivot_fixed(table(spark, folder, "orders"), ["o_custkey"], "o_orderpriority", values=_PRIORITIES)
    wide = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return joins.join_pivot(wide, counts, "c_custkey", "o_custkey", "inner")


@bound(
    "join_mixed_keys",
    """SELECT o_orderkey, code, c_name FROM (
  SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE '' END || '00' || CAST(o_custkey AS VARCHAR) AS code FROM orders)
LEFT JOIN customer ON c_custkey = TRY_CAST(code AS BIGINT)""",
)
def join_mixed_keys(spark: SparkSession, folder: str) -> DataFrame:
    prefix = F.when(F.col("o_orderkey") % 11 == 0, F.lit("X")).otherwise(F.lit(""))
    coded = table(spark, folder, "orders").select(
        "o_orderkey", F.concat(prefix, F.lit("00"), F.col("o_custkey").cast("string")).alias("code")
    )
    return joins.lookup(coded, table(spark, folder, "customer"), "code", "c_custkey", ["c_name"])


@bound(
    "pivot_dynamic",
    f"""SELECT o_custkey, {_PRIORITY_SQL}, CAST(nullif(count(*) FILTER (WHERE o_orderpriority IS NULL), 0) AS BIGINT) AS DESCONHECIDO
FROM (SELECT o_custkey, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END AS o_orderpriority FROM orders) GROUP BY o_custkey""",
)
def pivot_dynamic(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        "o_custkey", F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderpriority")).alias("o_orderpriority")
    )
    return agg.pivot_dynamic(orders, ["o_custkey"], "o_orderpriority")


@bound(
    "group_by_all",
    """SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n, CAST(sum(l_quantity) AS DOUBLE) AS quantity
FROM lineitem GROUP BY ALL""",
)
def group_by_all(spark: SparkSession, folder: str) -> DataFrame:
    return agg.group_by_all(
        table(spark, folder, "lineitem"), "l_returnflag", "l_linestatus", "count(*) AS n", "sum(l_quantity) AS quantity"
    )


@bound("distinct_sorted", "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer ORDER BY ALL")
def distinct_sorted(spark: SparkSession, folder: str) -> DataFrame:
    return agg.distinct_sorted(table(spark, folder, "customer"), ["c_mktsegment", "c_nationkey"])


@bound(
    "sort_nulls_last",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price FROM orders
ORDER BY price DESC NULLS LAST, o_orderkey""",
)
def sort_nulls_last(spark: SparkSession, folder: str) -> DataFrame:
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price")
    return agg.sort_nulls_last(
        table(spark, folder, "orders").select("o_orderkey", price), ["price", "o_orderkey"], ["price"]
    )


_CLUSTERED = """clustered AS (SELECT CAST(c_custkey AS VARCHAR) AS codigo_municipio, c_name AS nome, n_name AS uf,
  CAST(hash_label AS INTEGER) AS cluster, CAST(c_custkey % 1000 * 10 AS DOUBLE) AS populacao,
  CASE WHEN c_custkey % 19 <> 0 THEN c_acctbal / 7 END AS idh
  FROM (SELECT *, c_custkey % 5 - 1 AS hash_label FROM customer) JOIN nation ON n_nationkey = c_nationkey)"""


def _clustered(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as clustered municipalities, nations as states."""
    key = F.col("c_custkey")
    people = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return people.select(
        key.cast("string").alias("codigo_municipio"),
        F.col("c_name").alias("nome"),
        F.col("n_name").alias("uf"),
        (key % 5 - 1).cast("int").alias("cluster"),
        (key % 1000 * 10).cast("double").alias("populacao"),
        F.when(key % 19 != 0, F.col("c_acctbal") / 7).alias("idh"),
    )


@bound(
    "dashboard_filter",
    f"""WITH {_CLUSTERED} SELECT codigo_municipio, nome, uf, cluster, round_even(populacao, 2) AS populacao,
  round_even(idh, 2) AS idh, uf || ' - ' || nome AS uf_nome FROM clustered WHERE cluster = 2 AND uf = 'NATION_7'""",
)
def dashboard_filter(spark: SparkSession, folder: str) -> DataFrame:
    return serving.dashboard_filter(serving.dashboard_rows(_clustered(spark, folder)), cluster=2, state="NATION_7")


@bound(
    "indicator_view",
    f"""WITH {_CLUSTERED} SELECT uf || ' - ' || nome AS uf_nome, cluster AS "Cluster", populacao AS "👥 População",
  round_even(idh, 2) AS "📊 IDH" FROM clustered""",
)
def indicator_view(spark: SparkSession, folder: str) -> DataFrame:
    return serving.indicator_view(serving.dashboard_rows(_clustered(spark, folder)))


@bound(
    "kpi_overview",
    f"""WITH {_CLUSTERED} SELECT CAST(count(*) AS BIGINT) AS total_municipios, CAST(count(DISTINCT uf) AS BIGINT) AS total_estados,
  sum(populacao) AS populacao_total, round(avg(idh), 6) AS idh_medio FROM clustered""",
)
def kpi_overview(spark: SparkSession, folder: str) -> DataFrame:
    figures = serving.key_figures(_clustered(spark, folder))
    return figures.withColumn("idh_medio", F.round("idh_medio", 6))


_STATES = """SELECT uf, CAST(count(DISTINCT codigo_municipio) AS BIGINT) AS n_municipios, sum(populacao) AS populacao
FROM clustered GROUP BY uf"""


@bound("top5_states", f"WITH {_CLUSTERED} {_STATES} ORDER BY n_municipios DESC, uf LIMIT 5")
def top5_states(spark: SparkSession, folder: str) -> DataFrame:
    return serving.state_table(_clustered(spark, folder))


@bound("first5_states", f"WITH {_CLUSTERED} SELECT * FROM ({_STATES} ORDER BY uf LIMIT 5)")
def first5_states(spark: SparkSession, folder: str) -> DataFrame:
    return serving.state_table(_clustered(spark, folder), alphabetical=True)


@bound(
    "capacity_ranking",
    f"""WITH {_CLUSTERED} SELECT codigo_municipio, uf, idh,
  CAST(rank() OVER (PARTITION BY uf ORDER BY idh DESC NULLS LAST) AS BIGINT) AS posicao FROM clustered""",
)
def capacity_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return serving.capacity_ranking(_clustered(spark, folder).select("codigo_municipio", "uf", "idh"), "idh")


@bound("cluster_sizes", f"WITH {_CLUSTERED} SELECT cluster, CAST(count(*) AS BIGINT) AS n FROM clustered GROUP BY cluster")
def cluster_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return agg.label_sizes(_clustered(spark, folder))


@bound(
    "crosstab",
    """SELECT o_orderpriority, CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS "F",
  CAST(count(*) FILTER (WHERE o_orderstatus = 'O') AS BIGINT) AS "O", CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS BIGINT) AS "P"
FROM orders GROUP BY o_orderpriority""",
)
def crosstab(spark: SparkSession, folder: str) -> DataFrame:
    return agg.crosstab(table(spark, folder, "orders"), "o_orderpriority", "o_orderstatus")


@bound(
    "count_distinct_by_month",
    """SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT props) AS texts FROM events GROUP BY event_type""",
)
def count_distinct_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct users and texts per type out of monthly sets, without the rows."""
    events = table(spark, folder, "events").withColumn("month", F.date_format("ts", "yyyy-MM"))
    numbers = agg.numbered(events, "props")
    by, counts = ["event_type", "month"], None
    for entity, name, rows in (("user_id", "users", events), ("number", "texts", events.join(numbers, "props", "left"))):
        monthly = cut_lineage(agg.distinct_bitmaps(rows, by, entity))
        merged = agg.bitmap_distinct(monthly, ["event_type"], name)
        counts = merged if counts is None else counts.join(merged, "event_type")
    return counts
