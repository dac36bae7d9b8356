"""Scans, sinks, ingest steps and dedup. File inputs are written by Spark from the benchmark tables first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from munimetrics import config
from munimetrics.bindings import standins as roles
from munimetrics.bindings.registry import bound, table
from munimetrics.functions import text
from munimetrics.operators import dedup
from munimetrics.plans.ingest import clean_deaths
from munimetrics.session import scratch_path
from munimetrics.sources import files, tables

CUSTOMER_REASON = "CASE WHEN c_acctbal > 0 THEN '' WHEN c_custkey % 2 = 0 THEN '01' END"


@bound(
    "scan_delimited",
    f"""SELECT lpad(CAST(c_custkey AS VARCHAR), greatest(7, length(CAST(c_custkey AS VARCHAR)))::INTEGER, '0') AS CO_UNIDADE, c_name || ' São "x"; y' AS NO_FANTASIA,
       {CUSTOMER_REASON} AS CO_MOTIVO_DESAB FROM customer""",
)
def scan_delimited(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").select(
        roles.padded(F.col("c_custkey"), 7).alias("CO_UNIDADE"),
        F.concat("c_name", F.lit(' São "x"; y')).alias("NO_FANTASIA"),
        F.expr(CUSTOMER_REASON).alias("CO_MOTIVO_DESAB"),
    )
    path = scratch_path(spark, "tbestabelecimento")
    tables.write_delimited(rows, path)
    return files.scan_delimited(spark, path)


@bound(
    "scan_parquet",
    """SELECT l_orderkey, l_quantity, l_extendedprice FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1999-01-01' AND l_returnflag = 'N'""",
)
def scan_parquet(spark: SparkSession, folder: str) -> DataFrame:
    shipped, flag = F.col("l_shipdate"), F.col("l_returnflag")
    return files.scan_parquet(
        spark,
        f"{folder}/lineitem.parquet",
        ["l_orderkey", "l_quantity", "l_extendedprice"],
        (shipped >= F.lit("1998-01-01").cast("timestamp_ntz"))
        & (shipped < F.lit("1999-01-01").cast("timestamp_ntz"))
        & (flag == "N"),
    )


SHEET_NUMBERS = {
    "area_km2": "CASE WHEN c_custkey % 7 = 0 THEN '-' ELSE CAST(c_custkey % 50 AS VARCHAR) || '.5' END",
    "populacao_residente": "CAST(c_custkey * 10 AS VARCHAR)",
    "densidade_demografica": "CASE WHEN c_custkey % 5 = 0 THEN '-' ELSE '-' || CAST(c_custkey % 9 AS VARCHAR) END",
    "escolarizacao_6_14": "CAST(c_custkey % 100 AS VARCHAR)",
    "idhm": "'0.' || CAST(c_custkey % 1000 + 1000 AS VARCHAR)",
    "mortalidade_infantil": "CASE WHEN c_custkey % 3 = 0 THEN '-' ELSE CAST(c_custkey % 30 AS VARCHAR) END",
    "total_receitas_brutas_realizadas": "CAST(c_custkey * 1000 AS VARCHAR)",
    "total_despesas_brutas_empenhadas": "CAST(c_custkey * 900 AS VARCHAR)",
    "pib_per_capita": "CAST(c_custkey % 5000 AS VARCHAR) || '.25'",
}


_CODE = "CASE WHEN c_custkey % 11 = 0 THEN 'A-' || CAST(c_custkey AS VARCHAR) ELSE {number} END"


def _city_sheets(spark: SparkSession, folder: str) -> str:
    """A sheet per state: titles, among them a long one, the header, one line per customer, footer notes."""
    people = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    state = F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("uf")
    numbers = [F.expr(sql.replace("VARCHAR", "STRING")) for sql in SHEET_NUMBERS.values()]
    odd = F.concat(F.lit("A-"), F.col("c_custkey").cast("string"))
    code = F.when(F.col("c_custkey") % 11 == 0, odd).otherwise(roles.padded(F.col("c_custkey"), 7))
    cells = [F.col("c_name"), code, F.lit("gentílico"), F.lit("prefeito"), *numbers]
    lines = people.select(state, F.lit(5).alias("rank"), F.concat_ws(",", *cells).alias("value"))
    around = ["Cidades e Estados", "x,1100015," + "título " * 400, ",,", "Código [-],Municipio [-],Gentílico [-]", "", "Notas:", "Fonte,Notas: pesquisa"]
    ranked = F.posexplode(F.array(*[F.lit(line) for line in around])).alias("at", "value")
    others = table(spark, folder, "nation").select(state, ranked)
    others = others.select("uf", F.when(F.col("at") < 4, F.col("at")).otherwise(F.col("at") + 2).alias("rank"), "value")
    path = scratch_path(spark, "cidades")
    # One file per state, its lines in order.
    sheets = lines.unionByName(others).repartition("uf").sortWithinPartitions("uf", "rank").drop("rank")
    sheets.write.mode("overwrite").partitionBy("uf").text(path)
    return path


SHEETS_SQL = "SELECT c_name AS nome, {code} AS codigo_municipio, {numbers}, 'N' || CAST(c_nationkey AS VARCHAR) AS uf FROM customer"
_NUMBERS_SQL = ", ".join(
    f"CAST(regexp_replace({sql}, '-', '0') AS DOUBLE) AS {name}" for name, sql in SHEET_NUMBERS.items()
)
_FULL_CODE = _CODE.format(number="lpad(CAST(c_custkey AS VARCHAR), greatest(7, length(CAST(c_custkey AS VARCHAR)))::INTEGER, '0')")


@bound("sheet_rows_clean", SHEETS_SQL.format(code=_FULL_CODE, numbers=_NUMBERS_SQL))
def sheet_rows_clean(spark: SparkSession, folder: str) -> DataFrame:
    return files.scan_city_sheets(spark, _city_sheets(spark, folder), r"uf=([^/]+)/[^/]*$")


@bound("load_cities", SHEETS_SQL.format(code=f"substring({_FULL_CODE}, 1, 6)", numbers=_NUMBERS_SQL))
def load_cities(spark: SparkSession, folder: str) -> DataFrame:
    sheets = files.scan_city_sheets(spark, _city_sheets(spark, folder), r"uf=([^/]+)/[^/]*$")
    return tables.load_cities(sheets, scratch_path(spark, "tb_cidades"))


@bound(
    "scan_file",
    """SELECT 'csv' AS kind, CAST(c_custkey AS VARCHAR) AS code, c_name AS name FROM customer
UNION ALL SELECT 'parquet', CAST(s_suppkey AS VARCHAR), s_name FROM supplier""",
)
def scan_file(spark: SparkSession, folder: str) -> DataFrame:
    """The same columns from a delimited and a Parquet file, chosen by extension."""
    rows = {
        "csv": table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("code"), F.col("c_name").alias("name")),
        "parquet": table(spark, folder, "supplier").select(F.col("s_suppkey").cast("string").alias("code"), F.col("s_name").alias("name")),
    }
    paths = {kind: f"{scratch_path(spark, 'tbunit')}.{kind}" for kind in rows}
    tables.write_delimited(rows["csv"], paths["csv"])
    tables.write_parquet(rows["parquet"], paths["parquet"])
    return files.union_relaxed(
        [files.scan_file(spark, path).select(F.lit(kind).alias("kind"), "code", "name") for kind, path in paths.items()]
    )


@bound(
    "list_files",
    "SELECT 'tborders' AS base, strftime(o_orderdate, '%Y-%m-01') AS data_competencia FROM orders GROUP BY ALL",
)
def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly files of a table, found by listing alone: their base name and month."""
    orders = table(spark, folder, "orders")
    name = F.concat(F.lit("tbOrders"), F.date_format("o_orderdate", "yyyyMM"), F.lit(".csv"))
    path = scratch_path(spark, "raw")
    tables.write_delimited(orders.select(F.col("o_orderkey").cast("string"), name.alias("file")), path, ["file"])
    dataset = F.regexp_extract("path", r"file=([^/]+)/", 1)
    listed = files.list_files(spark, path, ".csv").where("length > 0")
    return listed.select(
        files.base_table_name(dataset).alias("base"), files.snapshot_date(dataset).alias("data_competencia")
    ).distinct()


@bound(
    "planned_ingest",
    """SELECT o_orderkey::VARCHAR AS "ORDER", CASE WHEN year(o_orderdate) % 3 <> 1 THEN o_orderstatus END AS "STATUS",
  CASE WHEN year(o_orderdate) % 3 <> 0 THEN o_orderpriority || ';"' END AS "PRIORITY", strftime(o_orderdate, '%Y-%m-01') AS data_competencia FROM orders""",
)
def planned_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly files with three kinds of headers, and those of another table beside them, read in one scan."""
    orders = table(spark, folder, "orders")
    own = {"ORDER": F.col("o_orderkey").cast("string"), "STATUS": F.col("o_orderstatus"), "PRIORITY": F.concat("o_orderpriority", F.lit(';"'))}
    path = scratch_path(spark, "raw")
    for kind, names in enumerate((["ORDER", "STATUS"], ["PRIORITY", "ORDER"], ["STATUS", "PRIORITY", "ORDER"])):
        rows = orders.where(F.year("o_orderdate") % 3 == kind)
        file = F.concat(F.lit("tbOrders"), F.date_format("o_orderdate", "yyyyMM"), F.lit(".csv")).alias("file")
        tables.write_delimited(rows.select(*(own[n].alias(n) for n in names), file), f"{path}/kind={kind}", ["file"])
    others = table(spark, folder, "supplier").select(F.col("s_name").alias("NAME"), F.lit("tbSupplier199801.csv").alias("file"))
    tables.write_delimited(others, f"{path}/kind=3", ["file"])

    def dataset(place):
        return F.regexp_extract(place, r"file=([^/]+)/", 1)

    plan = files.plan_headers(spark, path, ".csv", dataset)
    return files.scan_planned(spark, plan, "tborders", dataset)


@bound(
    "load_by_month",
    """SELECT o_orderkey, CASE WHEN month(o_orderdate) % 2 = 1 THEN lower(o_orderpriority) ELSE o_orderpriority END AS priority,
  strftime(o_orderdate, '%Y-%m-01') AS data_competencia FROM orders WHERE month(o_orderdate) % 2 = 0 OR o_orderstatus <> 'F'""",
)
def load_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """Odd months are loaded, then even ones, then odd ones again with other rows."""
    orders = table(spark, folder, "orders")
    month = F.date_format("o_orderdate", "yyyy-MM-01").alias("data_competencia")
    odd, path = F.month("o_orderdate") % 2 == 1, scratch_path(spark, "months")
    own = ["o_orderkey", F.col("o_orderpriority").alias("priority"), month]
    tables.load_months(orders.where(odd).select(*own), path)
    tables.load_months(orders.where(~odd).select(*own), path)
    again = orders.where(odd & (F.col("o_orderstatus") != "F"))
    named = [r[0] for r in orders.where(odd).select(month).distinct().collect()]
    return tables.load_months(again.select("o_orderkey", F.lower("o_orderpriority").alias("priority"), month), path, months=named)


@bound("base_table_name", "SELECT o_orderkey, 'tborders' || lower(o_orderstatus) AS base FROM orders")
def base_table_name(spark: SparkSession, folder: str) -> DataFrame:
    month = F.date_format("o_orderdate", "yyyyMM")
    path = F.concat(F.lit("/raw/tb_Orders-"), "o_orderstatus", month, F.lit(".csv"))
    return table(spark, folder, "orders").select("o_orderkey", files.base_table_name(path).alias("base"))


@bound("find_table", "SELECT o_orderkey, o_totalprice FROM orders")
def find_table(spark: SparkSession, folder: str) -> DataFrame:
    table(spark, folder, "orders").createOrReplaceTempView("munimetrics_orders")
    return tables.find_table(spark, "MuniMetrics_ORDERS").select("o_orderkey", "o_totalprice")


@bound("replace_table", "SELECT c_custkey AS code, c_name AS name, c_acctbal AS balance FROM customer")
def replace_table(spark: SparkSession, folder: str) -> DataFrame:
    """A table of suppliers is replaced by one of customers with another column."""
    path = scratch_path(spark, "catalog")
    name = "munimetrics_" + path.rpartition("-")[2]
    suppliers = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("code"), F.col("s_name").alias("name"))
    tables.replace_table(suppliers, name, path)
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("code"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    tables.replace_table(customers, name, path)
    return tables.find_table(spark, name.upper())


@bound(
    "csv_round_trip",
    """SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN p_name || ' "a, b" \\' || chr(39) END AS name, p_retailprice FROM part""",
)
def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Quotes, separators, backslashes and nulls through a CSV file with header."""
    name = F.when(F.col("p_partkey") % 7 != 0, F.concat("p_name", F.lit(' "a, b" \\' + "'")))
    rows = table(spark, folder, "part").select("p_partkey", name.alias("name"), "p_retailprice")
    path = scratch_path(spark, "report")
    tables.write_csv(rows, path)
    return tables.read_csv(spark, path, "p_partkey bigint, name string, p_retailprice double")


@bound(
    "deaths_with_names",
    f"""SELECT CASE WHEN o_orderstatus = 'P' THEN 'X' ELSE '' END
    || lpad(CAST(o_custkey AS VARCHAR), greatest(7, length(CAST(o_custkey AS VARCHAR)))::INTEGER, '0') AS CODESTAB,
  {roles.PLACE.format('c_nationkey')} AS CODMUNOCOR, n_name AS NO_MUNICIPIO, r_name AS CO_SIGLA_ESTADO
FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN region ON r_regionkey = n_regionkey""",
)
def deaths_with_names(spark: SparkSession, folder: str) -> DataFrame:
    named = clean_deaths(roles.deaths(spark, folder), roles.municipalities(spark, folder))
    return named.select("CODESTAB", "CODMUNOCOR", "NO_MUNICIPIO", "CO_SIGLA_ESTADO")


@bound(
    "union_relaxed",
    """SELECT CAST(s_suppkey AS DOUBLE) AS code, CAST(s_nationkey AS BIGINT) AS place FROM supplier
UNION ALL SELECT c_acctbal, CAST(c_custkey AS BIGINT) FROM customer""",
)
def union_relaxed(spark: SparkSession, folder: str) -> DataFrame:
    supplier = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("code"), F.col("s_nationkey").alias("place"))
    customer = table(spark, folder, "customer").select(F.col("c_acctbal").alias("code"), F.col("c_custkey").alias("place"))
    return files.union_relaxed([supplier, customer])


@bound(
    "union_align",
    """SELECT CAST(NULL AS DOUBLE) AS balance, s_suppkey AS id, s_name AS name, CAST(NULL AS VARCHAR) AS segment FROM supplier
UNION ALL SELECT c_acctbal, c_custkey, c_name, c_mktsegment FROM customer
UNION ALL SELECT NULL, CAST(n_nationkey AS BIGINT), n_name, NULL FROM nation""",
)
def union_align(spark: SparkSession, folder: str) -> DataFrame:
    supplier = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    customer = table(spark, folder, "customer").select(
        F.col("c_name").alias("name"), F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )
    nation = table(spark, folder, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return files.union_aligned([supplier, customer, nation])


@bound(
    "snapshot_from_filename",
    """SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-01') AS data_competencia FROM orders""",
)
def snapshot_from_filename(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written as one file set per month, ``tborders199801.parquet``, and dated by file name."""
    orders = table(spark, folder, "orders")
    name = F.concat(F.lit("tborders"), F.date_format("o_orderdate", "yyyyMM"), F.lit(".parquet"))
    path = scratch_path(spark, "tborders")
    tables.write_parquet(orders.select("o_orderkey", "o_orderstatus", name.alias("file")), path, ["file"])
    read = spark.read.option("recursiveFileLookup", True).parquet(path)
    return files.with_snapshot_date(read).select("o_orderkey", "o_orderstatus", "data_competencia")


@bound(
    "filter_footer",
    """SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 5 = 0 THEN 'Notas: ' || text ELSE text END AS text
FROM documents WHERE doc_id % 11 <> 0 AND doc_id % 5 <> 0 AND NOT contains(text, 'Notas')""",
)
def filter_footer(spark: SparkSession, folder: str) -> DataFrame:
    body = F.col("text")
    noted = F.when(F.col("doc_id") % 11 == 0, F.lit(None)).when(F.col("doc_id") % 5 == 0, F.concat(F.lit("Notas: "), body))
    rows = table(spark, folder, "documents").select("doc_id", noted.otherwise(body).alias("text"))
    return files.drop_footer(rows, "text")


@bound(
    "normalize_columns",
    """SELECT o_orderkey AS chave_do_pedido, o_totalprice AS "valor_total_(r$)", o_orderstatus AS situacao FROM orders""",
)
def normalize_columns(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return text.lower_columns(
        orders.select(
            F.col("o_orderkey").alias("Chave do Pedido"),
            F.col("o_totalprice").alias("Valor Total (R$)"),
            F.col("o_orderstatus").alias("SITUACAO"),
        )
    )


@bound(
    "run_metadata",
    """SELECT CAST(to_json({'table': 'orders', 'rows': count(*), 'statuses': list(DISTINCT o_orderstatus ORDER BY o_orderstatus),
       'params': {'var_threshold': CAST(0.05 AS DOUBLE), 'corr_threshold': CAST(0.9 AS DOUBLE), 'n_clusters': 5},
       'silhouette': CAST(NULL AS INTEGER)}) AS VARCHAR) AS meta
FROM orders""",
)
def run_metadata(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    statuses = orders.groupBy("o_orderstatus").count().orderBy("o_orderstatus").collect()
    meta = {
        "table": "orders",
        "rows": sum(row["count"] for row in statuses),
        "statuses": [row["o_orderstatus"] for row in statuses],
        "params": {"var_threshold": 0.05, "corr_threshold": 0.9, "n_clusters": 5},
        "silhouette": None,
    }
    path = scratch_path(spark, "metadados")
    tables.write_metadata(tables.run_metadata(spark, meta), path)
    return spark.read.text(path).withColumnRenamed("value", "meta")


def _monthly_orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("customer"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        roles.month(F.col("o_orderdate")).alias("data_competencia"),
    )


_MONTHLY = """monthly AS (SELECT o_custkey AS customer, o_orderstatus AS status, o_orderpriority AS priority,
  strftime(o_orderdate, '%Y-%m-01') AS data_competencia FROM orders)"""


@bound(
    "dedup_ignore_snapshot",
    f"WITH {_MONTHLY} SELECT customer, status, priority, max(data_competencia) AS data_competencia FROM monthly GROUP BY ALL",
)
def dedup_ignore_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.dedup_ignoring_snapshot(_monthly_orders(spark, folder))


@bound(
    "snapshot_audit",
    f"""WITH {_MONTHLY}, kept AS (SELECT customer, status, priority FROM monthly GROUP BY ALL)
SELECT CAST((SELECT count(*) FROM monthly) AS BIGINT) AS rows_before, CAST((SELECT count(*) FROM kept) AS BIGINT) AS rows_after,
  CAST((SELECT count(*) FROM monthly WHERE data_competencia = '{roles.SNAPSHOT}') AS BIGINT) AS rows_reference,
  (SELECT count(*) FROM kept) = (SELECT count(*) FROM monthly WHERE data_competencia = '{roles.SNAPSHOT}') AS unchanged""",
)
def snapshot_audit(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.snapshot_report(_monthly_orders(spark, folder), roles.SNAPSHOT)


@bound(
    "dedup_latest_per_key",
    """SELECT event_id, user_id, event_type, day, primeiro, ultimo FROM (
  SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day,
    min(CAST(ts AS DATE)) OVER (PARTITION BY user_id) AS primeiro, max(CAST(ts AS DATE)) OVER (PARTITION BY user_id) AS ultimo,
    row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC, event_id) AS rn
  FROM events) WHERE rn = 1""",
)
def dedup_latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"))
    return dedup.latest_per_key(events, "user_id", "day", ["event_id"], "primeiro", "ultimo")


@bound(
    "first_last_seen",
    """SELECT event_id, user_id, CAST(ts AS DATE) AS day, min(CAST(ts AS DATE)) OVER (PARTITION BY user_id) AS primeiro,
  max(CAST(ts AS DATE)) OVER (PARTITION BY user_id) AS ultimo FROM events""",
)
def first_last_seen(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id", F.to_date("ts").alias("day"))
    return dedup.first_last_seen(events, "user_id", "day", "primeiro", "ultimo")
