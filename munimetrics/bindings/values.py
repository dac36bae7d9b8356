"""Value expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from munimetrics import config
from munimetrics.bindings.registry import bound, table
from munimetrics.functions import scalars, text


def _literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


@bound(
    "clean_label",
    r"""SELECT doc_id, lower(trim(regexp_replace(regexp_replace(strip_accents(regexp_replace(text, '<.*?>', '', 'g')),
  '[^a-zA-Z0-9_\s\-]+', '', 'g'), '[\s\-_]+', '_', 'g'), '_')) AS label FROM documents""",
)
def clean_label(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", text.clean_label(F.col("text")).alias("label"))


_TITLE = r"""array_to_string(list_transform(regexp_extract_all(lower(trim({0}, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ' || chr(133) || chr(160))),
  '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+'), lambda t: CASE WHEN t[1] = 'ß' THEN 'SS' ELSE upper(t[1]) END || t[2:]), '')"""


@bound(
    "titlecase_strings",
    f"SELECT doc_id, {_TITLE.format('text')} AS text, {_TITLE.format('lang')} AS lang, {_TITLE.format('source')} AS source FROM documents",
)
def titlecase_strings(spark: SparkSession, folder: str) -> DataFrame:
    return text.title_case_strings(table(spark, folder, "documents").select("doc_id", "text", "lang", "source"))


# Field of the death record -> SQL expression over orders that gives its code.
CODES = {
    "SEXO": "CAST(o_orderkey % 4 AS STRING)",
    "RACACOR": "substring(o_orderpriority, 1, 1)",
    "ESTCIV": "CAST(o_custkey % 7 AS STRING)",
    "ESC2010": "CAST(o_orderkey % 8 AS STRING)",
    "LOCOCOR": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderkey % 9 AS STRING) END",
    "GRAVIDEZ": "CAST(o_custkey % 5 AS STRING)",
    "PARTO": "CAST(o_custkey % 3 AS STRING)",
    "OBITOPARTO": "CAST(o_orderkey % 5 AS STRING)",
    "TPMORTEOCO": "CAST(o_orderkey % 10 AS STRING)",
    "CIRCOBITO": "CAST(o_custkey % 6 AS STRING)",
    "ACIDTRAB": "o_orderstatus",
    "FONTE": "CAST(o_orderkey % 6 AS STRING)",
}


def _recoded(field: str) -> str:
    labels, default = config.MORTALITY_CODES[field]
    cases = " ".join(f"WHEN {_literal(code)} THEN {_literal(label)}" for code, label in labels.items())
    return f"CASE {CODES[field].replace('STRING', 'VARCHAR')} {cases} ELSE {_literal(default)} END AS {field}"


@bound("recode_values", f"SELECT o_orderkey, {', '.join(map(_recoded, CODES))} FROM orders")
def recode_values(spark: SparkSession, folder: str) -> DataFrame:
    codes = [F.expr(sql).alias(field) for field, sql in CODES.items()]
    return scalars.recode_columns(table(spark, folder, "orders").select("o_orderkey", *codes))


@bound(
    "remap_codes",
    f"""SELECT c_custkey, CASE WHEN code IN ({', '.join(map(_literal, config.DISTRICT_CODES))}) THEN '530010' ELSE code END AS code
FROM (SELECT c_custkey, '530' || lpad(CAST(c_custkey % 200 AS VARCHAR), 3, '0') AS code FROM customer)""",
)
def remap_codes(spark: SparkSession, folder: str) -> DataFrame:
    code = F.concat(F.lit("530"), F.lpad((F.col("c_custkey") % 200).cast("string"), 3, "0"))
    return table(spark, folder, "customer").select(
        "c_custkey", scalars.remap_codes(code, config.DISTRICT_CODES, config.CAPITAL_DISTRICT_CODE).alias("code")
    )


_DASHED = "CASE l_linenumber % 4 WHEN 0 THEN '-' WHEN 1 THEN '-' || CAST(CAST(l_quantity AS BIGINT) AS {0}) WHEN 2 THEN CAST(CAST(l_quantity AS BIGINT) AS {0}) || '.5' END"


@bound(
    "parse_dash_numeric",
    f"SELECT l_orderkey, l_linenumber, CAST(regexp_replace({_DASHED.format('VARCHAR')}, '-', '0') AS DOUBLE) AS number FROM lineitem",
)
def parse_dash_numeric(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.expr(_DASHED.format("STRING"))
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", text.parse_dash_numeric(raw).alias("number")
    )


@bound("filter_ilike", "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%BOLT%'")
def filter_ilike(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").where(F.col("p_name").ilike("%BOLT%")).select("p_partkey", "p_name")


@bound(
    "concat_label",
    """SELECT c_custkey, r_name || ' - ' || c_name AS uf_nome FROM customer
LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey % 5 <> 0 LEFT JOIN region ON r_regionkey = n_regionkey""",
)
def concat_label(spark: SparkSession, folder: str) -> DataFrame:
    known = F.when(F.col("n_nationkey") % 5 != 0, F.col("n_nationkey")).alias("known")
    nation = table(spark, folder, "nation").select(known, "n_regionkey")
    places = nation.join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    people = table(spark, folder, "customer").join(places, F.col("c_nationkey") == F.col("known"), "left")
    return people.select("c_custkey", text.concat_label(F.col("r_name"), F.col("c_name")).alias("uf_nome"))


def _customers_with_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
    sums = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.max("o_orderstatus").alias("status")
    )
    return table(spark, folder, "customer").join(sums, F.col("c_custkey") == F.col("o_custkey"), "left").drop("o_custkey")


_ORDERED = """ordered AS (SELECT c.*, n, total, status FROM customer c LEFT JOIN (
  SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total, max(o_orderstatus) AS status
  FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' GROUP BY o_custkey) ON o_custkey = c_custkey)"""


@bound(
    "fill_nulls",
    f"""WITH {_ORDERED} SELECT c_custkey, CAST(coalesce(n, 0) AS BIGINT) AS n, coalesce(total, 0.0) AS total,
  coalesce(status, '0') AS status FROM ordered""",
)
def fill_nulls(spark: SparkSession, folder: str) -> DataFrame:
    return scalars.fill_all(_customers_with_orders(spark, folder).select("c_custkey", "n", "total", "status"))


@bound(
    "row_sum_index",
    """SELECT o_custkey,
  CAST(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') + count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS BIGINT) AS indice
FROM orders GROUP BY o_custkey""",
)
def row_sum_index(spark: SparkSession, folder: str) -> DataFrame:
    from munimetrics.operators.aggregates import pivot_fixed

    wide = pivot_fixed(table(spark, folder, "orders"), ["o_custkey"], "o_orderpriority", values=["1-URGENT", "2-HIGH"])
    return wide.select("o_custkey", scalars.row_sum(["1-URGENT", "2-HIGH"]).cast("bigint").alias("indice"))


@bound(
    "rates_per_k",
    """SELECT c_nationkey AS place, round(units / people * 1000.0, 6) AS unidades_por_k_hab, round(people / units, 2) AS hab_por_unidade,
  round(100 - share, 6) AS complemento
FROM (SELECT c_nationkey, count(*) * 1000.0 AS people, 100.0 * count(*) FILTER (WHERE c_acctbal > 0) / count(*) AS share
      FROM customer GROUP BY c_nationkey)
LEFT JOIN (SELECT s_nationkey, nullif(count(*) FILTER (WHERE s_acctbal > 2000), 0) AS units FROM supplier GROUP BY s_nationkey)
  ON s_nationkey = c_nationkey""",
)
def rates_per_k(spark: SparkSession, folder: str) -> DataFrame:
    people = table(spark, folder, "customer").groupBy("c_nationkey").agg(
        (F.count(F.lit(1)) * 1000.0).alias("people"),
        (F.count_if(F.col("c_acctbal") > 0) * 100.0 / F.count(F.lit(1))).alias("share"),
    )
    units = table(spark, folder, "supplier").groupBy("s_nationkey").agg(F.count_if(F.col("s_acctbal") > 2000).alias("units"))
    both = people.join(units, F.col("c_nationkey") == F.col("s_nationkey"), "left")
    per_k = F.nullif(scalars.per_thousand(F.col("units"), F.col("people")), F.lit(0.0))
    return both.select(
        F.col("c_nationkey").alias("place"),
        F.round(per_k, 6).alias("unidades_por_k_hab"),
        F.round(scalars.ratio(F.col("people"), F.col("units")), 2).alias("hab_por_unidade"),
        F.round(100 - F.col("share"), 6).alias("complemento"),
    )


@bound(
    "deaths_outside",
    """SELECT o_custkey, CAST(count(*) - count(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS obitos_fora_estabelecimento
FROM orders GROUP BY o_custkey""",
)
def deaths_outside(spark: SparkSession, folder: str) -> DataFrame:
    counts = table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("total_obitos"), F.count_if(F.col("o_orderstatus") == "F").alias("obitos_em_estabelecimentos")
    )
    outside = F.col("total_obitos") - F.col("obitos_em_estabelecimentos")
    return counts.select("o_custkey", outside.alias("obitos_fora_estabelecimento"))


@bound(
    "occupancy_rate",
    """SELECT c_custkey, CASE WHEN beds = 0 THEN 0.0 ELSE round(days / (beds * 365) * 100, 2) END AS taxa_ocupacao_anual FROM (
  SELECT c_custkey, coalesce(count(o_orderkey) FILTER (WHERE o_orderstatus = 'F'), 0) AS beds,
    coalesce(sum(o_orderkey % 97), 0) AS days
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)""",
)
def occupancy_rate(spark: SparkSession, folder: str) -> DataFrame:
    counts = table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").cast("double").alias("beds"),
        F.sum(F.col("o_orderkey") % 97).cast("double").alias("days"),
    )
    people = table(spark, folder, "customer").join(counts, F.col("c_custkey") == F.col("o_custkey"), "left")
    rate = scalars.occupancy_rate(F.col("days"), F.col("beds"))
    return people.select("c_custkey", rate.alias("taxa_ocupacao_anual"))


@bound(
    "round_columns",
    """SELECT p_partkey, round_even(p_retailprice / 8, 2) AS eighth, round_even(CAST(p_size + 0.125 AS DOUBLE), 2) AS tied,
  round(p_retailprice / 7, 3) AS away FROM part""",
)
def round_columns(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("p_retailprice")
    # Inside a struct the third column is none of the doubles that are rounded.
    part = table(spark, folder, "part").select(
        "p_partkey", (price / 8).alias("eighth"), (F.col("p_size") + F.lit(0.125)).alias("tied"),
        F.struct(F.round(price / 7, 3).alias("away")).alias("other"),
    )
    return scalars.round_doubles(part, 2).select("p_partkey", "eighth", "tied", "other.away")


_STATES = sorted(config.CAPITALS)
_STATE_SQL = "CASE WHEN c_custkey % 29 < 27 THEN list_value({})[c_custkey % 29 + 1] WHEN c_custkey % 29 = 27 THEN 'XX' END".format(
    ", ".join(map(_literal, _STATES))
)


def _with_state(spark: SparkSession, folder: str) -> DataFrame:
    index = F.col("c_custkey") % 29
    state = F.when(index < 27, F.try_element_at(F.array(*map(F.lit, _STATES)), (index + 1).cast("int"))).when(
        index == 27, F.lit("XX")
    )
    return table(spark, folder, "customer").select("c_custkey", state.alias("uf"))


_REGION_CASE = " ".join(
    f"WHEN uf IN ({', '.join(map(_literal, states))}) THEN {_literal(region)}" for region, states in config.REGIONS.items()
)


@bound(
    "map_region",
    f"SELECT c_custkey, uf, CASE {_REGION_CASE} ELSE 'Região Desconhecida' END AS regiao FROM (SELECT c_custkey, {_STATE_SQL} AS uf FROM customer)",
)
def map_region(spark: SparkSession, folder: str) -> DataFrame:
    return _with_state(spark, folder).withColumn("regiao", scalars.region_of(F.col("uf")))


_CAPITAL_CASE = " ".join(f"WHEN {_literal(uf)} THEN {_literal(name)}" for uf, name in config.CAPITALS.items())


@bound(
    "flag_capital",
    f"""SELECT c_custkey, nome, coalesce(nome = CASE uf {_CAPITAL_CASE} END, FALSE) AS capital FROM (
  SELECT c_custkey, uf, CASE WHEN c_custkey % 3 = 0 THEN 'Salvador' WHEN c_custkey % 3 = 1 THEN CASE uf {_CAPITAL_CASE} END END AS nome
  FROM (SELECT c_custkey, {_STATE_SQL} AS uf FROM customer))""",
)
def flag_capital(spark: SparkSession, folder: str) -> DataFrame:
    capital = F.try_element_at(scalars.literal_map(config.CAPITALS), F.col("uf"))
    third = F.col("c_custkey") % 3
    named = _with_state(spark, folder).withColumn(
        "nome", F.when(third == 0, F.lit("Salvador")).when(third == 1, capital)
    )
    return named.select("c_custkey", "nome", scalars.is_capital(F.col("nome"), F.col("uf")).alias("capital"))


@bound("feature_subset", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def feature_subset(spark: SparkSession, folder: str) -> DataFrame:
    return scalars.feature_subset(table(spark, folder, "customer"), ["c_custkey", "c_name", "regiao"], ["c_acctbal", "idh"])
