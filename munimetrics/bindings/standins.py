"""Benchmark tables in the roles of the health registries, as Spark frames and as the same SQL.

Nations are municipalities, suppliers facilities, line items beds and workers, parts occupations,
orders deaths, customers the population.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from munimetrics import config
from munimetrics.bindings.registry import table
from munimetrics.plans.municipal import Registry
from munimetrics.session import cut_lineage

SNAPSHOT = "1998-12-01"
PHYSICIAN, NURSE = "%bolt%", "%gear%"
OTHER_TYPE = "OUTRO TIPO"
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def padded(number: Column, width: int) -> Column:
    """Zeros in front up to the width; a longer number stays whole."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def place_code(nation: Column) -> Column:
    return F.concat(F.lit("11"), padded(nation, 4))


def month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-01")


def facilities(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(
        padded(key, 7).alias("CO_UNIDADE"),
        key.cast("string").alias("CO_CNES"),
        F.when(key % 17 == 0, F.lit("999999")).otherwise(place_code(F.col("s_nationkey"))).alias("CO_MUNICIPIO_GESTOR"),
        F.when(F.col("s_acctbal") > 0, F.lit("")).when(key % 2 == 0, F.lit("01")).alias("CO_MOTIVO_DESAB"),
        padded(key % 41, 2).alias("TP_UNIDADE"),
        F.col("s_name").alias("NO_FANTASIA"),
        (key % 7).cast("string").alias("CO_TIPO_ESTABELECIMENTO"),
        padded(key % 30, 3).alias("CO_ATIVIDADE_PRINCIPAL"),
    )


def beds(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        padded(F.col("l_suppkey"), 7).alias("CO_UNIDADE"),
        F.col("l_returnflag").alias("CO_TIPO_LEITO"),
        F.col("l_quantity").cast("bigint").alias("QT_EXIST"),
        F.when(F.col("l_returnflag") == "N", F.col("l_quantity")).otherwise(0).cast("bigint").alias("QT_SUS"),
        month(F.col("l_shipdate")).alias("data_competencia"),
    )


def deaths(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    code = padded(F.col("o_custkey"), 7)
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("X"), code)).otherwise(code).alias("CODESTAB"),
        place_code(F.col("c_nationkey")).alias("CODMUNOCOR"),
    )


def municipalities(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        place_code(F.col("n_nationkey")).alias("CO_MUNICIPIO"),
        F.col("n_name").alias("NO_MUNICIPIO"),
        F.col("r_name").alias("CO_SIGLA_ESTADO"),
    )


def unit_types(spark: SparkSession) -> DataFrame:
    rows = [(f"{i:02d}", name) for i, name in enumerate([*config.FACILITY_TYPES, OTHER_TYPE])]
    return spark.createDataFrame(rows, "CO_TIPO_UNIDADE string, DS_TIPO_UNIDADE string")


def facility_types(spark: SparkSession, folder: str) -> DataFrame:
    """Regions; two of the seven codes that facilities bear stand for none."""
    region = table(spark, folder, "region")
    return region.select(F.col("r_regionkey").cast("string").alias("CO_TIPO_ESTABELECIMENTO"), F.col("r_name").alias("DS_TIPO_ESTABELECIMENTO"))


def activities(spark: SparkSession, folder: str) -> DataFrame:
    """Nations; five of the thirty codes stand for none, and every third has no concept."""
    key = F.col("n_nationkey")
    concept = F.when(key % 3 > 0, F.concat(F.lit("de "), F.col("n_name"))).alias("DS_CONCEITO_ATIVIDADE")
    return table(spark, folder, "nation").select(padded(key, 3).alias("CO_ATIVIDADE"), F.col("n_name").alias("DS_ATIVIDADE"), concept)


def population(spark: SparkSession, folder: str) -> DataFrame:
    """Customers per nation, with the share of each segment in percent. One row per nation."""
    customers = table(spark, folder, "customer").groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("c_acctbal"), 4).alias("balance"),
        *[F.round(F.count_if(F.col("c_mktsegment") == s) * 100.0 / F.count(F.lit(1)), 4).alias(s) for s in SEGMENTS],
    )
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).join(
        customers, F.col("n_nationkey") == F.col("c_nationkey")
    )


def cities(people: DataFrame) -> DataFrame:
    n, nation, balance = F.col("n"), F.col("n_nationkey"), F.col("balance")
    return people.select(
        F.col("n_name").alias("nome"),
        F.when(nation < 24, place_code(nation)).alias("codigo_municipio"),
        (nation * 10.0 + 100).alias("area_km2"),
        (n * 1000.0).alias("populacao_residente"),
        F.round(n * 1000.0 / (nation * 10.0 + 100), 4).alias("densidade_demografica"),
        F.col("BUILDING").alias("escolarizacao_6_14"),
        F.round(balance / 10000, 4).alias("idhm"),
        F.col("FURNITURE").alias("mortalidade_infantil"),
        (balance * 100).alias("total_receitas_brutas_realizadas"),
        (balance * 90).alias("total_despesas_brutas_empenhadas"),
        balance.alias("pib_per_capita"),
        F.col("r_name").alias("uf"),
    )


# Census table -> its column -> segment share that stands for it.
CENSUS_SOURCES = {
    "taxa_de_alfabetizacao": {"total": "AUTOMOBILE"},
    "taxa_coleta_lixo": {"pct_coletado": "BUILDING"},
    "taxa_rede_esgoto": {"sim": "FURNITURE", "nao": "HOUSEHOLD"},
    "anos_de_estudo": {
        "total": "MACHINERY", "11_14": "AUTOMOBILE", "15_17": "BUILDING", "18_24": "FURNITURE", "25_mais": "HOUSEHOLD",
    },
    "taxa_populacao_nivel_instrucao": {
        "sem_instrucao_fundamental_incompleto": "AUTOMOBILE",
        "fundamental_completo_medio_incompleto": "BUILDING",
        "medio_completo_superior_incompleto": "FURNITURE",
        "superior_completo": "HOUSEHOLD",
    },
    "taxa_distribuicao_etaria": {"pct_60_mais": "MACHINERY"},
    "pop_res_favela": {"total": "n"},
    "taxa_situacao_domicilio": {"urbana": "AUTOMOBILE", "rural": "MACHINERY"},
    "taxa_frequencia_escolar": {"total": "HOUSEHOLD"},
}


def census(people: DataFrame) -> dict[str, DataFrame]:
    nation = F.col("n_nationkey")
    code = F.concat(place_code(nation), (nation % 10).cast("string")).alias("codigo")
    return {
        name: people.select(code, *[F.col(source).cast("double").alias(c) for c, source in columns.items()])
        for name, columns in CENSUS_SOURCES.items()
    }


def registry(spark: SparkSession, folder: str, write_people: bool = False) -> Registry:
    """The tables in their roles; ``write_people`` writes the population first, for jobs that read it many times."""
    lineitem, part = table(spark, folder, "lineitem"), table(spark, folder, "part")
    people = population(spark, folder)
    if write_people:
        people = cut_lineage(people)
    return Registry(
        facilities=facilities(spark, folder),
        beds=beds(spark, folder),
        deaths=deaths(spark, folder),
        municipalities=municipalities(spark, folder),
        unit_types=unit_types(spark),
        workers=lineitem.select(
            padded(F.col("l_suppkey"), 7).alias("CO_UNIDADE"),
            F.col("l_orderkey").alias("CO_PROFISSIONAL_SUS"),
            F.col("l_partkey").alias("CO_CBO"),
            F.when(F.col("l_linestatus") == "O", F.lit("S")).otherwise(F.lit("N")).alias("TP_SUS_NAO_SUS"),
        ),
        occupations=part.select(
            F.col("p_partkey").alias("CO_CBO"), F.upper("p_name").alias("DS_ATIVIDADE_PROFISSIONAL"),
            F.col("p_brand").alias("TP_CLASSIFICACAO_PROFISSIONAL"), F.when(F.col("p_size") % 2 == 0, F.lit("S")).alias("TP_CBO_SAUDE"),
        ),
        cities=cities(people),
        census=census(people),
        facility_types=facility_types(spark, folder),
        activities=activities(spark, folder),
    )


def part_features(spark: SparkSession, folder: str) -> DataFrame:
    """One row per part with measures of its line items: the numeric feature matrix."""
    lines = table(spark, folder, "lineitem").groupBy("l_partkey").agg(
        F.count(F.lit(1)).cast("double").alias("lines"),
        F.sum("l_quantity").alias("quantity"),
        F.sum("l_extendedprice").alias("price"),
        F.avg("l_discount").alias("discount"),
        F.avg("l_tax").alias("tax"),
    )
    part = table(spark, folder, "part").select("p_partkey", "p_type", F.col("p_size").cast("double").alias("size"))
    return part.join(lines, F.col("p_partkey") == F.col("l_partkey")).drop("l_partkey")


FEATURES = ["lines", "quantity", "price", "discount", "tax", "size"]

# The same roles in SQL.
PLACE = "'11' || lpad(CAST({0} AS VARCHAR), greatest(4, length(CAST({0} AS VARCHAR)))::INTEGER, '0')"
FACILITIES_SQL = f"""
facilities AS (
  SELECT s_suppkey AS unit, CASE WHEN s_suppkey % 17 = 0 THEN NULL ELSE s_nationkey END AS place,
         coalesce(s_acctbal > 0, FALSE) AS active, s_suppkey % 41 AS unit_type
  FROM supplier)"""
BEDS_SQL = """
beds AS (
  SELECT l_suppkey AS unit, CAST(l_quantity AS BIGINT) AS n,
         CAST(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END AS BIGINT) AS sus,
         strftime(l_shipdate, '%Y-%m-01') AS snapshot
  FROM lineitem)"""
SHARES_SQL = ", ".join(
    f"round(count(*) FILTER (WHERE c_mktsegment = '{s}') * 100.0 / count(*), 4) AS {s}" for s in SEGMENTS
)
PEOPLE_SQL = f"""
people AS (
  SELECT n_nationkey AS place, n_name, r_name, c.* EXCLUDE (c_nationkey)
  FROM nation JOIN region ON n_regionkey = r_regionkey
  JOIN (SELECT c_nationkey, count(*) AS n, round(avg(c_acctbal), 4) AS balance, {SHARES_SQL}
        FROM customer GROUP BY c_nationkey) c ON c_nationkey = n_nationkey)"""
FEATURES_SQL = """
features AS (
  SELECT p_partkey, p_type, lines, quantity, price, discount, tax, CAST(p_size AS DOUBLE) AS size
  FROM part JOIN (
    SELECT l_partkey, CAST(count(*) AS DOUBLE) AS lines, sum(l_quantity) AS quantity, sum(l_extendedprice) AS price,
           avg(l_discount) AS discount, avg(l_tax) AS tax
    FROM lineitem GROUP BY l_partkey) ON p_partkey = l_partkey)"""
