"""The municipal table and its parts over the stand-in registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from munimetrics import config
from munimetrics.bindings import standins as roles
from munimetrics.bindings.registry import bound
from munimetrics.operators import aggregates as agg, joins
from munimetrics.plans import municipal


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def named(text: str) -> str:
    return '"' + text.replace('"', '""') + '"'


_TYPE_COUNTS = ",\n    ".join(
    f"count(*) FILTER (WHERE unit_type = {i}) AS t{i}" for i in range(len(config.FACILITY_TYPES))
)
_TYPE_COLUMNS = ",\n  ".join(
    f"CAST(nullif(t{i}, 0) AS BIGINT) AS {named(name)}" for i, name in enumerate(config.FACILITY_TYPES)
)
_CENSUS = ",\n  ".join(
    f"round({source}, 6) AS {config.CENSUS_COLUMNS[name][column]}"
    for name, columns in roles.CENSUS_SOURCES.items()
    if name != "pop_res_favela"
    for column, source in columns.items()
)

MUNICIPAL_SQL = f"""
WITH {roles.FACILITIES_SQL}, {roles.BEDS_SQL}, {roles.PEOPLE_SQL},
unit_beds AS (SELECT unit, sum(n) AS beds, sum(sus) AS sus FROM beds WHERE snapshot = '{roles.SNAPSHOT}' GROUP BY unit),
unit_deaths AS (
  SELECT o_custkey AS unit, count(*) AS deaths FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey),
care AS (
  SELECT f.place, count(DISTINCT f.unit) AS units, sum(beds) AS beds, sum(sus) AS sus, sum(deaths) AS deaths,
    count(*) FILTER (WHERE beds > 0) AS with_beds,
    {_TYPE_COUNTS}
  FROM facilities f LEFT JOIN unit_beds b ON b.unit = f.unit LEFT JOIN unit_deaths d ON d.unit = f.unit
  WHERE f.active GROUP BY f.place),
everywhere AS (SELECT place, count(*) AS units FROM facilities GROUP BY place),
place_deaths AS (SELECT c_nationkey AS place, count(*) AS deaths FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
staff AS (
  SELECT f.place,
    nullif(count(DISTINCT l_orderkey) FILTER (WHERE p_name ILIKE '{roles.PHYSICIAN}'), 0) AS physicians,
    nullif(count(DISTINCT l_orderkey) FILTER (WHERE p_name ILIKE '{roles.NURSE}'), 0) AS nurses
  FROM lineitem JOIN facilities f ON f.unit = l_suppkey JOIN part ON p_partkey = l_partkey
  WHERE f.place IS NOT NULL GROUP BY f.place)
SELECT
  city.r_name AS uf, {roles.PLACE.format('city.place')} AS codigo_municipio, city.n_name AS nome,
  CAST(city.n * 1000 AS DOUBLE) AS populacao, round(city.balance / 10000, 4) AS idh,
  CAST(care.units AS BIGINT) AS qtd_unidades,
  round(city.n * 1000.0 / everywhere.units, 2) AS hab_por_unidade,
  round(care.units / (city.n * 1000.0) * 1000, 6) AS unidades_por_k_hab,
  round(physicians / (city.n * 1000.0) * 1000, 6) AS medicos_por_k_habitante,
  round(city.n * 1000.0 / physicians, 6) AS habitantes_por_medico,
  round(nurses / (city.n * 1000.0) * 1000, 6) AS enfermeiros_por_k_habitante,
  round(city.n * 1000.0 / nurses, 6) AS habitantes_por_enfermeiros,
  CAST(care.beds AS BIGINT) AS leitos_existentes,
  CAST(CASE WHEN care.place IS NOT NULL THEN nullif(with_beds, 0) END AS BIGINT) AS quantidade_unidades_com_leito,
  round(nullif(with_beds, 0) / (city.n * 1000.0) * 1000, 6) AS quantidade_unidades_com_leito_por_k_hab,
  round(care.beds / care.units, 2) AS total_leitos_unidade,
  round(care.beds / (city.n * 1000.0) * 1000, 6) AS leitos_por_k_hab,
  CAST(care.sus AS BIGINT) AS leitos_sus,
  round(care.sus / care.units, 2) AS total_leitos_sus_unidade,
  round(care.sus / (city.n * 1000.0) * 1000, 6) AS leitos_sus_por_k_hab,
  round(care.deaths / care.units, 2) AS obitos_por_unidade,
  CAST(care.deaths AS BIGINT) AS obitos_em_estabelecimentos,
  CAST(pd.deaths AS BIGINT) AS total_obitos,
  round(pd.deaths / (city.n * 1000.0) * 1000, 2) AS taxa_mortalidade_geral,
  city.FURNITURE AS mortalidade_infantil, CAST(city.place * 10 + 100 AS DOUBLE) AS area_territorial,
  round(city.n * 1000.0 / (city.place * 10.0 + 100), 4) AS densidade_demografica,
  city.BUILDING AS matriculas_ensino_medio,
  round(city.balance * 100, 6) AS total_receitas_brutas, round(city.balance * 90, 6) AS total_despesas_brutas,
  city.balance AS pib_per_capita,
  round(100 - census.AUTOMOBILE, 6) AS taxa_de_nao_alfabetizados,
  round(census.n / (city.n * 1000.0), 6) AS taxa_pop_residente_favela,
  {_CENSUS.replace('round(', 'round(census.')},
  {_TYPE_COLUMNS}
FROM care LEFT JOIN people city ON city.place = care.place AND city.place < 24
LEFT JOIN people census ON census.place = care.place
LEFT JOIN everywhere ON everywhere.place = city.place
LEFT JOIN place_deaths pd ON pd.place = care.place
LEFT JOIN staff ON staff.place = care.place
"""


def _rounded(df: DataFrame) -> DataFrame:
    """Six decimals, so that the order of additions does not show."""
    doubles = [f.name for f in df.schema if f.dataType.typeName() == "double"]
    return df.withColumns({c: F.round(F.col(f"`{c}`"), 6) for c in doubles})


@bound("wide_municipal_table", MUNICIPAL_SQL)
def wide_municipal_table(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(
        municipal.municipal_table(roles.registry(spark, folder, True), roles.SNAPSHOT, roles.PHYSICIAN, roles.NURSE)
    )


@bound(
    "care_summary",
    f"""WITH {roles.FACILITIES_SQL}, {roles.BEDS_SQL}, {roles.PEOPLE_SQL},
unit_beds AS (SELECT unit, sum(n) AS beds FROM beds WHERE snapshot = '{roles.SNAPSHOT}' GROUP BY unit),
care AS (SELECT coalesce({roles.PLACE.format('place')}, '999999') AS code, count(DISTINCT f.unit) AS units, sum(beds) AS beds
         FROM facilities f LEFT JOIN unit_beds b ON b.unit = f.unit WHERE active GROUP BY ALL)
SELECT code AS codigo_municipio, CAST(units AS BIGINT) AS qtd_unidades, CAST(beds AS BIGINT) AS leitos_existentes,
       round(units / (n * 1000.0) * 1000, 6) AS unidades_por_k_hab,
       round(beds / (n * 1000.0) * 1000, 6) AS leitos_por_k_hab
FROM care LEFT JOIN people ON {roles.PLACE.format('people.place')} = code AND people.place < 24""",
)
def care_summary(spark: SparkSession, folder: str) -> DataFrame:
    return municipal.care_summary(roles.registry(spark, folder), roles.SNAPSHOT)


@bound(
    "filter_active_snapshot",
    f"""WITH {roles.FACILITIES_SQL} SELECT lpad(CAST(unit AS VARCHAR), greatest(7, length(CAST(unit AS VARCHAR)))::INTEGER, '0') AS CO_UNIDADE, CAST(unit AS VARCHAR) AS CO_CNES
FROM facilities WHERE active""",
)
def filter_active_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return municipal.active(roles.facilities(spark, folder)).select("CO_UNIDADE", "CO_CNES")


@bound(
    "active_facilities",
    f"WITH {roles.FACILITIES_SQL} SELECT CAST(count(DISTINCT unit) AS BIGINT) AS estabelecimentos_ativos FROM facilities WHERE active",
)
def active_facilities(spark: SparkSession, folder: str) -> DataFrame:
    return municipal.active_count(roles.facilities(spark, folder))


@bound(
    "semi_join_active",
    f"""WITH {roles.FACILITIES_SQL}, {roles.BEDS_SQL}
SELECT lpad(CAST(unit AS VARCHAR), greatest(7, length(CAST(unit AS VARCHAR)))::INTEGER, '0') AS CO_UNIDADE, n AS QT_EXIST, sus AS QT_SUS FROM beds
WHERE snapshot = '{roles.SNAPSHOT}' AND unit IN (SELECT unit FROM facilities WHERE active)""",
)
def semi_join_active(spark: SparkSession, folder: str) -> DataFrame:
    rows = roles.beds(spark, folder).where(F.col("data_competencia") == roles.SNAPSHOT)
    kept = joins.keep_matching(rows, municipal.active(roles.facilities(spark, folder)), "CO_UNIDADE")
    return kept.select("CO_UNIDADE", "QT_EXIST", "QT_SUS")


@bound(
    "agg_beds",
    f"""WITH {roles.FACILITIES_SQL}, {roles.BEDS_SQL}
SELECT lpad(CAST(unit AS VARCHAR), greatest(7, length(CAST(unit AS VARCHAR)))::INTEGER, '0') AS CO_UNIDADE, CAST(sum(n) AS BIGINT) AS leitos_existentes,
       CAST(sum(sus) AS BIGINT) AS leitos_sus
FROM beds WHERE snapshot = '{roles.SNAPSHOT}' AND unit IN (SELECT unit FROM facilities WHERE active) GROUP BY unit""",
)
def agg_beds(spark: SparkSession, folder: str) -> DataFrame:
    keep = municipal.active(roles.facilities(spark, folder))
    return municipal.beds_per_facility(roles.beds(spark, folder), keep, roles.SNAPSHOT)


@bound(
    "star_left_join",
    f"""WITH {roles.FACILITIES_SQL}, {roles.BEDS_SQL},
types(unit_type, name) AS (VALUES {", ".join(f"({i}, {quoted(n)})" for i, n in enumerate([*config.FACILITY_TYPES, roles.OTHER_TYPE]))}),
unit_beds AS (SELECT unit, sum(n) AS beds, sum(sus) AS sus FROM beds WHERE snapshot = '{roles.SNAPSHOT}' GROUP BY unit)
SELECT lpad(CAST(f.unit AS VARCHAR), greatest(7, length(CAST(f.unit AS VARCHAR)))::INTEGER, '0') AS CO_UNIDADE, region.r_name AS CO_SIGLA_ESTADO, nation.n_name AS NO_MUNICIPIO,
       {roles.PLACE.format('place')} AS CO_MUNICIPIO, k.r_name AS DS_TIPO_ESTABELECIMENTO, a.n_name AS DS_ATIVIDADE,
       CASE WHEN a.n_nationkey % 3 > 0 THEN 'de ' || a.n_name END AS DS_CONCEITO_ATIVIDADE, name AS DS_TIPO_UNIDADE, CAST(beds AS BIGINT) AS leitos_existentes, CAST(sus AS BIGINT) AS leitos_sus
FROM facilities f LEFT JOIN nation ON nation.n_nationkey = place LEFT JOIN region ON region.r_regionkey = nation.n_regionkey
LEFT JOIN region k ON k.r_regionkey = f.unit % 7 LEFT JOIN nation a ON a.n_nationkey = f.unit % 30
LEFT JOIN types ON types.unit_type = f.unit_type LEFT JOIN unit_beds b ON b.unit = f.unit WHERE active""",
)
def star_left_join(spark: SparkSession, folder: str) -> DataFrame:
    details = municipal.facility_details(roles.registry(spark, folder), roles.SNAPSHOT)
    return details.select(
        "CO_UNIDADE", "CO_SIGLA_ESTADO", "CO_MUNICIPIO", "NO_MUNICIPIO", "DS_TIPO_UNIDADE", "DS_TIPO_ESTABELECIMENTO", "DS_ATIVIDADE",
        "DS_CONCEITO_ATIVIDADE", "leitos_existentes", "leitos_sus",
    )


@bound(
    "wide_left_joins",
    f"""WITH {roles.PEOPLE_SQL}
SELECT {roles.PLACE.format('n_nationkey')} AS CO_MUNICIPIO, CAST(people.n AS DOUBLE) AS residentes_favela, {_CENSUS}
FROM nation LEFT JOIN people ON people.place = n_nationkey""",
)
def wide_left_joins(spark: SparkSession, folder: str) -> DataFrame:
    source = roles.registry(spark, folder)
    tables = {name: (df, "codigo", config.CENSUS_COLUMNS[name]) for name, df in source.census.items()}
    return joins.wide_left_joins(source.municipalities.select("CO_MUNICIPIO"), "CO_MUNICIPIO", tables)


@bound(
    "inner_chain",
    f"""SELECT lpad(CAST(l_suppkey AS VARCHAR), greatest(7, length(CAST(l_suppkey AS VARCHAR)))::INTEGER, '0') AS codigo_unidade, l_orderkey AS codigo_profissional, s_name AS nome_fantasia,
       upper(p_name) AS atividade_profissional, n_name AS municipio, {roles.PLACE.format('n_nationkey')} AS codigo_municipio, r_name AS uf,
       p_brand AS classificacao_profissional, CASE WHEN p_size % 2 = 0 THEN 'S' END AS cbo_saude, CASE WHEN l_linestatus = 'O' THEN 'S' ELSE 'N' END AS sus
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey AND s_suppkey % 17 <> 0
JOIN part ON p_partkey = l_partkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
)
def inner_chain(spark: SparkSession, folder: str) -> DataFrame:
    source = roles.registry(spark, folder)
    facility_columns = [F.col("NO_FANTASIA").alias("nome_fantasia"), "CO_MUNICIPIO_GESTOR"]
    chained = joins.inner_chain(
        source.workers,
        [
            (source.facilities, "CO_UNIDADE", "CO_UNIDADE", facility_columns),
            (
                source.occupations, "CO_CBO", "CO_CBO",
                [F.col("DS_ATIVIDADE_PROFISSIONAL").alias("atividade_profissional"),
                 F.col("TP_CLASSIFICACAO_PROFISSIONAL").alias("classificacao_profissional"), F.col("TP_CBO_SAUDE").alias("cbo_saude")],
            ),
            (
                source.municipalities, "CO_MUNICIPIO_GESTOR", "CO_MUNICIPIO",
                [F.col("CO_MUNICIPIO").alias("codigo_municipio"), F.col("NO_MUNICIPIO").alias("municipio"), F.col("CO_SIGLA_ESTADO").alias("uf")],
            ),
        ],
    )
    return chained.select(
        F.col("CO_UNIDADE").alias("codigo_unidade"), "nome_fantasia", "codigo_municipio", "municipio", "uf",
        F.col("CO_PROFISSIONAL_SUS").alias("codigo_profissional"), "atividade_profissional", "classificacao_profissional", "cbo_saude",
        F.col("TP_SUS_NAO_SUS").alias("sus"),
    )


@bound(
    "count_distinct_filtered",
    f"""SELECT {roles.PLACE.format('s_nationkey')} AS CO_MUNICIPIO,
  CAST(nullif(count(DISTINCT l_orderkey) FILTER (WHERE p_name ILIKE '{roles.PHYSICIAN}'), 0) AS BIGINT) AS qtd_medicos,
  CAST(nullif(count(DISTINCT l_orderkey) FILTER (WHERE p_name ILIKE '{roles.NURSE}'), 0) AS BIGINT) AS qtd_enfermeiros
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey AND s_suppkey % 17 <> 0 JOIN part ON p_partkey = l_partkey
WHERE p_name ILIKE '{roles.PHYSICIAN}' OR p_name ILIKE '{roles.NURSE}' GROUP BY s_nationkey""",
)
def count_distinct_filtered(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("DS_ATIVIDADE_PROFISSIONAL")
    flags = {"qtd_medicos": text.ilike(roles.PHYSICIAN), "qtd_enfermeiros": text.ilike(roles.NURSE)}
    return municipal.professionals(roles.registry(spark, folder), flags)


@bound(
    "join_try_cast",
    f"""WITH {roles.FACILITIES_SQL},
deaths AS (SELECT o_custkey AS unit, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey
           WHERE o_orderstatus <> 'P' GROUP BY o_custkey)
SELECT CAST(f.unit AS VARCHAR) AS CO_CNES, CAST(n AS BIGINT) AS qtd_obitos FROM facilities f LEFT JOIN deaths ON deaths.unit = f.unit""",
)
def join_try_cast(spark: SparkSession, folder: str) -> DataFrame:
    counts = agg.grouped_count(roles.deaths(spark, folder), ["CODESTAB"], "qtd_obitos")
    units = roles.facilities(spark, folder).select("CO_CNES")
    return joins.join_on_parsed_key(units, "CO_CNES", counts, "CODESTAB", ["qtd_obitos"])


@bound(
    "deaths_by_municipality",
    f"""SELECT {roles.PLACE.format('c_nationkey')} AS CODMUNOCOR, CAST(count(*) AS BIGINT) AS total_obitos
FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_nationkey IN (SELECT n_nationkey FROM nation) GROUP BY c_nationkey""",
)
def deaths_by_municipality(spark: SparkSession, folder: str) -> DataFrame:
    known = roles.municipalities(spark, folder)
    return agg.count_known(roles.deaths(spark, folder), "CODMUNOCOR", known, "CO_MUNICIPIO", "total_obitos")


@bound(
    "agg_count",
    f"""WITH {roles.FACILITIES_SQL}
SELECT coalesce({roles.PLACE.format('place')}, '999999') AS CO_MUNICIPIO_GESTOR, CAST(count(*) AS BIGINT) AS quantidade_unidades
FROM facilities GROUP BY place""",
)
def agg_count(spark: SparkSession, folder: str) -> DataFrame:
    return agg.grouped_count(roles.facilities(spark, folder), ["CO_MUNICIPIO_GESTOR"], "quantidade_unidades")


@bound(
    "count_positive",
    f"""WITH {roles.FACILITIES_SQL}, {roles.BEDS_SQL},
unit_beds AS (SELECT unit, sum(n) AS beds FROM beds WHERE snapshot = '{roles.SNAPSHOT}' GROUP BY unit)
SELECT {roles.PLACE.format('place')} AS CO_MUNICIPIO, CAST(count(*) AS BIGINT) AS quantidade_unidades_com_leito
FROM facilities f JOIN unit_beds b ON b.unit = f.unit WHERE active AND beds > 0 GROUP BY place""",
)
def count_positive(spark: SparkSession, folder: str) -> DataFrame:
    details = municipal.facility_details(roles.registry(spark, folder), roles.SNAPSHOT)
    return agg.grouped_count(details, ["CO_MUNICIPIO"], "quantidade_unidades_com_leito", F.col("leitos_existentes") > 0)


@bound(
    "pivot_fixed",
    f"""WITH {roles.FACILITIES_SQL},
care AS (SELECT place, {_TYPE_COUNTS} FROM facilities WHERE active GROUP BY place)
SELECT {roles.PLACE.format('place')} AS CO_MUNICIPIO, n_name AS NO_MUNICIPIO, {_TYPE_COLUMNS}
FROM care LEFT JOIN nation ON n_nationkey = place""",
)
def pivot_fixed(spark: SparkSession, folder: str) -> DataFrame:
    details = municipal.facility_details(roles.registry(spark, folder), roles.SNAPSHOT)
    return agg.pivot_fixed(details, ["CO_MUNICIPIO", "NO_MUNICIPIO"], "DS_TIPO_UNIDADE")
