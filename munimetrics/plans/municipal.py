"""The municipal table: one wide row of indicators per municipality."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from munimetrics import config
from munimetrics.functions.scalars import per_thousand, ratio
from munimetrics.operators.aggregates import count_known, distinct_by_flags, grouped_count, pivot_columns
from munimetrics.operators.joins import check_unique, lookup, star_join, wide_left_joins
from munimetrics.operators.ordering import null_safe_join


@dataclass
class Registry:
    """Input tables, named after what they hold; columns as in the public registries."""

    facilities: DataFrame
    beds: DataFrame
    deaths: DataFrame
    municipalities: DataFrame
    unit_types: DataFrame
    workers: DataFrame
    occupations: DataFrame
    cities: DataFrame
    census: Mapping[str, DataFrame] = field(default_factory=dict)
    facility_types: DataFrame | None = None
    activities: DataFrame | None = None


def active(facilities: DataFrame, null_is_active: bool = False) -> DataFrame:
    """Facilities without a reason of deactivation. An empty reason means active, a missing one does not,
    unless the source lost the difference and ``null_is_active`` says so."""
    reason = F.col("CO_MOTIVO_DESAB")
    condition = reason == ""
    return facilities.where(condition | reason.isNull() if null_is_active else condition)


def active_count(facilities: DataFrame, null_is_active: bool = False) -> DataFrame:
    """Number of distinct active facilities, in one row."""
    return active(facilities, null_is_active).agg(F.count_distinct("CO_CNES").alias("estabelecimentos_ativos"))


def registry_of(
    tables: Mapping[str, DataFrame], deaths: DataFrame, cities: DataFrame, census: Mapping[str, DataFrame]
) -> Registry:
    """A registry from ingested tables under their usual names."""
    return Registry(
        facilities=tables["tbestabelecimento"],
        beds=tables["rlestabcomplementar"],
        deaths=deaths,
        municipalities=tables["tbmunicipio"],
        unit_types=tables["tbtipounidade"],
        workers=tables["tbcargahorariasus"],
        occupations=tables["tbatividadeprofissional"],
        cities=cities,
        census=census,
        facility_types=tables.get("tbtipoestabelecimento"),
        activities=tables.get("tbatividade"),
    )


def beds_per_facility(beds: DataFrame, facilities: DataFrame | None, snapshot: str) -> DataFrame:
    """Existing and public beds per facility in one snapshot; ``facilities`` limits which ones count."""
    rows = beds.where(F.col("data_competencia") == snapshot)

    def count(name: str) -> Column:
        # Counts are text when they come from CSV; a blank is no count, any other text that is no number is an error.
        return F.nullif(F.trim(F.col(name).cast("string")), F.lit("")).cast("bigint")

    sums = rows.groupBy("CO_UNIDADE").agg(
        F.sum(count("QT_EXIST")).alias("leitos_existentes"), F.sum(count("QT_SUS")).alias("leitos_sus")
    )
    return sums if facilities is None else sums.join(facilities.select("CO_UNIDADE"), "CO_UNIDADE", "left_semi")


def facility_details(registry: Registry, snapshot: str, null_is_active: bool = False) -> DataFrame:
    """Active facilities with their dictionary texts and beds."""
    steps = [
        (registry.municipalities, "CO_MUNICIPIO_GESTOR", "CO_MUNICIPIO", ["CO_SIGLA_ESTADO", "CO_MUNICIPIO", "NO_MUNICIPIO"]),
        (registry.unit_types, "TP_UNIDADE", "CO_TIPO_UNIDADE", ["DS_TIPO_UNIDADE"]),
    ]
    if registry.facility_types is not None:
        steps.append(
            (registry.facility_types, "CO_TIPO_ESTABELECIMENTO", "CO_TIPO_ESTABELECIMENTO", ["DS_TIPO_ESTABELECIMENTO"])
        )
    if registry.activities is not None:
        steps.append(
            (registry.activities, "CO_ATIVIDADE_PRINCIPAL", "CO_ATIVIDADE", ["DS_ATIVIDADE", "DS_CONCEITO_ATIVIDADE"])
        )
    # Beds of inactive facilities find no row on the left, so they need no filter of their own.
    beds = beds_per_facility(registry.beds, None, snapshot)
    return star_join(active(registry.facilities, null_is_active), steps).join(beds, "CO_UNIDADE", "left")


def deaths_per_facility(deaths: DataFrame) -> DataFrame:
    """Deaths by numeric facility code; codes that are no numbers belong to no facility.

    Counted by the parsed code, so that one facility written in two ways is still one row.
    """
    code = F.trim("CODESTAB").try_cast("bigint")
    return grouped_count(deaths.select(code.alias("_cnes")).where(F.col("_cnes").isNotNull()), ["_cnes"], "qtd_obitos")


def professionals(registry: Registry, flags: Mapping[str, Column]) -> DataFrame:
    """Distinct workers per municipality for each condition on the occupation text.

    Occupations that meet no condition are dropped before the join with the workers.
    """
    wanted = [F.coalesce(condition, F.lit(False)).alias(name) for name, condition in flags.items()]
    occupations = registry.occupations.select("CO_CBO", *wanted)
    occupations = occupations.where(F.greatest(*[F.col(n).cast("int") for n in flags]) == 1)
    places = lookup(
        registry.facilities.select("CO_UNIDADE", "CO_MUNICIPIO_GESTOR"),
        registry.municipalities, "CO_MUNICIPIO_GESTOR", "CO_MUNICIPIO", ["CO_MUNICIPIO"], "inner",
    )
    workers = registry.workers.select("CO_UNIDADE", "CO_PROFISSIONAL_SUS", "CO_CBO")
    working = lookup(workers, occupations, "CO_CBO", "CO_CBO", list(flags), "inner")
    placed = lookup(working, places, "CO_UNIDADE", "CO_UNIDADE", ["CO_MUNICIPIO"], "inner")
    return distinct_by_flags(placed, "CO_MUNICIPIO", "CO_PROFISSIONAL_SUS", {n: F.col(n) for n in flags})


def municipal_table(
    registry: Registry,
    snapshot: str = "2022-12-01",
    physician: str = "%medic%",
    nurse: str = "%enfermei%",
    facility_types: list[str] | None = None,
    null_is_active: bool = False,
    drop_null_key: bool = False,
    check_keys: bool = False,
) -> DataFrame:
    """50 indicators and one count per facility type for each municipality that has an active facility.

    Facilities are brought to one row per municipality first; the city, census and staff tables, which
    already have one row per municipality, are joined to that. Facilities without a known municipality
    are kept in a row without a code unless ``drop_null_key``. ``check_keys`` verifies that no joined
    table repeats a municipality, which would multiply sums.
    """
    types = config.FACILITY_TYPES if facility_types is None else facility_types
    if check_keys:
        check_unique(registry.municipalities, "CO_MUNICIPIO", "municipalities")
        check_unique(registry.cities, "codigo_municipio", "cities")
        for name, table in registry.census.items():
            check_unique(table, "codigo", name)

    details = facility_details(registry, snapshot, null_is_active)
    details = details.withColumn("_cnes", F.col("CO_CNES").try_cast("bigint"))
    details = details.join(deaths_per_facility(registry.deaths), "_cnes", "left")
    # One row per municipality and facility, then one per municipality: the distinct count of facilities
    # needs no second copy of the rows.
    per_facility = details.groupBy("CO_MUNICIPIO", "CO_UNIDADE").agg(
        F.sum("leitos_existentes").alias("leitos_existentes"),
        F.sum("leitos_sus").alias("leitos_sus"),
        F.sum("qtd_obitos").alias("obitos_em_estabelecimentos"),
        F.sum(F.when(F.col("leitos_existentes") > 0, 1)).alias("quantidade_unidades_com_leito"),
        *pivot_columns(F.col("DS_TIPO_UNIDADE"), F.lit(1), types),
    )
    sums = ["leitos_existentes", "leitos_sus", "obitos_em_estabelecimentos", "quantidade_unidades_com_leito", *types]
    per_municipality = per_facility.groupBy("CO_MUNICIPIO").agg(
        F.count("CO_UNIDADE").alias("qtd_unidades"), *[F.sum(f"`{c}`").alias(c) for c in sums]
    )

    everywhere = grouped_count(
        registry.facilities.select(F.col("CO_MUNICIPIO_GESTOR").cast("string").alias("_place")), ["_place"], "quantidade_unidades"
    )
    cities = registry.cities.join(everywhere, F.col("codigo_municipio") == F.col("_place")).drop("_place")
    deaths = count_known(
        registry.deaths, "CODMUNOCOR", registry.municipalities, "CO_MUNICIPIO", "total_obitos"
    )
    staff = professionals(
        registry,
        {
            "qtd_medicos": F.col("DS_ATIVIDADE_PROFISSIONAL").ilike(physician),
            "qtd_enfermeiros": F.col("DS_ATIVIDADE_PROFISSIONAL").ilike(nurse),
        },
    )
    joined = (
        per_municipality.withColumn("CO_MUNICIPIO", F.col("CO_MUNICIPIO").cast("string"))
        .join(cities, F.col("CO_MUNICIPIO") == F.col("codigo_municipio"), "left")
        .join(deaths.select(F.col("CODMUNOCOR").cast("string").alias("CO_MUNICIPIO"), "total_obitos"), "CO_MUNICIPIO", "left")
        .join(staff.withColumn("CO_MUNICIPIO", F.col("CO_MUNICIPIO").cast("string")), "CO_MUNICIPIO", "left")
    )
    census = {name: (registry.census[name], "codigo", columns) for name, columns in config.CENSUS_COLUMNS.items() if name in registry.census}
    joined = wide_left_joins(joined, "CO_MUNICIPIO", census)
    missing = [c for columns in config.CENSUS_COLUMNS.values() for c in columns.values() if c not in joined.columns]
    joined = joined.withColumns({c: F.lit(None).cast("double") for c in missing})

    # Rows that agree in everything but the facility sums are one row: municipalities unknown to every
    # other table have nothing to tell them apart.
    with_beds = "quantidade_unidades_com_leito"
    joined = joined.withColumn(with_beds, F.when(F.col("CO_MUNICIPIO").isNotNull(), F.col(with_beds)))
    summed = ["qtd_unidades", *[c for c in sums if c != with_beds]]
    carried = [c for c in joined.columns if c not in {*summed, "CO_MUNICIPIO"}]
    merged = joined.groupBy(*[F.col(f"`{c}`") for c in carried]).agg(*[F.sum(f"`{c}`").alias(c) for c in summed])
    if drop_null_key:
        merged = merged.where(F.col("codigo_municipio").isNotNull())
    people, units = F.col("populacao_residente"), F.col("qtd_unidades")
    indicators = {
        "populacao": people,
        "idh": F.col("idhm"),
        "hab_por_unidade": F.round(ratio(people, F.col("quantidade_unidades")), 2),
        "unidades_por_k_hab": per_thousand(units, people),
        "medicos_por_k_habitante": per_thousand(F.col("qtd_medicos"), people),
        "habitantes_por_medico": ratio(people, F.col("qtd_medicos")),
        "enfermeiros_por_k_habitante": per_thousand(F.col("qtd_enfermeiros"), people),
        "habitantes_por_enfermeiros": ratio(people, F.col("qtd_enfermeiros")),
        "quantidade_unidades_com_leito_por_k_hab": per_thousand(F.col("quantidade_unidades_com_leito"), people),
        "total_leitos_unidade": F.round(ratio(F.col("leitos_existentes"), units), 2),
        "leitos_por_k_hab": per_thousand(F.col("leitos_existentes"), people),
        "total_leitos_sus_unidade": F.round(ratio(F.col("leitos_sus"), units), 2),
        "leitos_sus_por_k_hab": per_thousand(F.col("leitos_sus"), people),
        "obitos_por_unidade": F.round(ratio(F.col("obitos_em_estabelecimentos"), units), 2),
        "taxa_mortalidade_geral": F.round(per_thousand(F.col("total_obitos"), people), 2),
        "area_territorial": F.col("area_km2"),
        "matriculas_ensino_medio": F.col("escolarizacao_6_14"),
        "total_receitas_brutas": F.col("total_receitas_brutas_realizadas"),
        "total_despesas_brutas": F.col("total_despesas_brutas_empenhadas"),
        "taxa_de_nao_alfabetizados": 100 - F.col("taxa_de_alfabetizados"),
        "taxa_pop_residente_favela": ratio(F.col("residentes_favela"), people),
    }
    return merged.withColumns(indicators).select(
        *config.MUNICIPAL_COLUMNS, *[F.col(f"`{t}`") for t in types]
    )


def care_summary(registry: Registry, snapshot: str) -> DataFrame:
    """Facilities and beds per thousand inhabitants of each municipality: the table's smallest useful part."""
    beds = beds_per_facility(registry.beds, None, snapshot)
    facilities = active(registry.facilities).join(beds, "CO_UNIDADE", "left")
    per_place = (
        facilities.groupBy("CO_MUNICIPIO_GESTOR", "CO_UNIDADE")
        .agg(F.sum("leitos_existentes").alias("leitos_existentes"))
        .groupBy(F.col("CO_MUNICIPIO_GESTOR").alias("codigo_municipio"))
        .agg(F.count("CO_UNIDADE").alias("qtd_unidades"), F.sum("leitos_existentes").alias("leitos_existentes"))
    )
    people = registry.cities.select("codigo_municipio", F.col("populacao_residente").alias("populacao"))
    return null_safe_join(per_place, people, ["codigo_municipio"], "left").select(
        "codigo_municipio",
        "qtd_unidades",
        "leitos_existentes",
        F.round(per_thousand(F.col("qtd_unidades"), F.col("populacao")), 6).alias("unidades_por_k_hab"),
        F.round(per_thousand(F.col("leitos_existentes"), F.col("populacao")), 6).alias("leitos_por_k_hab"),
    )
