"""Dashboard queries: filters, key figures, state table, ranking."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from munimetrics import config
from munimetrics.functions.scalars import round_doubles
from munimetrics.functions.text import concat_label
from munimetrics.operators.ordering import ranked


def dashboard_rows(df: DataFrame) -> DataFrame:
    """Clustered municipalities as shown: ``uf - nome`` label, text code, two decimals."""
    labelled = df.withColumn("uf_nome", concat_label(F.col("uf"), F.col("nome")))
    return round_doubles(labelled.withColumn("codigo_municipio", F.col("codigo_municipio").cast("string")), 2)


def dashboard_filter(
    df: DataFrame, cluster: int | None = None, state: str | None = None, municipality: str | None = None
) -> DataFrame:
    """Rows of a cluster, a state, a municipality; None means all."""
    for column, wanted in (("cluster", cluster), ("uf", state), ("nome", municipality)):
        if wanted is not None:
            df = df.where(F.col(column) == F.lit(wanted))
    return df


def indicator_view(df: DataFrame, labels: Mapping[str, str] = config.DASHBOARD_INDICATORS) -> DataFrame:
    """The indicators shown for a municipality, under their display names."""
    shown = [F.col(f"`{c}`").alias(label) for c, label in labels.items() if c in df.columns]
    return df.select("uf_nome", *shown)


def key_figures(df: DataFrame) -> DataFrame:
    """Municipalities, states, population and mean index in one row."""
    per_state = df.groupBy("uf").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("populacao").alias("populacao"),
        F.sum("idh").alias("idh"),
        F.count("idh").alias("n_idh"),
    )
    return per_state.agg(
        F.sum("n").alias("total_municipios"),
        F.count("uf").alias("total_estados"),
        F.sum("populacao").alias("populacao_total"),
        F.try_divide(F.sum("idh"), F.sum("n_idh")).alias("idh_medio"),
    )


def state_table(df: DataFrame, rows: int = 5, alphabetical: bool = False) -> DataFrame:
    """Municipalities and population of the states with most municipalities.

    ``alphabetical=True`` takes the first states by name and sorts those by size afterwards.
    """
    municipalities = df.where(F.col("uf").isNotNull()).groupBy("uf", "codigo_municipio")
    states = (
        municipalities.agg(F.sum("populacao").alias("populacao"))
        .groupBy("uf")
        .agg(F.count("codigo_municipio").alias("n_municipios"), F.sum("populacao").alias("populacao"))
    )
    by_size = [F.desc("n_municipios"), F.asc("uf")]
    if alphabetical:
        return states.orderBy("uf").limit(rows).orderBy(*by_size)
    return states.orderBy(*by_size).limit(rows)


def capacity_ranking(df: DataFrame, measure: str, by: str = "uf", name: str = "posicao") -> DataFrame:
    """Rank of each municipality within its state by a capacity measure, largest first."""
    return ranked(df, [by], measure, name)
