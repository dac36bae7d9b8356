"""Cluster analysis of the municipal table, from features to written reports."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from munimetrics import config
from munimetrics.functions.scalars import (
    fill_all, fill_columns, feature_subset, is_capital, occupancy_rate, present, region_of, row_sum,
)
from munimetrics.functions.text import lower_columns
from munimetrics.operators import clustering, features as prep, stats
from munimetrics.operators.assignment import best_label_pairs
from munimetrics.operators.hierarchy import hierarchy_clusters
from munimetrics.operators.layout import neighbour_layout
from munimetrics.operators.silhouette import euclidean_silhouette, feature_rows
from munimetrics.operators.aggregates import crosstab
from munimetrics.operators.joins import check_unique, join_admissions
from munimetrics.session import cut_lineage
from munimetrics.sources.tables import run_metadata, write_csv, write_metadata


@dataclass
class Settings:
    min_cluster_size: int = 75
    min_samples: int = 29
    noise_cluster_size: int = 21
    noise_samples: int = 20
    n_clusters_alt: int = 5
    restarts: int = 20
    seed: int = 42
    var_threshold: float = 0.05
    corr_threshold: float = 0.90
    #: Clusters of all densities by stability; without it those of one density level.
    hierarchy: bool = True
    #: Positions by a neighbour layout; without it by principal components.
    layout: bool = False


def prepare(municipal: DataFrame, admissions: DataFrame) -> DataFrame:
    """Municipal table and admissions to one frame with derived columns, rates and care-level indexes."""
    df = fill_all(municipal.drop("NO_MUNICIPIO", "CO_MUNICIPIO"))
    if {"total_obitos", "obitos_em_estabelecimentos"} <= set(df.columns):
        df = df.withColumn("obitos_fora_estabelecimento", F.col("total_obitos") - F.col("obitos_em_estabelecimentos"))
    df = lower_columns(df)
    if {"uf", "nome"} <= set(df.columns):
        df = df.withColumn("regiao", region_of(F.col("uf"))).withColumn("capital", is_capital(F.col("nome"), F.col("uf")))
    df = join_admissions(df, admissions)
    df = df.withColumn("taxa_ocupacao_anual", occupancy_rate(F.col("total_dias_permanencia"), F.col("leitos_existentes")))
    df = fill_columns(df, config.ADMISSION_COLUMNS)
    indexes = {name: row_sum(present(df, parts)) for name, parts in config.CARE_INDEXES.items() if present(df, parts)}
    return df.withColumns(indexes)


def analyse(
    municipal: DataFrame, admissions: DataFrame, outdir: str, settings: Settings | None = None, key: str = "codigo_municipio"
) -> dict[str, DataFrame]:
    """Run the whole analysis, write every report below ``outdir`` and return the frames by report name."""
    settings = settings or Settings()
    # Labels come back by key, so a repeated key would multiply rows.
    base = check_unique(cut_lineage(prepare(municipal, admissions)), key, "municipal table")
    features = present(base, config.HEALTH_FEATURES)
    scaled = cut_lineage(prep.standardize(base.select(key, *[F.col(f"`{c}`") for c in features]), features))

    projected = cut_lineage(neighbour_layout(scaled, key, features, seed=settings.seed) if settings.layout else prep.project(scaled, features))
    cluster = hierarchy_clusters if settings.hierarchy else clustering.density_clusters
    first = cut_lineage(cluster(projected, key, "umap_x", "umap_y", settings.min_samples, settings.min_cluster_size))
    labelled = clustering.recluster_noise(
        first, key, features, settings.noise_samples, settings.noise_cluster_size, cluster=hierarchy_clusters if settings.hierarchy else None
    )
    labels = cut_lineage(labelled.select(key, "cluster", "umap_x", "umap_y"))
    clustered = base.join(labels, key)

    profile = stats.cluster_profile(clustered, features)
    reports = {
        "perfil_clusters_media": stats.profile_table(profile, "mean", features),
        "perfil_clusters_mediana": stats.profile_table(profile, "median", features),
        "perfil_clusters_desvio": stats.profile_table(profile, "std", features),
        "boxplots": stats.box_stats(clustered, features),
        "kruskal_clusters": stats.kruskal_wallis(clustered, features),
    }

    varied = prep.variance_filter(scaled, features, settings.var_threshold)
    selected, dropped = prep.correlation_filter(scaled, varied, settings.corr_threshold)
    scores, mappings = {}, {}
    alternatives = {
        "kmeans": clustering.kmeans_best_of(scaled, key, selected, settings.n_clusters_alt, settings.restarts, settings.seed),
        "agglomerative": clustering.hierarchical_clusters(scaled, key, selected, settings.n_clusters_alt),
    }
    for name, alternative in alternatives.items():
        alternative = cut_lineage(alternative)
        paired = cut_lineage(labels.select(key, "cluster").join(alternative, key))
        score = euclidean_silhouette(feature_rows(scaled.join(alternative, key), selected, "label"))
        scores[name] = score and score["mean"]
        pairs = cut_lineage(best_label_pairs(paired, "cluster", "label"))
        mappings[name] = {row["label"]: row["cluster"] for row in pairs.orderBy("label").collect()}
        aligned = clustering.align_labels(paired, "cluster", "label", pairs=pairs)
        reports[f"matriz_correspondencia_{name}"] = crosstab(paired, "cluster", "label")
        reports[f"matriz_correspondencia_{name}_alinhada"] = crosstab(aligned, "cluster", "aligned")

    reports["municipios_clusterizados"] = feature_subset(
        clustered, config.LABEL_COLUMNS, [*features, "cluster", "umap_x", "umap_y"]
    )
    meta = {
        "density": {"min_cluster_size": settings.min_cluster_size, "min_samples": settings.min_samples},
        "alt": {
            "n_clusters": settings.n_clusters_alt,
            "var_threshold": settings.var_threshold,
            "corr_threshold": settings.corr_threshold,
            "features_pos_var": varied,
            "features_pos_corr": selected,
            "features_removidas_por_corr": dropped,
            "silhouette_kmeans": scores["kmeans"],
            "silhouette_agglomerative": scores["agglomerative"],
            "mapping_kmeans": {str(k): v for k, v in mappings["kmeans"].items()},
            "mapping_agglomerative": {str(k): v for k, v in mappings["agglomerative"].items()},
        },
    }
    for name, report in reports.items():
        write_csv(report, os.path.join(outdir, name))
    metadata = run_metadata(base.sparkSession, meta)
    write_metadata(metadata, os.path.join(outdir, "metadados"))
    # The dashboard reads Parquet, so the clustered table is written in that form as well.
    reports["municipios_clusterizados"].write.mode("overwrite").parquet(os.path.join(outdir, "municipios_clusterizados_parquet"))
    reports["metadados"] = metadata
    return reports
