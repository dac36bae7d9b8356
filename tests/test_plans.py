"""The whole jobs on small hand-made registries."""

import json
import random

import pytest

from munimetrics import config
from munimetrics.plans.analysis import Settings, analyse, prepare
from munimetrics.plans.municipal import Registry, active, municipal_table


@pytest.fixture(scope="module")
def registry(spark):
    def frame(columns, *rows):
        return spark.createDataFrame(list(rows), columns)

    facilities = frame(
        "CO_UNIDADE string, CO_CNES string, CO_MUNICIPIO_GESTOR string, CO_MOTIVO_DESAB string, TP_UNIDADE string",
        ("U1", "1", "110001", "", "05"), ("U2", "2", "110001", "", "99"), ("U3", "3", "110001", "01", "05"),
        ("U4", "4", None, "", "05"), ("U5", "5", "110002", "", None), ("U6", "6", "110001", None, "05"),
    )
    census = {
        "taxa_de_alfabetizacao": frame("codigo string, total double", ("1100015", 90.0)),
        "pop_res_favela": frame("codigo string, total double", ("1100015", 300.0)),
    }
    return Registry(
        facilities=facilities,
        beds=frame(
            "CO_UNIDADE string, QT_EXIST long, QT_SUS long, data_competencia string",
            ("U1", 6, 3, "2022-12-01"), ("U1", 4, 1, "2022-12-01"), ("U1", 99, 99, "2022-11-01"),
            ("U3", 50, 50, "2022-12-01"), ("U7", 8, 8, "2022-12-01"),
        ),
        deaths=frame(
            "CODESTAB string, CODMUNOCOR string",
            ("1", "110001"), (" 0001", "110001"), ("X", "110001"), ("3", "999999"), (None, "110002"),
        ),
        municipalities=frame(
            "CO_MUNICIPIO long, NO_MUNICIPIO string, CO_SIGLA_ESTADO string", (110001, "Alta", "RO"), (110002, "Beta", "RO")
        ),
        unit_types=frame("CO_TIPO_UNIDADE string, DS_TIPO_UNIDADE string", ("05", "HOSPITAL GERAL"), ("99", "OUTRO")),
        workers=frame(
            "CO_UNIDADE string, CO_PROFISSIONAL_SUS string, CO_CBO string, TP_SUS_NAO_SUS string",
            ("U1", "w1", "c1", "S"), ("U2", "w1", "c1", "S"), ("U1", "w2", "c2", "N"), ("U3", "w3", "c1", "S"),
            ("U1", "w4", "c3", "S"), ("U1", "w5", "c4", "S"), ("U4", "w6", "c1", "S"),
        ),
        occupations=frame(
            "CO_CBO string, DS_ATIVIDADE_PROFISSIONAL string",
            ("c1", "MEDICO CLINICO"), ("c2", "Biomedico"), ("c3", "ENFERMEIRO"), ("c4", None),
        ),
        cities=frame(
            ", ".join(f"{c} {'string' if c in ('nome', 'codigo_municipio', 'uf') else 'double'}" for c in config.CITY_TABLE_COLUMNS),
            ("Alta", "110001", 10.0, 3000.0, 300.0, 95.0, 0.7, 12.0, 1.0, 2.0, 3.0, "RO"),
        ),
        census=census,
    )


def test_municipal_table_by_hand(spark, registry):
    rows = {r["codigo_municipio"]: r.asDict() for r in municipal_table(registry, check_keys=True).collect()}
    alta = rows["110001"]
    wanted = {
        "uf": "RO", "populacao": 3000.0, "qtd_unidades": 2, "hab_por_unidade": 750.0, "unidades_por_k_hab": 2 / 3000 * 1000,
        "medicos_por_k_habitante": 1.0, "habitantes_por_medico": 1000.0, "habitantes_por_enfermeiros": 3000.0,
        "leitos_existentes": 10, "leitos_sus": 4, "quantidade_unidades_com_leito": 1, "total_leitos_unidade": 5.0,
        "leitos_por_k_hab": 10 / 3000 * 1000, "obitos_em_estabelecimentos": 2, "obitos_por_unidade": 1.0, "total_obitos": 3,
        "taxa_mortalidade_geral": 1.0, "taxa_de_nao_alfabetizados": 10.0, "taxa_pop_residente_favela": 0.1,
        "pct_idoso": None, "HOSPITAL GERAL": 1, "POLICLINICA": None,
    }
    for column, value in wanted.items():
        assert alta[column] == pytest.approx(value) if isinstance(value, float) else alta[column] == value, column
    assert list(alta) == config.MUNICIPAL_COLUMNS + config.FACILITY_TYPES
    assert set(rows) == {"110001", None}
    named = municipal_table(registry, drop_null_key=True)
    assert [r["codigo_municipio"] for r in named.collect()] == ["110001"]


def test_missing_reason_counts_as_active_only_on_request(registry):
    assert active(registry.facilities).count() == 4
    assert active(registry.facilities, null_is_active=True).count() == 5


@pytest.fixture(scope="module")
def country(spark):
    """Three kinds of municipality and some odd ones."""
    rng = random.Random(5)
    doubles = [c for c in config.MUNICIPAL_COLUMNS if c not in ("uf", "codigo_municipio", "nome")]
    columns = ["uf", "codigo_municipio", "nome", *doubles, *config.FACILITY_TYPES]
    rows, admissions = [], []
    for i in range(240):
        kind = i % 4
        scale = rng.uniform(0, 40) if kind == 3 else 5.0 + 10 * kind
        values = [rng.gauss(scale, 0.5) for _ in doubles]
        counts = [None if rng.random() < 0.1 else float(int(scale) + rng.randrange(3)) for _ in config.FACILITY_TYPES]
        rows.append(("PE", f"{260000 + i}", "Recife" if i == 0 else f"M{i}", *values, *counts))
        if i % 5:
            admissions.append((f"{260000 + i}", *[rng.gauss(scale, 1) for _ in config.ADMISSION_COLUMNS]))
    schema = ", ".join(f"`{c}` {'string' if j < 3 else 'double'}" for j, c in enumerate(columns))
    extra = "codigo_municipio string, " + ", ".join(f"{c} double" for c in config.ADMISSION_COLUMNS)
    return spark.createDataFrame(rows, schema), spark.createDataFrame(admissions, extra)


def test_prepare(country):
    out = prepare(*country)
    first = out.where("codigo_municipio = '260000'").first()
    assert first["regiao"] == "Nordeste" and first["capital"] is True
    assert first["taxa_ocupacao_anual"] == 0.0 and first["total_diarias"] == 0.0
    parts = config.CARE_INDEXES["indice_complexidade"]
    assert first["indice_complexidade"] == pytest.approx(sum(first[c] for c in parts))
    assert "hospital/dia_-_isolado" in out.columns


def test_analysis_writes_all_reports(spark, country, tmp_path):
    settings = Settings(min_cluster_size=20, min_samples=8, noise_cluster_size=10, noise_samples=4, n_clusters_alt=3, restarts=2)
    reports = analyse(*country, str(tmp_path), settings)
    meta = json.loads(spark.read.text(str(tmp_path / "metadados")).first()[0])["alt"]
    assert set(meta["features_pos_corr"]) | set(meta["features_removidas_por_corr"]) == set(meta["features_pos_var"])
    assert meta["silhouette_kmeans"] is not None
    mapping = meta["mapping_kmeans"]
    assert len(set(mapping.values())) == len(mapping)
    stored = spark.read.parquet(str(tmp_path / "municipios_clusterizados_parquet"))
    assert stored.count() == 240 and {"cluster", "umap_x", "umap_y"} <= set(stored.columns)
    clusters = {r["cluster"] for r in stored.select("cluster").distinct().collect()}
    assert len(clusters - {-1}) >= 2
    table = reports["perfil_clusters_media"]
    assert {r["cluster"] for r in table.collect()} == clusters
    for name in reports:
        assert (tmp_path / name).exists()
