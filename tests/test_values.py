import pytest
from pyspark.sql import functions as F

from munimetrics import config
from munimetrics.functions import scalars, text
from munimetrics.plans.ingest import clean_deaths


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "raw, wanted",
    [
        ("  até 42 dias pós-parto ", "Até 42 Dias Pós-Parto"),
        ("Separado/divorciado", "Separado/Divorciado"),
        ("x1y d'ÁGUA\nnova", "X1y D'Água\nNova"),
        ("ßa ssb", "SSa Ssb"),
        ("", ""),
        (None, None),
    ],
)
def test_title_case(spark, raw, wanted):
    assert one(spark, text.title_case(F.lit(raw).cast("string"))) == wanted


@pytest.mark.parametrize(
    "raw, wanted",
    [("<b>Área</b> (km²) - Total", "area_km2_total"), ("__Ação--½ ﬁm__", "acao_12_fim"), ("…", ""), (None, None)],
)
def test_clean_label(spark, raw, wanted):
    assert one(spark, text.clean_label(F.lit(raw).cast("string"))) == wanted
    if raw is not None and wanted:
        assert text.clean_columns(spark.range(1).select(F.lit(1).alias(raw))).columns == [wanted]


@pytest.mark.parametrize("raw, wanted", [("-", 0.0), ("-5", 5.0), ("1.5", 1.5), ("x", None), (None, None)])
def test_dash_numbers(spark, raw, wanted):
    assert one(spark, text.parse_dash_numeric(F.lit(raw).cast("string"), strict=False)) == wanted


def test_deaths_are_decoded_before_title_case(spark):
    codes = {c: None for c in config.MORTALITY_CODES} | {"ESTCIV": "4", "TPMORTEOCO": "4", "LOCOCOR": "2", "SEXO": "9"}
    row = {**codes, "CODMUNOCOR": " 110001 "}
    schema = ", ".join(f"{c} string" for c in row)
    deaths = spark.createDataFrame([tuple(row.values())], schema)
    places = spark.createDataFrame([(110001, "Alta Floresta", "RO")], "CO_MUNICIPIO long, NO_MUNICIPIO string, CO_SIGLA_ESTADO string")
    out = clean_deaths(deaths, places).first()
    assert out["ESTCIV"] == "Separado/Divorciado"
    assert out["TPMORTEOCO"] == "Até 42 Dias Pós-Parto"
    assert out["LOCOCOR"] == "Outros Estabelecimentos De Saúde"
    assert (out["SEXO"], out["RACACOR"]) == ("Desconhecido", "Ignorado")
    assert (out["NO_MUNICIPIO"], out["CODMUNOCOR"]) == ("Alta Floresta", "110001")


def test_ratios_and_occupancy(spark):
    assert one(spark, scalars.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, scalars.per_thousand(F.lit(3), F.lit(1500))) == 2.0
    assert one(spark, scalars.occupancy_rate(F.lit(730), F.lit(4))) == 50.0
    assert one(spark, scalars.occupancy_rate(F.lit(5), F.lit(None).cast("double"))) == 0.0


def test_lookups(spark):
    assert one(spark, scalars.region_of(F.lit("DF"))) == "Centro-Oeste"
    assert one(spark, scalars.region_of(F.lit(None).cast("string"))) == "Região Desconhecida"
    assert one(spark, scalars.is_capital(F.lit("Recife"), F.lit("PE"))) is True
    assert one(spark, scalars.is_capital(F.lit("Recife"), F.lit("XX"))) is False
    assert one(spark, scalars.remap_codes(F.lit("530170"), config.DISTRICT_CODES, "530010")) == "530010"
    assert one(spark, scalars.remap_codes(F.lit(None).cast("string"), config.DISTRICT_CODES, "530010")) is None


def test_fill_and_round(spark):
    df = spark.createDataFrame([(None, None, 0.125)], "n int, s string, x double")
    assert tuple(scalars.fill_all(df).first()) == (0, "0", 0.125)
    assert scalars.round_doubles(df, 2).first()["x"] == 0.12
    assert df.select(scalars.row_sum(["n", "x"]).alias("v")).first()["v"] == 0.125
