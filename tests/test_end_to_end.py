"""Raw monthly files to the municipal table."""

from munimetrics import config
from munimetrics.plans import ingest
from munimetrics.plans.municipal import municipal_table, registry_of


def _csv(path, header, *rows):
    path.write_bytes("\n".join([header, *rows, ""]).encode("latin-1"))


def test_files_to_municipal_table(spark, tmp_path):
    raw, sim, ibge, sheets = (tmp_path / n for n in ("raw", "sim", "ibge", "cidades"))
    for folder in (raw, sim, ibge, sheets):
        folder.mkdir()
    columns = [c for c in config.FACILITY_COLUMNS if c != "data_competencia"]

    def facility(**known):
        return ";".join(f'"{known.get(c, "")}"' for c in columns)

    for month in ("202211", "202212"):
        _csv(
            raw / f"tbEstabelecimento{month}.csv", ";".join(columns),
            facility(CO_UNIDADE="0001", CO_CNES="0011", CO_MUNICIPIO_GESTOR="530170", TP_UNIDADE="05"),
            facility(CO_UNIDADE="0002", CO_CNES="0012", CO_MUNICIPIO_GESTOR="530010", TP_UNIDADE="39",
                     CO_MOTIVO_DESAB="" if month == "202211" else "03"),
        )
        _csv(raw / f"tbMunicipio{month}.csv", "CO_MUNICIPIO;NO_MUNICIPIO;CO_SIGLA_ESTADO", '530010;"BRASÍLIA";DF')
        _csv(raw / f"tbTipoUnidade{month}.csv", "CO_TIPO_UNIDADE;DS_TIPO_UNIDADE", "05;HOSPITAL GERAL", "39;TELESSAUDE")
        _csv(raw / f"rlEstabComplementar{month}.csv", "CO_UNIDADE;CO_TIPO_LEITO;QT_EXIST;QT_SUS", "0001;1;7;3", "0002;1;9;9")
        _csv(raw / f"tbAtividadeProfissional{month}.csv", "CO_CBO;DS_ATIVIDADE_PROFISSIONAL", "225;MEDICO", "223;ENFERMEIRO")
    _csv(raw / "tbCargaHorariaSus202212.csv", "CO_UNIDADE;CO_PROFISSIONAL_SUS;CO_CBO;TP_SUS_NAO_SUS", "0001;a;225;S", "0002;a;225;S", "0001;b;223;S")
    _csv(sim / "DOBR2022.csv", "CODESTAB;CODMUNOCOR;SEXO", "11;530010;1", "0011;530010;2", ";530010;9")
    _csv(ibge / "taxa_rede_esgoto.csv", "codigo;sim;nao", "5300108;88.5;11.5")
    (sheets / "df.csv").write_text("Cidades e Estados\nMunicípio [-],Código [-]\nBrasília, 5300108.0 ,g,p,10,2000,200,90,0.8,-,1,2,3\n")

    tables = ingest.ingest_registry(spark, str(raw), str(tmp_path / "tables"))
    month = tables["rlestabcomplementar"].where("data_competencia = '2022-12-01'")
    assert "PartitionFilters: [isnotnull(data_competencia" in month._jdf.queryExecution().executedPlan().toString()
    assert tables["tbestabelecimento"].count() == 2 and tables["tbmunicipio"].count() == 1
    deaths = ingest.ingest_deaths(spark, str(sim / "DOBR2022.csv"), tables["tbmunicipio"], str(tmp_path / "deaths"))
    assert {r["SEXO"] for r in deaths.collect()} == {"Masculino", "Feminino", "Desconhecido"}
    cities = ingest.ingest_cities(spark, str(sheets), str(tmp_path / "cities"))
    census = ingest.ingest_census(spark, str(ibge), str(tmp_path / "census"))
    rows = municipal_table(registry_of(tables, deaths, cities, census), check_keys=True).collect()
    assert len(rows) == 1
    row = rows[0].asDict()
    assert (row["codigo_municipio"], row["uf"], row["qtd_unidades"]) == ("530010", "DF", 1)
    assert (row["leitos_existentes"], row["leitos_sus"], row["hab_por_unidade"]) == (7, 3, 1000.0)
    assert (row["obitos_em_estabelecimentos"], row["total_obitos"], row["taxa_mortalidade_geral"]) == (2, 3, 1.5)
    assert (row["habitantes_por_medico"], row["habitantes_por_enfermeiros"]) == (2000.0, 2000.0)
    assert (row["pct_com_rede_esgoto"], row["HOSPITAL GERAL"], row["TELESSAUDE"]) == (88.5, 1, None)
