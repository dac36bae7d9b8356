"""Code tables, category lists and column lists of the municipal health data model.

Everything in this module is data that has to be spelled exactly as the public registries spell it.
"""

from __future__ import annotations

# Mortality code tables, code -> label, with the label used for any other code or null.
MORTALITY_CODES: dict[str, tuple[dict[str, str], str]] = {
    "SEXO": ({"0": "Ignorado", "1": "Masculino", "2": "Feminino"}, "Desconhecido"),
    "RACACOR": ({"1": "Branca", "2": "Preta", "3": "Amarela", "4": "Parda", "5": "Indígena"}, "Ignorado"),
    "ESTCIV": (
        {"1": "Solteiro", "2": "Casado", "3": "Viúvo", "4": "Separado/Divorciado", "5": "União estável"},
        "Ignorado",
    ),
    "ESC2010": (
        {
            "0": "Sem escolaridade",
            "1": "Fundamental I",
            "2": "Fundamental II",
            "3": "Médio",
            "4": "Superior incompleto",
            "5": "Superior completo",
        },
        "Ignorado",
    ),
    "LOCOCOR": (
        {
            "1": "Hospital",
            "2": "Outros estabelecimentos de saúde",
            "3": "Domicílio",
            "4": "Via pública",
            "5": "Outros",
            "6": "Aldeia indígena",
        },
        "Ignorado",
    ),
    "GRAVIDEZ": ({"1": "Única", "2": "Dupla", "3": "Tripla ou mais"}, "Ignorado"),
    "PARTO": ({"1": "Vaginal", "2": "Cesáreo"}, "Ignorado"),
    "OBITOPARTO": ({"1": "Antes", "2": "Durante", "3": "Depois"}, "Ignorado"),
    "TPMORTEOCO": (
        {
            "1": "Gravidez",
            "2": "Parto",
            "3": "Abortamento",
            "4": "Até 42 dias pós-parto",
            "5": "43 dias a 1 ano pós-parto",
            "8": "Não ocorreu neste período",
        },
        "Ignorado",
    ),
    "CIRCOBITO": ({"1": "Acidente", "2": "Suicídio", "3": "Homicídio", "4": "Outros"}, "Ignorado"),
    "ACIDTRAB": ({"1": "Sim", "2": "Não"}, "Ignorado"),
    "FONTE": ({"1": "Ocorrência policial", "2": "Hospital", "3": "Família", "4": "Outra"}, "Ignorado"),
}

# Federal-district codes that stand for the capital, and the capital's code.
DISTRICT_CODES = [
    "530170", "530040", "530060", "530180", "530050", "530130", "530090",
    "530070", "530080", "530120", "530135", "530100", "530020", "530150",
]
CAPITAL_DISTRICT_CODE = "530010"

# States per region and the label for an unknown state.
REGIONS = {
    "Norte": ["AC", "AM", "AP", "PA", "RO", "RR", "TO"],
    "Nordeste": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "Centro-Oeste": ["DF", "GO", "MT", "MS"],
    "Sudeste": ["ES", "MG", "RJ", "SP"],
    "Sul": ["PR", "RS", "SC"],
}
UNKNOWN_REGION = "Região Desconhecida"

# State capitals.
CAPITALS = {
    "AC": "Rio Branco", "AL": "Maceió", "AP": "Macapá", "AM": "Manaus", "BA": "Salvador",
    "CE": "Fortaleza", "DF": "Brasília", "ES": "Vitória", "GO": "Goiânia", "MA": "São Luís",
    "MT": "Cuiabá", "MS": "Campo Grande", "MG": "Belo Horizonte", "PA": "Belém",
    "PB": "João Pessoa", "PR": "Curitiba", "PE": "Recife", "PI": "Teresina",
    "RJ": "Rio de Janeiro", "RN": "Natal", "RS": "Porto Alegre", "RO": "Porto Velho",
    "RR": "Boa Vista", "SC": "Florianópolis", "SP": "São Paulo", "SE": "Aracaju", "TO": "Palmas",
}

# Facility types that become one column each in the municipal table.
FACILITY_TYPES = [
    "CENTRO DE SAUDE/UNIDADE BASICA",
    "UNIDADE DE APOIO DIAGNOSE E TERAPIA (SADT ISOLADO)",
    "CENTRO DE ATENCAO PSICOSSOCIAL",
    "PRONTO ATENDIMENTO",
    "TELESSAUDE",
    "CENTRO DE ATENCAO HEMOTERAPIA E OU HEMATOLOGICA",
    "LABORATORIO DE SAUDE PUBLICA",
    '"CENTRAL DE NOTIFICACAO,CAPTACAO E DISTRIB DE ORGAOS ESTADUAL"',
    "CENTRO DE PARTO NORMAL - ISOLADO",
    "UNIDADE DE VIGILANCIA EM SAUDE",
    "CENTRAL DE REGULACAO DO ACESSO",
    "SERVICO DE ATENCAO DOMICILIAR ISOLADO(HOME CARE)",
    "UNIDADE MOVEL FLUVIAL",
    "PRONTO SOCORRO ESPECIALIZADO",
    "OFICINA ORTOPEDICA",
    "POLO ACADEMIA DA SAUDE",
    "FARMACIA",
    "CENTRAL DE REGULACAO MEDICA DAS URGENCIAS",
    "UNIDADE MOVEL TERRESTRE",
    "UNIDADE DE ATENCAO EM REGIME RESIDENCIAL",
    "PRONTO SOCORRO GERAL",
    "CONSULTORIO ISOLADO",
    "CENTRAL DE GESTAO EM SAUDE",
    "COOPERATIVA OU EMPRESA DE CESSAO DE TRABALHADORES NA SAUDE",
    "HOSPITAL/DIA - ISOLADO",
    "HOSPITAL ESPECIALIZADO",
    "CLINICA/CENTRO DE ESPECIALIDADE",
    "UNIDADE DE ATENCAO A SAUDE INDIGENA",
    "POLO DE PREVENCAO DE DOENCAS E AGRAVOS E PROMOCAO DA SAUDE",
    "LABORATORIO CENTRAL DE SAUDE PUBLICA LACEN",
    "CENTRAL DE ABASTECIMENTO",
    "CENTRO DE IMUNIZACAO",
    "UNIDADE MOVEL DE NIVEL PRE-HOSPITALAR NA AREA DE URGENCIA",
    "CENTRO DE APOIO A SAUDE DA FAMILIA",
    "HOSPITAL GERAL",
    "POLICLINICA",
    "POSTO DE SAUDE",
    "UNIDADE MISTA",
]
UNKNOWN_FACILITY_TYPE = "DESCONHECIDO"

# The 13 positional columns of a city sheet, the cells that tell its header; two columns are read and not
# kept, nine are numbers.
CITY_SHEET_COLUMNS = [
    "nome", "codigo_municipio", "gentilico", "prefeito", "area_km2", "populacao_residente",
    "densidade_demografica", "escolarizacao_6_14", "idhm", "mortalidade_infantil",
    "total_receitas_brutas_realizadas", "total_despesas_brutas_empenhadas", "pib_per_capita",
]
CITY_SHEET_MARKS = ["Município [-]", "Municipio [-]"]
CITY_SHEET_UNUSED = ["gentilico", "prefeito"]
CITY_NUMERIC_COLUMNS = CITY_SHEET_COLUMNS[4:]
CITY_TABLE_COLUMNS = [c for c in CITY_SHEET_COLUMNS if c not in CITY_SHEET_UNUSED] + ["uf"]

# Facility columns kept by the registry ingest.
FACILITY_COLUMNS = [
    "CO_UNIDADE", "CO_CNES", "NU_CNPJ_MANTENEDORA", "TP_PFPJ", "NIVEL_DEP", "NO_RAZAO_SOCIAL",
    "NO_FANTASIA", "NO_LOGRADOURO", "NU_ENDERECO", "NO_COMPLEMENTO", "NO_BAIRRO", "CO_CEP",
    "NU_CNPJ", "CO_ATIVIDADE", "TP_UNIDADE", "CO_TURNO_ATENDIMENTO", "CO_ESTADO_GESTOR",
    "CO_MUNICIPIO_GESTOR", "CO_MOTIVO_DESAB", "TP_ESTAB_SEMPRE_ABERTO", "CO_TIPO_UNIDADE",
    "CO_TIPO_ESTABELECIMENTO", "CO_ATIVIDADE_PRINCIPAL", "TP_GESTAO", "data_competencia",
]

# Registry tables deduplicated over the months.
DEDUPLICATED_TABLES = [
    "tbatividade", "tbmunicipio", "tbestado", "tbtipounidade", "tbtipoestabelecimento",
    "tbatributo", "rlestabcomplementar", "tbatividadeprofissional",
]

# Census tables and the municipal-table column each of their columns becomes.
CENSUS_COLUMNS: dict[str, dict[str, str]] = {
    "taxa_de_alfabetizacao": {"total": "taxa_de_alfabetizados"},
    "taxa_coleta_lixo": {"pct_coletado": "pct_coleta_lixo"},
    "taxa_rede_esgoto": {"sim": "pct_com_rede_esgoto", "nao": "pct_sem_rede_esgoto"},
    "anos_de_estudo": {
        "total": "media_anos_estudo_geral",
        "11_14": "media_anos_estudo_11_14",
        "15_17": "media_anos_estudo_15_17",
        "18_24": "media_anos_estudo_18_24",
        "25_mais": "media_anos_estudo_25_mais",
    },
    "taxa_populacao_nivel_instrucao": {
        "sem_instrucao_fundamental_incompleto": "taxa_adultos_sem_instrucao",
        "fundamental_completo_medio_incompleto": "taxa_adultos_fundamental_completo",
        "medio_completo_superior_incompleto": "taxa_adultos_medio_completo",
        "superior_completo": "taxa_adultos_superior_completo",
    },
    "taxa_distribuicao_etaria": {"pct_60_mais": "pct_idoso"},
    "pop_res_favela": {"total": "residentes_favela"},
    "taxa_situacao_domicilio": {"urbana": "taxa_populacao_urbana", "rural": "taxa_populacao_rural"},
    "taxa_frequencia_escolar": {"total": "taxa_freq_escolar"},
}

# Output columns of the municipal table, in order, before the facility-type columns.
MUNICIPAL_COLUMNS = [
    "uf", "codigo_municipio", "nome", "populacao", "idh", "qtd_unidades", "hab_por_unidade",
    "unidades_por_k_hab", "medicos_por_k_habitante", "habitantes_por_medico",
    "enfermeiros_por_k_habitante", "habitantes_por_enfermeiros", "leitos_existentes",
    "quantidade_unidades_com_leito", "quantidade_unidades_com_leito_por_k_hab",
    "total_leitos_unidade", "leitos_por_k_hab", "leitos_sus", "total_leitos_sus_unidade",
    "leitos_sus_por_k_hab", "obitos_por_unidade", "obitos_em_estabelecimentos", "total_obitos",
    "taxa_mortalidade_geral", "mortalidade_infantil", "area_territorial", "densidade_demografica",
    "matriculas_ensino_medio", "total_receitas_brutas", "total_despesas_brutas", "pib_per_capita",
    "taxa_de_alfabetizados", "taxa_de_nao_alfabetizados", "pct_coleta_lixo", "pct_com_rede_esgoto",
    "pct_sem_rede_esgoto", "media_anos_estudo_geral", "media_anos_estudo_11_14",
    "media_anos_estudo_15_17", "media_anos_estudo_18_24", "media_anos_estudo_25_mais",
    "taxa_adultos_sem_instrucao", "taxa_adultos_fundamental_completo", "taxa_adultos_medio_completo",
    "taxa_adultos_superior_completo", "pct_idoso", "taxa_pop_residente_favela",
    "taxa_populacao_urbana", "taxa_populacao_rural", "taxa_freq_escolar",
]

# Admission measures per municipality.
ADMISSION_COLUMNS = [
    "total_internacoes", "obitos_por_internacao", "total_hospitais", "total_dias_permanencia",
    "total_diarias", "total_valor", "valor_medio_diaria", "total_obitos_em_internacao",
    "total_municipio_atendidos",
]

# Facility-type columns behind each care-level index (cleaned column names).
CARE_INDEXES = {
    "indice_atencao_basica": [
        "centro_de_saude/unidade_basica", "polo_academia_da_saude", "posto_de_saude",
        "centro_de_apoio_a_saude_da_familia",
    ],
    "indice_complexidade": [
        "unidade_de_apoio_diagnose_e_terapia_(sadt_isolado)", "centro_de_atencao_psicossocial",
        "hospital_especializado", "policlinica", "hospital_geral", "pronto_socorro_geral",
    ],
    "indice_vigilancia_movel": [
        "unidade_de_vigilancia_em_saude", "unidade_movel_terrestre", "unidade_movel_fluvial",
        "central_de_regulacao_medica_das_urgencias",
    ],
}

# Health features used for clustering (cleaned column names).
HEALTH_FEATURES = [
    "unidades_por_k_hab", "medicos_por_k_habitante", "enfermeiros_por_k_habitante",
    "quantidade_unidades_com_leito_por_k_hab", "leitos_sus_por_k_hab", "taxa_mortalidade_geral",
    "mortalidade_infantil", "pronto_atendimento", "telessaude",
    "centro_de_atencao_hemoterapia_e_ou_hematologica", "laboratorio_de_saude_publica",
    "centro_de_parto_normal_-_isolado", "central_de_regulacao_do_acesso",
    "servico_de_atencao_domiciliar_isolado(home_care)", "pronto_socorro_especializado",
    "oficina_ortopedica", "farmacia", "unidade_de_atencao_em_regime_residencial",
    "central_de_gestao_em_saude", "cooperativa_ou_empresa_de_cessao_de_trabalhadores_na_saude",
    "hospital/dia_-_isolado", "clinica/centro_de_especialidade", "unidade_de_atencao_a_saude_indigena",
    "polo_de_prevencao_de_doencas_e_agravos_e_promocao_da_saude",
    "laboratorio_central_de_saude_publica_lacen", "central_de_abastecimento", "centro_de_imunizacao",
    "unidade_movel_de_nivel_pre-hospitalar_na_area_de_urgencia", "unidade_mista",
    "obitos_por_internacao", "total_diarias", "valor_medio_diaria", "total_municipio_atendidos",
    "taxa_ocupacao_anual",
] + [column for group in CARE_INDEXES.values() for column in group]

# Socio-economic features (cleaned column names).
SOCIOECONOMIC_FEATURES = [
    "populacao", "idh", "area_territorial", "densidade_demografica", "matriculas_ensino_medio",
    "total_receitas_brutas", "total_despesas_brutas", "pib_per_capita", "taxa_de_alfabetizados",
    "taxa_de_nao_alfabetizados", "pct_coleta_lixo", "pct_com_rede_esgoto", "pct_sem_rede_esgoto",
    "media_anos_estudo_geral", "media_anos_estudo_11_14", "media_anos_estudo_15_17",
    "media_anos_estudo_18_24", "media_anos_estudo_25_mais", "taxa_adultos_sem_instrucao",
    "taxa_adultos_fundamental_completo", "taxa_adultos_medio_completo",
    "taxa_adultos_superior_completo", "pct_idoso", "taxa_pop_residente_favela",
    "taxa_populacao_urbana", "taxa_populacao_rural", "taxa_freq_escolar",
]

# Identifying columns written next to the features, and the dashboard indicators.
LABEL_COLUMNS = ["codigo_municipio", "nome", "uf", "regiao"]
DASHBOARD_INDICATORS = {
    "cluster": "Cluster",
    "populacao": "👥 População",
    "idh": "📊 IDH",
    "pib_per_capita": "💰 PIB per capita",
    "taxa_de_alfabetizados": "📚 Taxa de alfabetização",
    "pct_idoso": "👴 % de idosos",
    "taxa_freq_escolar": "📖 Taxa de frequência escolar",
    "taxa_populacao_urbana": "🏙️ Taxa de população urbana",
    "unidades_por_k_hab": "🏥 Unidades de Saúde por mil hab.",
    "medicos_por_k_habitante": "🩺 Médicos por mil hab.",
    "enfermeiros_por_k_habitante": "🧑‍⚕️ Enfermeiros por mil hab.",
    "leitos_por_k_hab": "🛏️ Leitos por mil hab.",
    "leitos_sus_por_k_hab": "🛏️ Leitos SUS por mil hab.",
    "taxa_mortalidade_geral": "💀 Mortalidade geral",
    "mortalidade_infantil": "👶 Mortalidade infantil",
}
