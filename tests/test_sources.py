import pytest
from pyspark.sql import functions as F

from munimetrics.operators import aggregates
from munimetrics.plans.ingest import fix_codes, ingest_census, ingest_registry, snapshot_files
from munimetrics.sources import files, tables


def test_delimited_keeps_zeros_and_tells_empty_from_null(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes('CO_UNIDADE;NOME;MOTIVO\n0012;São João;""\n0013;"a;b";\n'.encode("latin-1"))
    rows = [tuple(r) for r in files.scan_file(spark, str(path)).orderBy("CO_UNIDADE").collect()]
    assert rows[0] == ("0012", "São João", "")
    assert rows[1] == ("0013", "a;b", None)


def test_unknown_extension_and_table(spark):
    with pytest.raises(ValueError):
        files.scan_file(spark, "/tmp/x.xlsx")
    with pytest.raises(FileNotFoundError):
        tables.find_table(spark, "no_such_table")
    spark.range(2).createOrReplaceTempView("Some_View")
    assert tables.find_table(spark, "SOME_view").count() == 2


def test_snapshot_date_from_name(spark):
    dated = files.with_snapshot_date(spark.range(1), "tbEstado202207.csv")
    assert dated.first()["data_competencia"] == "2022-07-01"


def test_union_aligned_fills_and_sorts(spark):
    a, b = spark.createDataFrame([(1, "x")], "b int, a string"), spark.createDataFrame([(2.5, True)], "b double, c boolean")
    out = files.union_aligned([a, b])
    assert out.columns == ["a", "b", "c"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted([("x", 1.0, None), (None, 2.5, True)], key=str)


def test_city_sheets_and_reload(spark, tmp_path):
    folder = tmp_path / "sheets"
    folder.mkdir()
    values = "-,10,-3,4,5,6,7,8,9"
    lines = ["Título", "Município [-],Código [-]", f"Cidade,1100015,g,p,{values}", "Notas:", "Fonte,Notas: x"]
    (folder / "ro.csv").write_text("\n".join(lines))
    sheets = files.scan_city_sheets(spark, str(folder))
    row = sheets.first()
    assert sheets.count() == 1 and "prefeito" not in sheets.columns
    assert (row["uf"], row["area_km2"], row["densidade_demografica"]) == ("RO", 0.0, 3.0)
    target = str(tmp_path / "cities")
    tables.load_cities(sheets, target)
    again = tables.load_cities(sheets, target)
    assert again.count() == 1 and again.first()["codigo_municipio"] == "110001"


def test_ingest_months(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "tbTipoUnidade202201.csv").write_text('CO_TIPO_UNIDADE;DS\n01;"A"\n02;"B"\n')
    (raw / "tbTipoUnidade202202.csv").write_text('CO_TIPO_UNIDADE;DS;NOVA\n01;"A";\n03;"C";"n"\n')
    (raw / "outra202202.csv").write_text("CO_ESTADO_GESTOR;CO_MUNICIPIO_GESTOR\n53;530170\n11;110001\n")
    assert {k: len(v) for k, v in snapshot_files(spark, str(raw)).items()} == {"tbtipounidade": 2, "outra": 1}
    written = ingest_registry(spark, str(raw), str(tmp_path / "out"))
    kept = {(r["CO_TIPO_UNIDADE"], r["data_competencia"]) for r in written["tbtipounidade"].collect()}
    assert kept == {("01", "2022-02-01"), ("02", "2022-01-01"), ("03", "2022-02-01")}
    codes = {r["CO_MUNICIPIO_GESTOR"] for r in written["outra"].collect()}
    assert codes == {"530010", "110001"}
    assert fix_codes(spark.range(1)).columns == ["id"]


def test_metadata_keeps_nulls(spark):
    meta = tables.run_metadata(spark, {"k": 5, "f": ["a"], "s": None, "m": {"0": 1}})
    assert meta.first()["meta"] == '{"k":5,"f":["a"],"s":null,"m":{"0":1}}'


def test_a_thousand_files_of_three_headers_in_one_scan(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    headers = ["A;B", "B;C;A", "\"A\";D é"]
    for n in range(1000):
        rows = {0: f"a{n};\"b;{n}\"", 1: f"b{n};;a{n}", 2: f"a{n};\"\""}[n % 3]
        (raw / f"tbX{1900 + n // 12}{n % 12 + 1:02d}.csv").write_text(f"{headers[n % 3]}\n{rows}\n{rows}\n", "latin-1")
    (raw / "other202201.csv").write_text("Z\n1\n")
    (raw / "empty202201.csv").write_text("")
    plan = files.plan_headers(spark, str(raw))
    assert {k: len(v) for k, v in plan.headers.items()} == {"tbx": 3, "other": 1}
    table = files.scan_planned(spark, plan, "tbx")
    assert table._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    assert table.columns == ["A", "B", "C", "D é", "data_competencia"]
    got = {tuple(r) for r in table.collect()}
    want = set()
    for n in range(1000):
        own = {0: (f"a{n}", f"b;{n}", None, None), 1: (f"a{n}", f"b{n}", None, None), 2: (f"a{n}", None, None, "")}[n % 3]
        want.add((*own, f"{1900 + n // 12}-{n % 12 + 1:02d}-01"))
    assert got == want and table.count() == 2000
    assert files.scan_planned(spark, plan, "other").collect()[0]["Z"] == "1"


def test_planned_scan_equals_files_one_by_one(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "t202201.csv").write_text('X;Y\n1;"a"\n2\n3;"";extra\n')
    (raw / "t202202.csv").write_text('Y;;X\n\\N;z;4\n"q""r;";;5\n')
    one = union_of(spark, [str(raw / "t202201.csv"), str(raw / "t202202.csv")])
    planned = files.scan_planned(spark, files.plan_headers(spark, str(raw)), "t")
    assert planned.columns == one.columns
    assert sorted(map(str, planned.collect())) == sorted(map(str, one.collect()))
    (raw / "u202201.csv").write_text("X;x\n1;2\n")
    with pytest.raises(ValueError):
        files.plan_headers(spark, str(raw))


def union_of(spark, paths):
    return files.union_aligned([files.with_snapshot_date(files.scan_file(spark, p)) for p in paths])


def test_sheet_header_is_searched(spark, tmp_path):
    folder = tmp_path / "sheets"
    folder.mkdir()
    values = "1,10,3,4,5,6,7,8,9"
    titles = [f"Título {n},110001{n},x" for n in range(40)]
    rows = [f"Cidade,A-12,g,p,{values}", f"Outra, 1100023.0 ,g,p,{values}", f"Sem,,g,p,{values}", "", f"Vila,12.50,g,p,{values}"]
    (folder / "ro.csv").write_text("\n".join([*titles, "x, Municipio [-] ,y", *rows, "Notas:", "Fonte,Notas: x", "fim,,"]))
    (folder / "ac.csv").write_text("\n".join(["Município [-]", f"Município [-],7,g,p,{values}"]))
    got = {(r.uf, r.codigo_municipio) for r in files.scan_city_sheets(spark, str(folder)).collect()}
    assert got == {("RO", "A-12"), ("RO", "1100023"), ("RO", "12.50"), ("AC", "7")}
    (folder / "sp.csv").write_text(f"Cidade,1,g,p,{values}\n")
    with pytest.raises(Exception, match="no header row in"):
        files.scan_city_sheets(spark, str(folder)).collect()


def test_census_numbers_are_strict(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "taxa.csv").write_text("codigo;a\n01;1.5\n02; \n")
    assert [r.a for r in ingest_census(spark, str(raw), str(tmp_path / "out"))["taxa"].orderBy("codigo").collect()] == [1.5, None]
    (raw / "taxa.csv").write_text("codigo;a\n01;1,5\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ingest_census(spark, str(raw), str(tmp_path / "out"))


def test_months_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "t")

    def load(rows, **settings):
        frame = spark.createDataFrame(rows, "id int, data_competencia string")
        return {tuple(r) for r in tables.load_months(frame, path, **settings).collect()}, frame.schema

    one, two = "2022-01-01", "2022-02-01"
    load([(1, one), (2, one), (9, None)])
    files_of = lambda m: sorted(p.name for p in (tmp_path / "t" / f"data_competencia={m}").iterdir())
    load([(3, two)])
    kept = files_of(two)
    got, schema = load([(4, one)])
    assert got == {(4, one), (3, two), (9, None)} and files_of(two) == kept
    assert tables.months_out_of_step(spark, path, schema).count() == 0
    assert load([(5, two)], months=[one, two])[0] == {(5, two), (9, None)}
    assert load([(4, one)])[0] == {(4, one), (5, two), (9, None)}
    # A load that broke off between rows and manifest is seen, and loading the month again mends it.
    spark.createDataFrame([(7, two)], schema).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("data_competencia").parquet(path)
    assert [r[0] for r in tables.months_out_of_step(spark, path, schema).collect()] == [two]
    load([(7, two)])
    assert tables.months_out_of_step(spark, path, schema).count() == 0


def test_sets_add_up_over_months(spark):
    rows = [(p, m, e) for p in "ab" for m in range(3) for e in [1, 32768, 32769, 10**12, m, -m, None]]
    frame = spark.createDataFrame(rows, "place string, month int, id long")
    sets = aggregates.distinct_bitmaps(frame, ["place", "month"], "id")
    for by in (["place"], ["month"], ["place", "month"], []):
        want = {tuple(r)[: len(by)]: r["n"] for r in frame.groupBy(*by).agg(F.count_distinct("id").alias("n")).collect()}
        assert {tuple(r)[: len(by)]: r["n"] for r in aggregates.bitmap_distinct(sets, by).collect()} == want
    texts = spark.createDataFrame([(f"t{n % 500}",) for n in range(2000)] + [(None,)], "t string").repartition(5)
    first = aggregates.numbered(texts, "t")
    more = spark.createDataFrame([("t1",), ("u",), ("v",)], "t string")
    again = {r.t: r.number for r in aggregates.numbered(more, "t", first).collect()}
    known = {r.t: r.number for r in first.collect()}
    assert len(known) == len(set(known.values())) == 500 and max(known.values()) < 4000
    assert again | known == again and len(set(again.values())) == 502
