"""Keys, unions and dictionaries on input of mixed widths and types."""

from pyspark.sql import functions as F

from munimetrics.bindings.standins import padded
from munimetrics.functions.text import clean_columns, clean_label
from munimetrics.operators.clustering import density_radius
from munimetrics.operators.joins import lookup
from munimetrics.operators.ordering import positions
from munimetrics.sources import files


def test_long_keys_stay_whole(spark):
    numbers = [5, 150000, 1500000, 1500001, 15000000, 1500000000]
    rows = spark.createDataFrame([(n,) for n in numbers], "n long").select(padded(F.col("n"), 6).alias("k")).collect()
    assert [r.k for r in rows] == ["000005", "150000", "1500000", "1500001", "15000000", "1500000000"]


def test_text_wins_in_unions(spark):
    numbers = spark.createDataFrame([(1, 2)], "a long, b int")
    texts = spark.createDataFrame([("X1", 3)], "a string, b long")
    for union in (files.union_relaxed, files.union_aligned):
        assert sorted(map(tuple, union([numbers, texts]).collect())) == [("1", 2), ("X1", 3)]


def test_numbers_match_texts_with_leading_zeros(spark):
    facts = spark.createDataFrame([("05",), ("x",), (None,), ("7",)], "k string")
    names = spark.createDataFrame([(5, "five"), (7, "seven")], "code long, name string")
    assert {(r.k, r.name) for r in lookup(facts, names, "k", "code", ["name"]).collect()} == {
        ("05", "five"), ("x", None), (None, None), ("7", "seven")}


def test_snapshot_dates_only_from_names_with_a_month(spark):
    names = ["tb202212.csv", "tb202212.csv.gz", "tb.csv", "a/tb202301.parquet/part-0"]
    rows = spark.createDataFrame([(n,) for n in names], "n string").select(files.snapshot_date(F.col("n")).alias("d"))
    assert [r.d for r in rows.collect()] == ["2022-12-01", "2022-12-01", None, "2023-01-01"]


def test_quotes_as_registries_write_them(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k;name;street\n"1";"HOSPITAL ""SANTA; ROSA"" X";"RUA \\ B\\"\n2;"";\n', encoding="latin-1")
    rows = [tuple(r) for r in files.scan_delimited(spark, str(tmp_path / "a.csv")).collect()]
    assert rows[0] == ("1", 'HOSPITAL "SANTA; ROSA" X', "RUA \\ B\\") and rows[1][1] == ""
    (tmp_path / "b.csv").write_text('k;name\n1;"two\nlines"\n', encoding="latin-1")
    assert [tuple(r) for r in files.scan_delimited(spark, str(tmp_path / "b.csv"), multiLine=True).collect()] == [("1", "two\nlines")]


def test_column_labels(spark):
    frame = spark.range(1).toDF("<b>São</b> João - %área (km²)")
    assert clean_columns(frame).columns == ["sao_joao_area_km2"]


def test_large_groups_are_dealt_out_by_bucket_too(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = spark.range(1000).select((F.col("id") % 2).alias("g"), (F.col("id") % 97).cast("double").alias("v")).groupBy("g", "v").agg(F.count("*").alias("n"))
        plan = positions(counts, ["g"], "v")._jdf.queryExecution().executedPlan().toString()
        assert any("hashpartitioning(_group" in line and "_bucket" in line for line in plan.splitlines() if "Exchange" in line)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_labels_spell_out_all_of_unicode(spark):
    cases = {"\u2474 x": "1_x", "\u338f": "kg", "\U0001d400b": "ab", "\u00bd \ufb03\nS\u00e3o": "12_ffi_sao", "": "", None: None}
    rows = spark.createDataFrame([(c,) for c in cases], "t string").select("t", clean_label(F.col("t")).alias("label")).collect()
    assert {r.t: r.label for r in rows} == cases


def test_an_outlier_leaves_the_radius_fine(spark):
    near = spark.range(4000).select((F.col("id") % 20 / 2000).alias("x"), (F.floor(F.col("id") / 20) % 20 / 2000).alias("y"))
    far = near.union(spark.createDataFrame([(1e6, 1e6)], "x double, y double"))
    assert density_radius(near, "x", "y", 10) < 0.01 and density_radius(far, "x", "y", 10) < 0.01
