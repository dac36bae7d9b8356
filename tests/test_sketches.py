import numpy as np
from pyspark.sql import functions as F

from munimetrics.operators import sketches

PROBS = {"q1": 0.25, "median": 0.5, "q3": 0.75, "top": 1.0, "p999": 0.999}


def frame_of(spark):
    rng = np.random.default_rng(4)
    rows = [("even", m, float(v)) for m in range(6) for v in rng.uniform(0, 1, 4000)]
    rows += [("ties", m, float(v)) for m in range(6) for v in rng.integers(0, 3, 500)]
    rows += [(None, m, float(v)) for m in range(6) for v in rng.normal(m, 1, 300)]
    rows += [("one", 0, 7.0), ("none", 0, None), ("none", 1, float("nan")), ("odd", 0, -0.0), ("odd", 1, 1.0), ("odd", 2, None)]
    return spark.createDataFrame(rows, "g string, month int, v double")


def exact(frame):
    rows = frame.where("v is not null and not isnan(v)").toPandas()
    rows["g"] = rows["g"].fillna("~")
    return {g: [float(np.quantile(part.v, p)) for p in PROBS.values()] for g, part in rows.groupby("g")}


def check(found, want):
    got = {r["g"] if r["g"] is not None else "~": [r[n] for n in PROBS] for r in found.collect()}
    assert got.keys() == want.keys()
    assert all(np.allclose(got[g], want[g], rtol=0, atol=1e-12) for g in want)


def test_months_add_up_to_exact_quantiles(spark):
    frame = frame_of(spark)
    monthly = sketches.value_sketches(frame, ["g", "month"], "v")
    check(sketches.sketched_quantiles(frame, ["g"], "v", PROBS, sketches.merge_sketches(monthly, ["g"])), exact(frame))
    check(sketches.sketched_quantiles(frame, ["g"], "v", PROBS), exact(frame))


def test_only_rows_between_the_cuts_are_ordered(spark):
    frame = frame_of(spark).where("g = 'even'")
    cuts = sketches._cuts(sketches.value_sketches(frame, ["g"], "v"), ["g"], {"q1": 0.25}, sketches.SIZE)
    low, high = cuts.select("low", "high").first()
    share = frame.where(F.col("v").between(low, high)).count() / frame.count()
    assert share < 0.03 and low < np.quantile(frame.toPandas().v, 0.25) < high


def test_a_wrong_sketch_costs_time_only(spark):
    frame = frame_of(spark)
    wrong = sketches.value_sketches(frame.withColumn("v", F.col("v") + 100), ["g"], "v")
    check(sketches.sketched_quantiles(frame, ["g"], "v", PROBS, wrong), exact(frame))
    part = sketches.value_sketches(frame.where("g <> 'ties'"), ["g"], "v")
    check(sketches.sketched_quantiles(frame, ["g"], "v", PROBS, part), exact(frame))
