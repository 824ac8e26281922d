"""How often a curve is compared with the probes of its model."""

import json

from conftest import curve_text, layer, model
from pyspark.sql import functions as F

from measlake.operators import curve_match
from measlake.plans.assemble import assemble
from measlake.sources import fit_model, manifest, reduced_text

LEVELS = (9.0, 1.0, 30.0, 2.0, 500.0)


def closest(spark, q, r, probes):
    rows = [(q, r, [{"q": a, "r": b} for a, b in probes])]
    df = spark.createDataFrame(rows, "q array<double>, r array<double>, d array<struct<q: array<double>, r: array<double>>>")
    df = df.withColumn("p", F.transform("d", lambda d: curve_match.probe(d["q"], d["r"])))
    return df.select(curve_match.closest(F.col("q"), F.col("r"), F.col("p")).alias("c")).first().c


def flat(level, knots):
    return [k / knots for k in range(knots + 1)], [level] * (knots + 1)


def test_a_short_curve_is_compared_without_bounds(spark):
    for n in (2, curve_match.PIECES):
        found = closest(spark, [0.3 + 0.01 * k for k in range(n)], [1.0] * n, [flat(x, 40) for x in LEVELS])
        assert (found.dataset, found.score, found.compared, found.usable) == (1, 0.0, 5, 5)


def test_bounds_hold_for_long_curves_and_probes_of_few_knots(spark):
    for knots in (1, curve_match.PIECES - 1, curve_match.PIECES, 40):
        found = closest(spark, [0.3 + 0.001 * k for k in range(100)], [1.0] * 100, [flat(x, knots) for x in LEVELS])
        assert (found.dataset, found.score, found.usable) == (1, 0.0, 5)
        assert found.compared < found.usable


def test_a_measurement_is_matched_once(spark, ingest):
    q = [0.01 + 0.01 * i for i in range(12)]
    probes = [(q, [9.0] * 12), (q, [1.0 / (i + 1) for i in range(12)])]
    content = json.dumps(model([[layer("air", 0.0), layer("a", 5.0)], [layer("air", 0.0), layer("b", 6.0)]], probes))
    texts = spark.createDataFrame([("/m.json", content, None)], "path string, content string, error_content string")
    # As a table would be: the model is parsed, nothing of it is left to plan.
    models = spark.createDataFrame(fit_model.parse(texts).collect(), fit_model.parse(texts).schema)
    curves = reduced_text.parse(spark.createDataFrame([("/c.txt", curve_text(1))], "path string, content string"))
    jobs = spark.createDataFrame(
        [("j", "/c.txt", None, "/m.json", None, None)],
        "job string, reduced string, parquet string, model string, environment string, nexus_file string",
    )
    batch = assemble(manifest.single_jobs(jobs), curves, models, **ingest)
    plan = batch.issues._jdf.queryExecution().optimizedPlan().toString()
    # One comparison sorts the bounds, and the line of points and knots.
    assert plan.count("sort_array(") == 2
    notes = [row.message for row in batch.issues.collect() if row.severity == "warning"]
    assert notes[0] == "Dataset 2 of 2 is taken, the best match of the curve"
