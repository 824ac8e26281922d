"""References and error files are worked up only for models whose layers are read."""

import json

from measlake.sources import fit_model

REFERENCES = {
    "t": {"name": "thick", "fixed": False, "value": 7},
    "s": {"name": "own", "fixed": False, "std": 3, "value": 8},
}


def layer(name, reference):
    return {"name": name, "thickness": {"__class__": "Reference", "id": reference}, "material": {"name": name}}


def parsed(spark, model, errors):
    rows = [("/m.json", json.dumps(model), None if errors is None else json.dumps(errors))]
    return fit_model.parse(spark.createDataFrame(rows, "path string, content string, error_content string"))


def thickness(layers):
    return [(x["name"], x["thickness"], x["thickness_std"]) for x in layers]


def test_counts_need_no_resolved_references(spark):
    model = {"references": REFERENCES, "object": {"sample": {"layers": [layer("a", "t")]}}}
    df = parsed(spark, model, {"thick": {"std": 2}})
    counts = df.select("num_parameters", "num_free_parameters", "malformed")
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "transform_values" not in plan
    assert plan.count("from_json") == 1
    assert tuple(counts.first()) == (2, 2, False)


def test_own_layers_and_experiments_share_references(spark):
    experiments = [{"sample": {"layers": [layer("b", "s")]}}, {"sample": None}]
    model = {"references": REFERENCES, "object": {"sample": {"layers": [layer("a", "t")]}, "models": experiments}}
    row = parsed(spark, model, {"thick": {"std": 2}}).first()
    assert thickness(row.stack) == [("a", 7.0, 2.0)]
    assert [thickness(d.layers) for d in row.datasets] == [[("b", 8.0, 3.0)], []]


def test_no_layers_no_experiments_no_errors(spark):
    for sample, models in ((None, None), ({"layers": []}, []), ({"layers": None}, None)):
        row = parsed(spark, {"references": REFERENCES, "object": {"sample": sample, "models": models}}, None).first()
        assert (row.stack, row.datasets, row.num_parameters, row.num_experiments) == ([], [], 2, 0)


def test_an_error_file_is_parsed_once(spark):
    model = {"references": REFERENCES, "object": {"sample": {"layers": [layer("a", "t")]}}}
    df = parsed(spark, model, {"thick": {"std": 2}}).select("stack")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # The model's file and the error file, each once.
    assert plan.count("from_json") == 2
    assert thickness(df.first().stack) == [("a", 7.0, 2.0)]


def test_objects_of_all_layers_are_read_in_one_cast(spark):
    """Fields of parameters that are objects are not read anew by the lambda of each parameter."""
    given = ['{"value": "3"}', '"7"', "true", "1e-3", "[1]", '{"slot": 5, "value": 6}', '{"__class__": "Reference", "id": "s"}', "null"]
    parts = [f'{{"name": "a", "thickness": {x}, "material": {{"rho": {x}}}}}' for x in given]
    content = f'{{"references": {json.dumps(REFERENCES)}, "object": {{"sample": {{"layers": [{", ".join(parts)}, null]}}}}}}'
    rows = spark.createDataFrame([("/m.json", content, None)], "path string, content string, error_content string")
    df = fit_model.parse(rows).select("stack")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "schema_of_variant" not in plan and plan.count("try_variant_get") <= 2 * 4
    stack = df.first().stack
    expected = [3.0, 0.0, 1.0, 0.001, 0.0, 6.0, 8.0, 0.0, 0.0]
    assert [x.thickness for x in stack] == [x.sld for x in stack] == expected
    assert [x.thickness_std for x in stack] == [None] * 6 + [3.0, None, None]
    assert [x.name for x in stack] == ["a"] * 8 + ["unknown"]
