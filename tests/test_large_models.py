"""Parameter lookups in models with many references."""

import json
import random

import pytest
from pyspark.sql import functions as F

from measlake.functions import params
from measlake.sources import fit_model


@pytest.mark.parametrize("size", [0, 1, 32, 33, 34, 63, 64, 65, 500])
def test_find_equals_the_map(spark, size):
    keys = sorted({f"k{random.Random(size).random()}{i}" for i in range(size)})
    wanted = [*keys, "", "a", "z", "k", None]
    entries = F.from_json(F.lit(json.dumps({k: {"std": str(i)} for i, k in enumerate(keys)})), params.ERRORS)
    rows = spark.createDataFrame([(k,) for k in wanted], "key string").select(
        "key", params.find(params.index(entries), F.col("key"))["std"].alias("std")
    )
    known = {k: str(i) for i, k in enumerate(keys)}
    assert {r.key: r.std for r in rows.collect()} == {k: known.get(k) for k in wanted}


def large_model(count):
    references = {
        f"r{i}": {"name": f"n{i}", "fixed": i % 3 == 0, "slot": {"value": i / 8}} for i in range(count)
    }
    stack = [
        {
            "name": f"layer {i}",
            "thickness": {"__class__": "Reference", "id": f"r{i}"},
            "interface": {"__class__": "Reference", "id": f"gone{i}", "value": 4},
            "material": {"name": "m", "rho": {"slot": {"value": i}}, "irho": {"__class__": "Reference", "id": "r7", "slot": 5}},
        }
        for i in range(count)
    ]
    errors = {f"n{i}": {"std": i / 4} for i in range(0, count, 2)}
    return json.dumps({"references": references, "object": {"sample": {"layers": stack}}}), json.dumps(errors)


@pytest.mark.parametrize("count", [20, 700])
def test_layers_of_a_large_model(spark, count):
    content, errors = large_model(count)
    texts = spark.createDataFrame([("m.json", content, errors)], "path string, content string, error_content string")
    row = fit_model.parse(texts).select("stack", "num_parameters").first()
    assert row.num_parameters == len(row.stack) == count
    for i, layer in enumerate(row.stack):
        std = i / 4 if i % 3 and i % 2 == 0 else None
        assert (layer.thickness, layer.thickness_std) == (i / 8, std)
        assert (layer.interface, layer.interface_std) == (4.0, None)
        assert (layer.sld, layer.sld_std) == (float(i), None)
        # The slot is no object; the reference counts all the same.
        assert (layer.isld, layer.isld_std) == (7 / 8, None)


def test_objects_of_other_shapes(spark):
    given = ['{"value": "3"}', '{"value": {"a": 1}}', '{"slot": 5, "value": 6}', '{"slot": null, "value": true}', "[1]",
             '"7"', "true", "null", "1e-3", '{"slot": [], "value": 2}', "{}"]
    expected = [3.0, 0.0, 6.0, 1.0, 0.0, 0.0, 1.0, 0.0, 0.001, 2.0, 0.0]
    rows = spark.createDataFrame(list(enumerate(given)), "i int, text string")
    nothing = params.index(F.create_map().cast("map<string, struct<value: double, std: double>>"))
    found = rows.select("i", params.resolve(F.parse_json("text"), nothing)["value"].alias("v")).orderBy("i")
    assert [r.v for r in found.collect()] == expected
