"""Conditions, names, instruments, parameters, layers and curve checks."""

import json

import pytest
from conftest import layer, model
from pyspark.sql import functions as F

from measlake.functions import conditions, curves, instruments, layers, names
from measlake.sources import fit_model

CONDITIONS = [
    ("Resting at OCV in heavy water (pH 6.75, 0.2 M Na2SO4, argon)", ("open_circuit", None, None, 6.75, ("Na2SO4", 0.2))),
    ("Kept at -2 V in 0.25 M LiOH", ("potentiostatic", -2.0, "SHE", None, ("LiOH", 0.25))),
    ("Cell at +0.75 V vs RHE, pH=6", ("potentiostatic", 0.75, "RHE", 6.0, None)),
    ("Near OCP, close to 0.4 V vs SCE", ("open_circuit", None, None, None, None)),
    ("As-grown film under nitrogen", (None, None, None, None, None)),
    ("then she set it to −3 V", ("potentiostatic", -3.0, "SHE", None, None)),
    ("0.3 V vs NHE and SCE", ("potentiostatic", 0.3, "SHE", None, None)),
    ("0.3 V vs ag / agcl", ("potentiostatic", 0.3, "Ag/AgCl", None, None)),
    ("0.3 V vs Hg/HgSO4 or Hg/HgO", ("potentiostatic", 0.3, "Hg/HgSO4", None, None)),
    ("0.3 v, 5 Volts", (None, None, None, None, None)),
    ("open circuit", ("open_circuit", None, None, None, None)),
    ("", (None, None, None, None, None)),
    (None, (None, None, None, None, None)),
]


def test_conditions(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CONDITIONS)], "i int, t string")
    rows = df.select("i", conditions.conditions(F.col("t")).alias("c")).orderBy("i").collect()
    for (text, want), row in zip(CONDITIONS, rows):
        c = row.c
        electrolyte = (c.electrolyte.name, c.electrolyte.concentration_M) if c.electrolyte else None
        assert (c.control_mode, c.potential, c.potential_scale, c.pH, electrolyte) == want, text


@pytest.mark.parametrize(
    "path,run,curve_run,proposal,instrument",
    [
        ("/data/REF_L_301122_joined.txt", 301122, 301122, None, "REF_L"),
        ("/data/REF_L/IPTS-4711/x/REFL_301122_auto.txt", 301122, 301122, "IPTS-4711", "REF_L"),
        ("/d/refl_12.txt", 12, None, None, "REF_L"),
        ("/d/model_301122.json", 301122, 301122, None, None),
        ("/d/scan_301122_out/model.json", 301122, None, None, None),
        ("/ipts-7/no_number.txt", None, None, "IPTS-7", None),
    ],
)
def test_names(spark, path, run, curve_run, proposal, instrument):
    df = spark.createDataFrame([(path,)], "p string")
    p = F.col("p")
    row = df.select(
        names.run_number(p), names.run_number_of_curve_file(names.file_name(p)), names.proposal(p), names.instrument_of_path(p)
    ).collect()[0]
    assert tuple(row) == (run, curve_run, proposal, instrument)


KINDS = [
    ("/d/REFL_1_reduced.txt", "# Experiment IPTS-1\n# Q [1/Angstrom]\n", "reduced"),
    ("/d/x.txt", "# IPTS\nnothing", "unknown"),
    ("/d/x.txt", "\n" * 30 + "# Experiment\nReduction", "reduced"),
    ("/d/x_combined_data.txt", "# Reduction 1", "reduced"),
    ("/d/a.parquet", None, "parquet"),
    ("/d/a.nxs.h5", None, "raw_hdf5"),
    ("/d/a.HDF5", None, "raw_hdf5"),
    ("/d/m.json", '{"$schema": "Bumps-draft"}', "model"),
    ("/d/m.json", '{"sample": {"layers": []}}', "model"),
    ("/d/m.json", '{"sample": 1}', "unknown"),
    ("/d/.json", '{"refl1d": 1}', "unknown"),
    ("/d/readme", None, "unknown"),
]


def test_file_kinds(spark):
    df = spark.createDataFrame([(i, p, c) for i, (p, c, _) in enumerate(KINDS)], "i int, p string, c string")
    rows = df.select("i", names.file_kind(F.col("p"), F.col("c")).alias("k")).orderBy("i").collect()
    assert [r.k for r in rows] == [k for _, _, k in KINDS]


def test_proposal_from_content_only_for_reduced(spark):
    rows = [("/d/REFL_1.txt", "# Experiment ipts 55\nReduction"), ("/d/m.json", "refl1d IPTS-66")]
    df = spark.createDataFrame(rows, "p string, c string")
    got = df.select(names.identify(F.col("p"), F.col("c")).alias("i")).collect()
    assert [r.i.proposal for r in got] == ["IPTS-55", None]


def test_instruments(spark):
    ids = ["REF_L", "ref_l", "REF_L_123", "BL4B", "BL-4B", "xbl-4bx", "REF_M", "", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(ids)], "i int, v string")
    name = instruments.resolve(F.col("v"))
    rows = df.select("i", name.alias("n"), instruments.default_of(name, "wavelength").alias("w")).orderBy("i").collect()
    assert [r.n for r in rows] == ["REF_L"] * 6 + ["GENERIC"] * 3
    assert [r.w for r in rows] == [6.0] * 6 + [None] * 3


def parsed(spark, data, errors=None):
    df = spark.createDataFrame(
        [("/m.json", json.dumps(data), json.dumps(errors) if errors else None)],
        "path string, content string, error_content string",
    )
    return fit_model.parse(df)


def reference(ref):
    return {"__class__": "Reference", "id": ref}


def test_parameters(spark):
    refs = {
        "a": {"name": "A", "fixed": False, "slot": {"value": 50.5}, "value": 1},
        "b": {"name": "B", "fixed": False, "std": 0.5, "value": 7},
        "c": {"name": "C", "value": 8},
        "d": {"name": "D", "fixed": True, "std": 3, "value": 9},
    }
    values = [reference("a"), reference("b"), reference("c"), reference("d"), reference("none"), 4, {"value": 5}, {"slot": {"value": 6}, "value": 1}, None, "text", {}]
    stack = [{"name": str(i), "thickness": v} for i, v in enumerate(values)]
    data = {"references": refs, "object": {"sample": {"layers": stack}}}
    row = parsed(spark, data, {"A": {"std": 2.5, "mean": 1}, "B": {"std": 99}, "C": {"std": 1}, "D": {}}).collect()[0]
    assert [x.thickness for x in row.stack] == [50.5, 7.0, 8.0, 9.0, 0.0, 4.0, 5.0, 6.0, 0.0, 0.0, 0.0]
    assert [x.thickness_std for x in row.stack] == [2.5, 0.5, None, None] + [None] * 7
    assert (row.num_parameters, row.num_free_parameters) == (4, 2)
    assert row.stack[0].material == "unknown" and row.stack[0].interface == 0.0


STACK = [layer("air", 0.0), layer("film", 500.0, 6.5, "Cu"), layer("Material", 500.0, 1.0, "Ti"), layer("Si", 0.0, 2.07)]


def test_stack_properties(spark):
    s = F.col("stack")
    row = parsed(spark, {"object": {"sample": {"layers": STACK}}}).select(
        layers.ambient(s)["name"].alias("ambient"),
        layers.substrate(s)["name"].alias("substrate"),
        F.size(layers.films(s)).alias("films"),
        layers.total_thickness(s).alias("total"),
        layers.by_name(s, F.lit("FILM"))["material"].alias("named"),
        layers.main_composition(layers.above_substrate(s)).alias("main"),
        layers.description(s).alias("description"),
        layers.geometry(s).alias("geometry"),
        layers.generic_name_flags(s).alias("flags"),
        F.size(layers.view_for_sample(s)).alias("view"),
        layers.fit_layers(s)[3]["layer_number"].alias("number"),
    ).collect()[0]
    assert (row.ambient, row.substrate, row.films, row.total, row.named) == ("air", "Si", 2, 1000.0, "Cu")
    assert (row.main, row.description, row.geometry) == ("Cu", "Cu in air on Si", "back reflection")
    assert row.flags[0].key == "layer_1_name"
    assert [(f.key, f.value) for f in row.flags[1:]] == [("layer_2_name", "The name 'Material' tells nothing (SLD 1.00, 500.0 Å thick)")]
    assert (row.view, row.number) == (4, 4)


@pytest.mark.parametrize("index,first", [(None, "x0"), (1, "x1"), (2, None), (-1, None)])
def test_stack_choice(spark, index, first):
    data = model([[layer("x0", 1.0)], [layer("x1", 2.0)]])
    df = parsed(spark, data).select(layers.select_stack(F.col("stack"), F.col("datasets"), F.lit(index).cast("int")).alias("s"))
    stack = df.collect()[0].s
    assert (stack[0].name if stack else None) == first


def test_model_without_parts(spark):
    for data in ({}, {"object": {}}, {"object": {"models": []}}, {"object": {"sample": {"layers": []}, "models": None}}):
        row = parsed(spark, data).collect()[0]
        assert row.stack == [] and row.datasets == [] and row.num_experiments == 0 and not row.malformed


def test_software(spark):
    def software(**extra):
        row = parsed(spark, {"object": {}, **extra}).collect()[0]
        return row.software, row.software_version, row.schema_version

    assert software(libraries={"refl1d": {"version": "1"}, "bumps": {"version": "2"}}) == ("refl1d", "1", "unknown")
    assert software(libraries={"bumps": {"version": "2", "schema_version": "3"}}) == ("bumps", "2", "3")
    assert software(**{"$schema": "draft"}) == ("unknown", "unknown", "draft")
    assert software() == ("unknown", "unknown", "unknown")


def test_curve_warnings(spark):
    rows = [([0.001] * 12, [1.0] * 12), ([0.1, 0.2], [1.0]), ([], [])]
    df = spark.createDataFrame([(i, q, r) for i, (q, r) in enumerate(rows)], "i int, q array<double>, r array<double>")
    q, r = F.col("q"), F.col("r")
    got = df.select("i", curves.curve_warnings(q, r, r, r).alias("w"), *[c.alias(n) for c, n in zip(curves.q_range(q), "ab")]).orderBy("i").collect()
    assert got[0].w == ["All q are small: 0.0010 to 0.0010"]
    assert got[1].w == ["Columns differ in length: q 2, r 1, dr 1, dq 1", "A curve of only 2 points"]
    assert got[2].w == ["A curve of only 0 points"] and (got[2].a, got[2].b) == (0.0, 0.0)


def test_kinds_of_parameters(spark):
    """Numbers, value objects, references, texts: a quoted number is a text and counts as zero."""
    given = [
        ("5", 5.0), ("-1.5e2", -150.0), ("true", 1.0), ('"5"', 0.0), ('"x"', 0.0), ("null", 0.0), ("[1]", 0.0),
        ('{"value": 7}', 7.0), ('{"slot": {"value": 8}, "value": 7}', 8.0), ('{"a": 1}', 0.0),
        ('{"__class__": "Reference", "id": "r"}', 9.0), ('{"__class__": "Reference", "id": "z", "value": 3}', 3.0),
        ('{"__class__": "Other", "id": "r", "value": 4}', 4.0),
    ]
    head = '{"references": {"r": {"name": "n", "fixed": false, "std": 0.5, "value": 9}}, "object": {"sample": {"layers": ['
    layers_ = ", ".join('{"name": "l", "thickness": ' + text + "}" for text, _ in given)
    texts = spark.createDataFrame([("m", head + layers_ + ', {"name": "none"}]}}}', None)], "path string, content string, error_content string")
    (row,) = fit_model.parse(texts).select("stack").collect()
    assert [layer.thickness for layer in row.stack] == [value for _, value in given] + [0.0]
    assert [layer.thickness_std for layer in row.stack] == [0.5 if value == 9.0 else None for _, value in given] + [None]
