"""Single measurements and manifests (L1, L4), sinks (K1-K9) and store."""

import json
import os

from conftest import collect, curve_text, layer, model
from pyspark.sql import functions as F

from measlake import store
from measlake.plans.assemble import assemble, assemble_manifests
from measlake.schemas import TABLES, conform, detect_table
from measlake.sinks import export, json_mirror, tables
from measlake.plans.workflow import assemble_run_dirs
from measlake.sources import files, fit_model, manifest, reduced_text, run_dirs, run_records

STACK = [layer("air", 0.0), layer("film", 500.0, 6.5, "Cu"), layer("Si", 0.0, 2.07)]


def texts(spark, content):
    rows = [(p, c if isinstance(c, str) else json.dumps(c)) for p, c in content.items()]
    return spark.createDataFrame(rows, "path string, content string")


def curves_of(spark, content):
    return reduced_text.parse(texts(spark, content))


def models_of(spark, content):
    return fit_model.parse(texts(spark, content).withColumn("error_content", F.lit(None).cast("string")))


CURVES = {f"/c/REF_L/REFL_20000{i}_x.txt": curve_text(200000 + i) for i in range(3)}
MODEL = {"/m/model.json": model([STACK], libraries={"refl1d": {"version": "1.0", "schema_version": "2"}})}


def write_records(spark, base):
    meta = [
        ("REF_L", 200000, "r0", "from metadata", "2024-01-15T10:30:00Z", "IPTS-9", "/raw/0.h5"),
        ("REF_L", 200000, "r0b", "second row", "2024-01-16T10:30:00Z", "IPTS-10", "/raw/1.h5"),
        ("BL-77", 200001, "r1", "", "not a time", None, None),
    ]
    schema = "instrument_id string, run_number bigint, run_id string, title string, start_time string, experiment_identifier string, source_path string"
    spark.createDataFrame(meta, schema).coalesce(1).write.parquet(base + "/metadata.parquet.d")
    logs = [
        ("REF_L", 200000, "SampleTemp", 0.0, 1.0),
        ("REF_L", 200000, "Pressure", 5.0, 5.0),
        ("BL-77", 200001, "Temp", None, 290.0),
        ("BL-77", 200001, "Temperature", float("nan"), None),
        ("BL-77", 200001, "Temperature", 300.0, 300.0),
        ("BL-77", 200001, "Pressure", float("nan"), 0.0),
        ("BL-77", 200001, None, 1.0, 1.0),
    ]
    schema = "instrument_id string, run_number bigint, log_name string, average_value double, value_numeric double"
    spark.createDataFrame(logs, schema).coalesce(1).write.parquet(base + "/daslogs.parquet.d")


def move_part(base, kind):
    """Spark writes folders; the readers look at file names."""
    folder = f"{base}/{kind}.parquet.d"
    part = next(f for f in os.listdir(folder) if f.endswith(".parquet"))
    with open(f"{folder}/{part}", "rb") as src, open(f"{base}/run_{kind}.parquet", "wb") as out:
        out.write(src.read())


def records(spark, tmp_path):
    staging, base = str(tmp_path / "staging"), str(tmp_path / "records")
    os.makedirs(base)
    write_records(spark, staging)
    for kind in ("metadata", "daslogs"):
        move_part(staging, kind)
        with open(f"{staging}/run_{kind}.parquet", "rb") as src, open(f"{base}/run_{kind}.parquet", "wb") as out:
            out.write(src.read())
    return base


def test_records_join_by_run(spark, ingest, tmp_path):
    base = records(spark, tmp_path)
    rows = [(f"j{i}", path, base if i < 2 else None) for i, path in enumerate(CURVES)]
    jobs = manifest.single_jobs(spark.createDataFrame(rows, "job string, reduced string, parquet string"))
    batch = assemble(
        jobs,
        curves_of(spark, CURVES),
        models_of(spark, MODEL),
        run_records.read_metadata(spark, base),
        run_records.read_logs(spark, base),
        **ingest,
    )
    runs = collect(batch.reflectivity, "run_number")
    first = runs["200000"]
    assert first["run_title"] == "from metadata" and first["proposal_number"] == "IPTS-9"
    assert first["run_start"].isoformat() == "2024-01-15T10:30:00"
    assert first["raw_file_path"] == "/raw/0.h5" and first["technique_description"]
    second = runs["200001"]
    assert second["proposal_number"] == "Unknown" and second["run_title"] == "title 200001"
    assert second["instrument_name"] == "BL-77" and second["technique_description"] is None
    third = runs["200002"]
    assert third["proposal_number"] == "IPTS-77" and third["environment_id"] is None
    assert third["run_start"].isoformat() == "2024-05-06T07:08:09.123456"
    assert third["instrument_name"] == "REF_L"
    envs = collect(batch.environment)
    assert envs[first["environment_id"]]["temperature"] is None  # 0.0 means not connected
    other = envs[second["environment_id"]]
    # first record of Temperature has no value at all, so Temp is next
    assert other["temperature"] == 290.0 and other["pressure"] == 0.0
    assert other["description"] == "Sample cell"
    notes = {(r.job, r.message) for r in batch.issues.collect()}
    assert ("j1", "Start time cannot be read: not a time") in notes
    assert ("j0", "No temperature in the logs (sensors of REF_L)") in notes


def test_run_without_number_takes_the_first_record(spark, ingest, tmp_path):
    base = records(spark, tmp_path)
    content = {"/c/curve.txt": curve_text(5)}
    jobs = manifest.single_jobs(spark.createDataFrame([("j", "/c/curve.txt", base)], "job string, reduced string, parquet string"))
    batch = assemble(jobs, curves_of(spark, content), models_of(spark, MODEL), run_records.read_metadata(spark, base), run_records.read_logs(spark, base), **ingest)
    (row,) = batch.reflectivity.collect()
    assert row.run_number == "200000"


def test_meta_block_and_overrides(spark, ingest):
    meta = {"experiment": "IPTS-5", "run_number": 42, "run_title": "from meta", "start_time": "2026-03-30T09:52:00.244352667"}
    content = {"/c/REFL_1.txt": curve_text(7, meta=meta)}
    rows = [("j", "/c/REFL_1.txt", "/raw/x.nxs.h5", "known-sample", "cell at -1 V")]
    jobs = manifest.single_jobs(spark.createDataFrame(rows, "job string, reduced string, nexus_file string, sample_id string, environment string"))
    batch = assemble(jobs, curves_of(spark, content), models_of(spark, MODEL), **ingest)
    (row,) = batch.reflectivity.collect()
    assert (row.proposal_number, row.run_number, row.run_title) == ("IPTS-5", "42", "from meta")
    assert row.run_start.isoformat() == "2026-03-30T09:52:00.244352"
    assert row.raw_file_path == "/raw/x.nxs.h5" and row.sample_id == "known-sample"
    (env,) = batch.environment.collect()
    # text is not parsed in plain assembly
    assert env.description == "cell at -1 V" and env.potential is None
    assert env.measurement_ids == [row.id]
    assert batch.sample.count() == 0


def manifest_rows(spark, docs):
    return manifest.parse(texts(spark, docs))


def batch_doc(**changes):
    doc = {
        "title": "history",
        "output": "/out",
        "sample": {"description": "Cu film", "model": "/m/model.json", "model_dataset_index": 1},
        "measurements": [
            {"name": "first", "reduced": "/c/REF_L/REFL_200000_x.txt", "environment": "one"},
            {"reduced": "/c/REF_L/REFL_200001_x.txt", "environment": "two"},
            {"reduced": "/c/REF_L/REFL_200002_x.txt"},
        ],
    }
    doc.update(changes)
    return doc


def run_manifests(spark, ingest, docs, **options):
    return assemble_manifests(
        manifest_rows(spark, docs), curves_of(spark, CURVES), models_of(spark, MODEL), **ingest, **options
    )


def test_manifest_shares_one_sample(spark, ingest):
    batch = run_manifests(spark, ingest, {"/b/1.json": batch_doc()})
    runs, envs = collect(batch.reflectivity), collect(batch.environment)
    (sample,) = batch.sample.collect()
    fits = collect(batch.reflectivity_model)
    assert len(runs) == 3 and len(envs) == 2 and len(fits) == 3
    assert sample.description == "Cu film" and sample.main_composition == "Cu"
    assert [envs[e]["description"] for e in sample.environment_ids] == ["one", "two"]
    assert set(sample.fit_ids) == set(fits)
    assert {r["sample_id"] for r in runs.values()} == {sample.id}
    for env in envs.values():
        (member,) = env["measurement_ids"]
        assert runs[member]["environment_id"] == env["id"]
    for fit in fits.values():
        assert fit["sample_id"] == sample.id and fit["sample_ids"] == [sample.id]
        assert fit["dataset_index"] == 0 and fit["fit_strategy"] == "single"
        assert fit["software"] == "refl1d" and fit["software_version"] == "1.0"


def test_measurements_without_a_first_model_own_their_samples(spark, ingest):
    doc = batch_doc(sample={})
    doc["measurements"][1]["model"] = "/m/model.json"
    doc["measurements"][2]["model"] = "/m/model.json"
    batch = run_manifests(spark, ingest, {"/b/2.json": doc})
    samples = collect(batch.sample)
    assert len(samples) == 2
    linked = [r.sample_id for r in batch.reflectivity.collect()]
    assert linked.count(None) == 1 and set(linked) - {None} == set(samples)


def test_bad_manifests_are_left_out(spark, ingest):
    docs = {
        "/b/ok.json": batch_doc(),
        "/b/no_output.json": batch_doc(output=""),
        "/b/none.json": batch_doc(measurements=[]),
        "/b/index.json": batch_doc(measurements=[{"reduced": "/c/REF_L/REFL_200000_x.txt", "model_dataset_index": 0}]),
        "/b/cut.json": '{"output": "/o", "measurements": [',
        "/b/gone.json": batch_doc(measurements=[{"name": "m", "reduced": "/c/gone.txt", "model": "/m/gone.json"}]),
    }
    existing = spark.createDataFrame([(p,) for p in [*CURVES, *MODEL]], "path string")
    batch = run_manifests(spark, ingest, docs, existing=existing)
    errors = {}
    for r in batch.rejected.orderBy("job", "pos", "rank").collect():
        errors.setdefault(r.job, []).append(r.message)
    assert errors == {
        "/b/no_output.json": ["No output folder is given"],
        "/b/none.json": ["There are no measurements"],
        "/b/cut.json": ["The manifest is not JSON"],
        "/b/index.json": ["Measurement 'Measurement 1': the dataset index counts from 1"],
        "/b/gone.json": ["Measurement 'm': there is no curve /c/gone.txt", "Measurement 'm': there is no model /m/gone.json"],
    }
    assert batch.reflectivity.count() == 3


def test_ids_do_not_change_between_actions(spark, ingest):
    batch = run_manifests(spark, ingest, {"/b/1.json": batch_doc()})
    again = run_manifests(spark, ingest, {"/b/1.json": batch_doc()})
    assert set(collect(batch.reflectivity)) == set(collect(again.reflectivity.repartition(5)))
    other = run_manifests(spark, {**ingest, "ingest_id": "i2"}, {"/b/1.json": batch_doc()})
    assert not set(collect(batch.reflectivity)) & set(collect(other.reflectivity))


def test_tables_round_trip(spark, ingest, tmp_path):
    batch = run_manifests(spark, ingest, {"/b/1.json": batch_doc()})
    base = str(tmp_path / "lake")
    paths = tables.write_batch(batch, base)
    assert set(paths) == {*TABLES, "issues", "outcomes", "rejected"}
    assert os.path.isdir(f"{base}/reflectivity/facility=SNS/year=2024")
    for name, df in batch.tables().items():
        back = tables.read_table(spark, base, name)
        declared = TABLES[name]
        assert back.schema.simpleString() == df.schema.simpleString() == declared.simpleString()
        assert [f.metadata for f in back.schema] == [f.metadata for f in declared]
        assert collect(back) == collect(df)
    assert tables.read_table(spark, base, "fit").count() == 3
    assert tables.read_table(spark, base, "reflectivity", years=[2023]).count() == 0
    json_mirror.write_batch_json(batch, base + "_json")
    for name, df in batch.tables().items():
        assert collect(json_mirror.read_json(spark, base + "_json", name)) == collect(df)


def test_conform_and_detect(spark):
    df = spark.createDataFrame([("1", 2)], "id string, surplus int")
    out = conform(df, "sample")
    assert out.columns == TABLES["sample"].names and out.collect()[0].id == "1"
    for name, schema in TABLES.items():
        assert detect_table(spark.createDataFrame([], schema)) == name


def test_export_payloads(spark, ingest):
    batch = run_manifests(spark, ingest, {"/b/1.json": batch_doc()})
    row = export.reflectivity_payload(batch.reflectivity).orderBy("run_number").first()
    assert row.technique == "Reflectivity" and row.instrument == "REF_L"
    assert row.run_start == "2024-05-06T07:08:09.123456+00:00" and row.reduction_time is None
    assert len(row.q_1_angstrom) == 12
    docs = export.environment_payload(batch.reflectivity, batch.environment).collect()
    assert sorted(len(d.measurements_ids) for d in docs) == [1, 1]
    assert export.sample_payload(batch.sample).count() == 2


def test_store_lookups(spark, ingest):
    batch = run_manifests(spark, ingest, {"/b/1.json": batch_doc()})
    runs, fits = batch.reflectivity, batch.reflectivity_model
    (sample,) = batch.sample.collect()
    assert store.runs_of_sample(runs, sample.id).count() == 3
    one = runs.filter("environment_id is not null").first()
    assert store.runs_of_state(runs, sample.id, one.environment_id).count() == 1
    assert store.states(runs).count() == 3
    found = store.fits_for_runs(fits, runs.filter(F.col("id") == one.id)).collect()
    assert [f.measurement_ids for f in found] == [[one.id]]
    assert store.runs_in_fits(fits, runs).count() == 3
    assert store.fits_for_samples(batch.sample, fits).count() == 3
    assert store.fitted_layers(fits).count() == 9


def test_run_directory_on_disk(spark, ingest, tmp_path):
    run = tmp_path / "w" / "230539"
    (run / "refl1d_output" / "fit").mkdir(parents=True)
    curve = tmp_path / "REFL_5_x.txt"
    curve.write_text(curve_text(5))
    (run / "run_info.json").write_text(json.dumps({"data_file": str(curve)}, indent=2))
    (run / "problem.json").write_text(json.dumps(model([STACK]), indent=2))
    (run / "refl1d_output" / "fit" / "None-err.json").write_text("{}")
    batch = assemble_run_dirs(run_dirs.read(spark, str(tmp_path / "w")), reduced_text.read(spark, str(curve)), **ingest)
    (row,), (fit,) = batch.reflectivity.collect(), batch.reflectivity_model.collect()
    assert row.run_number == "5" and fit.measurement_ids == [row.id] and row.sample_id == fit.sample_id
    assert fit.model_file_path == str(run / "problem.json") and len(fit.layers) == 3


def test_files_are_read_from_disk(spark, ingest, tmp_path):
    folder = tmp_path / "REF_L a%20b"
    folder.mkdir()
    path = folder / "REFL_200000 1.txt"
    path.write_text(curve_text(200000))
    data = model([STACK], references={"t": {"name": "th", "fixed": False, "value": 3}})
    data["object"]["models"][0]["sample"]["layers"][1]["thickness"] = {"__class__": "Reference", "id": "t"}
    (folder / "model.json").write_text(json.dumps(data, indent=1))
    (folder / "model-err.json").write_text('{"th":\n{"std": 0.25}}')
    got = reduced_text.read(spark, str(path))
    (row,) = got.collect()
    assert row.path == str(path) and len(row.q) == 12 and row.run_number == 200000
    (read,) = fit_model.read(spark, str(folder)).collect()
    film = read.datasets[0].layers[1]
    assert read.path == str(folder / "model.json") and (film.thickness, film.thickness_std) == (3.0, 0.25)
    listed = files.catalog(spark, [str(folder)])
    assert {r.path for r in listed.collect()} == {str(p) for p in folder.iterdir()}


def test_no_id_dangles_when_an_input_is_bad(spark, ingest):
    """Jobs with a bad input anywhere are left out as a whole, also without a list of files."""
    curves = {p: t for p, t in CURVES.items()}
    models = {**MODEL, "/m/bad.json": "{oops"}
    docs = {"/b/ok.json": batch_doc()}
    for name, place, field, value in (
        ("first_model", 0, "model", "/m/bad.json"),
        ("later_model", 1, "model", "/m/bad.json"),
        ("no_model", 2, "model", "/m/none.json"),
        ("no_curve", 2, "reduced", "/c/none.txt"),
    ):
        doc = batch_doc()
        doc["measurements"][place][field] = value
        docs[f"/b/{name}.json"] = doc
    batch = assemble_manifests(
        manifest_rows(spark, docs), curves_of(spark, curves), models_of(spark, models), **ingest
    )
    messages = {r.job: r.message for r in batch.rejected.collect()}
    assert messages == {
        "/b/first_model.json": "Not a model that can be read: /m/bad.json",
        "/b/later_model.json": "Not a model that can be read: /m/bad.json",
        "/b/no_model.json": "There is no file /m/none.json",
        "/b/no_curve.json": "There is no file /c/none.txt",
    }
    tables = {name: collect(df) for name, df in batch.tables().items()}
    assert len(tables["reflectivity"]) == 3
    named = {
        "sample": [r["sample_id"] for n in ("reflectivity", "reflectivity_model") for r in tables[n].values()],
        "environment": [r["environment_id"] for r in tables["reflectivity"].values()]
        + [e for r in tables["sample"].values() for e in r["environment_ids"]],
        "reflectivity_model": [f for r in tables["sample"].values() for f in r["fit_ids"]],
        "reflectivity": [m for n in ("environment", "reflectivity_model") for r in tables[n].values() for m in r["measurement_ids"]],
    }
    for name, ids in named.items():
        assert ids and {i for i in ids if i is not None} <= set(tables[name])


def test_a_manifest_may_name_a_folder(spark, ingest):
    docs = {"/b/1.json": batch_doc(), "/b/2.json": batch_doc(), "/b/3.json": batch_doc()}
    docs["/b/1.json"]["measurements"][0]["parquet"] = "/p/run/"
    docs["/b/2.json"]["measurements"][0]["parquet"] = "/p"
    docs["/b/3.json"]["measurements"][0]["parquet"] = "/p/ru"
    files = [*CURVES, *MODEL, "/p/run/x_metadata.parquet"]
    existing = spark.createDataFrame([(p,) for p in files], "path string")
    batch = run_manifests(spark, ingest, docs, existing=existing)
    assert [(r.job, r.message) for r in batch.rejected.collect()] == [
        ("/b/3.json", "Measurement 'first': there is no folder /p/ru")
    ]


def test_an_empty_batch_can_be_written_and_read(spark, ingest, tmp_path):
    batch = run_manifests(spark, ingest, {"/b/1.json": batch_doc(output="")})
    paths = tables.write_batch(batch, str(tmp_path / "lake"), json_base=str(tmp_path / "json"))
    for name in batch.tables():
        assert tables.read_table(spark, str(tmp_path / "lake"), name).collect() == []
    assert spark.read.parquet(paths["rejected"]).count() == 1
    assert {"issues", "outcomes"} <= set(paths)


def test_shared_parents_carry_no_probes_or_model_texts(spark, ingest):
    batch = run_manifests(spark, ingest, {"/b/1.json": batch_doc()})
    for df in batch.parents.values():
        names = df.schema.simpleString()
        assert not any(part in names for part in ("probe", "knots", "model_json"))
