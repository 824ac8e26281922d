"""Run directories: single and several states (L2, L3)."""

import json

from conftest import collect, curve_text, layer, model
from pyspark.sql import functions as F

from measlake.plans import workflow
from measlake.plans.workflow import assemble_run_dirs
from measlake.sources import reduced_text, run_dirs

STACK = [layer("air", 0.0), layer("Cu", 500.0, 6.5), layer("Si", 0.0, 2.07)]
OTHER = [layer("air", 0.0), layer("Cu", 450.0, 6.4), layer("Si", 0.0, 2.07)]


def probe_of(n=12, scale=1.0, start=0.01, step=0.01):
    return [start + step * i for i in range(n)], [scale / (i + 1) for i in range(n)]


def frames(spark, files, curves):
    texts = spark.createDataFrame(
        [(p, c if isinstance(c, str) else json.dumps(c)) for p, c in files.items()],
        "path string, content string",
    )
    curve_texts = spark.createDataFrame(list(curves.items()), "path string, content string")
    return run_dirs.parse(texts), reduced_text.parse(curve_texts)


def run(spark, ingest, files, curves, **options):
    jobs, read = frames(spark, files, curves)
    return assemble_run_dirs(jobs, read, **ingest, **options)


CURVES = {f"/c/REFL_{i}.txt": curve_text(i, scale=4.0 ** (i - 1)) for i in (1, 2, 3)}
FINAL = {"final_chi2": 1.5, "state": {"best_chi2": 9, "states": [{"extra_description": "Resting at OCV, 0.3 M Na2SO4, pH 6.5"}]}}


def test_single_state_three_runs(spark, ingest):
    files = {
        "/w/a/run_info.json": {
            "data_files": [{"file": "/c/REFL_1.txt", "label": "x"}, "/c/REFL_2.txt", {"file": "/c/REFL_3.txt"}],
            "sample_description": "Cu on Si",
        },
        "/w/a/final_state.json": FINAL,
        "/w/a/problem.json": model([STACK, OTHER], [probe_of(scale=4.0), probe_of(scale=1.0)]),
        "/w/a/refl1d_output/z/None-err.json": {},
    }
    batch = run(spark, ingest, files, CURVES)
    runs, envs = collect(batch.reflectivity), collect(batch.environment)
    samples, fits = collect(batch.sample), collect(batch.reflectivity_model)
    assert len(runs) == 3 and len(envs) == len(samples) == len(fits) == 1
    env, sample, fit = (next(iter(x.values())) for x in (envs, samples, fits))
    assert {r["environment_id"] for r in runs.values()} == {env["id"]}
    assert {r["sample_id"] for r in runs.values()} == {sample["id"]}
    assert set(env["measurement_ids"]) == set(runs)
    assert env["control_mode"] == "open_circuit" and env["pH"] == 6.5
    assert env["ambient_medium"]["name"] == "air"
    assert sample["description"] == "Cu on Si"
    assert sample["environment_ids"] == [env["id"]] and sample["fit_ids"] == [fit["id"]]
    assert fit["measurement_ids"] == env["measurement_ids"]
    assert fit["chi_squared"] == 1.5 and fit["fit_strategy"] == "single_state_coref"
    # run 1 has scale 1 -> dataset 1, run 2 has scale 4 -> dataset 0, run 3 has scale 16 -> none
    assert [d["dataset_index"] for d in fit["datasets"]][:2] == [1, 0]
    assert fit["dataset_index"] == 1
    assert fit["layers"][1]["thickness"] == 450.0
    assert [d["run_number"] for d in fit["datasets"]] == ["1", "2", "3"]
    found = [(r.severity, r.field, r.message) for r in batch.issues.collect()]
    assert ("review", "fit_dataset_3", "dataset is a guess") in found
    assert any(m == "Dataset 2 of 2 is taken, the best match of the curve" for _, _, m in found)
    assert [r.status for r in batch.outcomes.collect()] == ["ok"]


def test_single_run_without_model(spark, ingest):
    files = {
        "/w/b/run_info.json": {"data_file": "/c/REFL_1.txt"},
        "/w/b/checkpoints/004_fitting.json": {"state": {"best_chi2": 0, "current_chi2": 3, "states": [{"extra_description": "Kept at -1 V"}]}},
    }
    batch = run(spark, ingest, files, CURVES)
    (row,) = batch.reflectivity.collect()
    (env,) = batch.environment.collect()
    assert row.sample_id is None and row.environment_id == env.id
    assert env.potential == -1.0 and env.potential_scale == "SHE"
    assert batch.sample.count() == batch.reflectivity_model.count() == 0
    assert row.measurement_geometry is None


def test_errors_stop_a_directory(spark, ingest):
    files = {
        "/w/none/problem.json": model([STACK]),
        "/w/empty/run_info.json": {},
        "/w/miss/run_info.json": {"data_files": ["/c/REFL_1.txt", "/c/gone.txt"]},
        "/w/state/run_info.json": {"states": [{"name": "s0", "data_files": ["/c/REFL_1.txt"]}, {"name": "s1", "data_files": []}]},
        "/w/state2/run_info.json": {"states": [{"name": "s0", "data_files": ["/c/zip.txt"]}]},
        "/w/bad/run_info.json": {"data_file": "/c/REFL_1.txt"},
        "/w/bad/problem.json": "{oops",
        "/w/two/run_info.json": {"data_files": ["/c/gone.txt", "/c/REFL_1.txt", "/c/zip.txt"]},
        "/w/cut/run_info.json": '{"data_file": "/c/REFL_1',
        "/w/cut/final_state.json": '{"final_chi2": 1.5',
        "/w/chi/run_info.json": {"data_file": "/c/REFL_1.txt"},
        "/w/chi/final_state.json": '{"final_chi2": 1.5',
        "/w/chi/checkpoints/004_fitting.json": {"state": {"best_chi2": 2.0}},
        "/w/good/run_info.json": {"data_file": "/c/REFL_1.txt"},
    }
    batch = run(spark, ingest, files, CURVES)
    errors = {}
    for r in batch.issues.filter("severity = 'error'").orderBy("job", "pos", "position").collect():
        errors.setdefault(r.job, []).append(r.message)
    assert errors == {
        "/w/none": ["/w/none has no run_info.json"],
        "/w/empty": ["/w/empty/run_info.json lists no data files"],
        "/w/miss": ["There is no file that run_info.json names: /c/gone.txt"],
        "/w/state": ["State 's1' lists no data files"],
        "/w/state2": ["State 's0': there is no file /c/zip.txt"],
        "/w/bad": ["Not a model that can be read: /w/bad/problem.json"],
        "/w/two": [f"There is no file that run_info.json names: /c/{n}.txt" for n in ("gone", "zip")],
        "/w/cut": ["/w/cut/run_info.json is not JSON", "/w/cut/final_state.json is not JSON"],
        "/w/chi": ["/w/chi/final_state.json is not JSON"],
    }
    assert batch.reflectivity.count() == 1
    assert {r.job: r.status for r in batch.outcomes.collect()}["/w/good"] == "ok"


def states_info(distinct=False, second_text=None):
    second = {"name": "H2O", "extra_description": "OCV in H2O", "data_files": [{"file": "/c/REFL_3.txt"}]}
    if second_text:
        second["sample_description"] = second_text
    info = {
        "sample_description": "Cu on Si",
        "states": [
            {"name": "D2O", "extra_description": "OCV, pH 6.5", "data_files": [{"file": "/c/REFL_1.txt"}, {"file": "/c/REFL_2.txt"}]},
            second,
        ],
    }
    if distinct:
        info["distinct_sample"] = True
    return info


def multi(spark, ingest, info, **options):
    files = {"/w/m/run_info.json": info, "/w/m/problem.json": model([STACK, OTHER, STACK]), "/w/m/final_state.json": FINAL}
    return run(spark, ingest, files, CURVES, **options)


def test_two_states_share_a_sample(spark, ingest):
    batch = multi(spark, ingest, states_info())
    runs, envs = collect(batch.reflectivity), collect(batch.environment)
    (sample,), (fit,) = batch.sample.collect(), batch.reflectivity_model.collect()
    assert len(runs) == 3
    assert sorted(len(e["measurement_ids"]) for e in envs.values()) == [1, 2]
    assert {r["sample_id"] for r in runs.values()} == {sample.id}
    assert set(sample.environment_ids) == set(envs) and sample.fit_ids == [fit.id]
    assert fit.fit_strategy == "multi_state_coref" and fit.sample_ids == [sample.id]
    # probes without curves: datasets follow the position
    assert [d.dataset_index for d in fit.datasets] == [0, 1, 2]
    assert fit.dataset_index is None
    for env in envs.values():
        for member in env["measurement_ids"]:
            assert runs[member]["environment_id"] == env["id"]


def test_distinct_samples(spark, ingest):
    batch = multi(spark, ingest, states_info(distinct=True))
    samples = collect(batch.sample)
    (fit,) = batch.reflectivity_model.collect()
    assert len(samples) == 2 and fit.sample_ids[0] == fit.sample_id
    assert set(fit.sample_ids) == set(samples)
    assert all(s["fit_ids"] == [fit.id] and len(s["environment_ids"]) == 1 for s in samples.values())
    assert all(s["description"] == "Cu on Si" for s in samples.values())


def test_own_sample_by_description(spark, ingest):
    batch = multi(spark, ingest, states_info(second_text="another film"))
    samples = {s["description"]: s for s in collect(batch.sample).values()}
    (fit,) = batch.reflectivity_model.collect()
    assert samples["another film"]["fit_ids"] is None
    assert samples["Cu on Si"]["fit_ids"] == [fit.id] and fit.sample_ids == [samples["Cu on Si"]["id"]]
    assert len(samples["another film"]["environment_ids"]) == 1


def test_existing_sample_is_linked(spark, ingest):
    batch = multi(spark, ingest, states_info(), sample_id="known")
    assert batch.sample.count() == 0
    assert {r.sample_id for r in batch.reflectivity.collect()} == {"known"}


def test_same_file_twice_gives_two_runs(spark, ingest):
    files = {"/w/t/run_info.json": {"data_files": ["/c/REFL_1.txt", "/c/REFL_1.txt"]}}
    batch = run(spark, ingest, files, CURVES)
    assert len({r.id for r in batch.reflectivity.collect()}) == 2


def test_fit_state_rules(spark):
    rows = [
        ('{"final_chi2": 2, "state": {"best_chi2": 1}}', '{"state": {"best_chi2": 7}}', 2.0),
        ('{"state": {"best_chi2": 0, "current_chi2": 4}}', None, 4.0),
        (None, '{"state": {"best_chi2": 7}}', 7.0),
        ('{}', '{"state": {"best_chi2": 7}}', None),
        (None, None, None),
    ]
    df = spark.createDataFrame(rows, "f string, c string, want double")
    got = df.select(
        "want",
        run_dirs.fit_state(F.from_json("f", run_dirs.STATE_SCHEMA), F.from_json("c", run_dirs.STATE_SCHEMA))["chi_squared"].alias("got"),
    ).collect()
    assert all(r.want == r.got for r in got)


def test_first_error_file_by_path(spark):
    files = [
        ("/w/x/refl1d_output/b/None-err.json", "B"),
        ("/w/x/refl1d_output/a/None-err.json", "A"),
        ("/w/x/other-err.json", "C"),
        ("/w/x/run_info.json", "{}"),
    ]
    df = spark.createDataFrame(files, "path string, content string")
    (row,) = run_dirs.bundle(df).collect()
    assert row.job == "/w/x" and row.error_content == "A"


def test_directory_of_many_files_is_spread(spark, ingest, monkeypatch):
    """Chunks only spread the work: ids, order and datasets stay the same."""
    content = {f"/c/REFL_{i}.txt": curve_text(i, scale=4.0 ** (i % 2)) for i in range(1, 24)}
    files = {
        "/w/big/run_info.json": {"data_files": list(content)},
        "/w/big/problem.json": model([STACK, OTHER], [probe_of(scale=4.0), probe_of(scale=1.0)]),
        "/w/small/run_info.json": {"data_file": "/c/REFL_3.txt"},
    }
    results = []
    for width in (1000, 5):
        monkeypatch.setattr(workflow, "RUNS_PER_CHUNK", width)
        batch = run(spark, ingest, files, content)
        results.append((collect(batch.reflectivity), collect(batch.reflectivity_model)))
    assert results[0] == results[1]
    runs, fits = results[0]
    (fit,) = fits.values()
    assert len(runs) == 24 and len(fit["measurement_ids"]) == 23
    assert [d["dataset_index"] for d in fit["datasets"]] == [0 if i % 2 else 1 for i in range(1, 24)]
    assert [d["run_number"] for d in fit["datasets"]] == [str(i) for i in range(1, 24)]
