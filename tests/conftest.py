import datetime
import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from measlake.session import local_session  # noqa: E402

WHEN = datetime.datetime(2026, 1, 2, 3, 4, 5)


@pytest.fixture(scope="session")
def spark():
    # Inputs are tiny: interpreted plans start faster than generated code. The
    # queries of test_queries.py cover generated code.
    interpreted = {
        "spark.sql.codegen.wholeStage": "false",
        "spark.sql.codegen.factoryMode": "NO_CODEGEN",
        "spark.default.parallelism": "2",
    }
    session = local_session(cores="4", shuffle_partitions=2, memory="6g", extra=interpreted)
    yield session
    session.stop()


@pytest.fixture
def ingest():
    return {"ingest_id": "i1", "ingest_time": F.lit(WHEN).cast("timestamp")}


def curve_text(run=1, n=12, proposal="IPTS-77", meta=None, scale=1.0, start=0.01, step=0.01):
    """A small curve file."""
    head = [f"# Experiment {proposal} Run {run}", "# Reduction 3.1", f"# Run title: title {run}"]
    head += ["# Run start time: 2024-05-06T07:08:09.123456789"]
    if meta is not None:
        head.append("# Meta:" + json.dumps(meta))
    head += ["# DataRun NormRun TwoTheta", f"# {run}  55  1.25  2.0", "# Q [1/Angstrom] R dR dQ"]
    rows = [f"  {start + step * i:.4f} {scale / (i + 1):.6f} 0.01 0.001" for i in range(n)]
    return "\n".join(head + rows) + "\n"


def layer(name, thick, rho=1.0, material=None):
    return {
        "name": name,
        "thickness": {"value": thick},
        "interface": {"value": 2.0},
        "material": {"name": material or name, "rho": {"value": rho}},
    }


def model(stacks, probes=None, **extra):
    """A model file with one experiment per stack."""
    probes = probes or [None] * len(stacks)
    models = []
    for stack, curve in zip(stacks, probes):
        entry = {"sample": {"layers": stack}}
        if curve is not None:
            entry["probe"] = {"Q": {"values": curve[0]}, "R": {"values": curve[1]}}
        models.append(entry)
    return {"$schema": "x", "references": {}, "object": {"name": "fit", "models": models}, **extra}


def collect(df, key="id"):
    return {row[key]: row.asDict(recursive=True) for row in df.collect()}
