"""Blocks of small partitions go to different shards."""

import numpy as np
from test_llm_vectors import by_query

from measlake.llm import ann
from measlake.llm.common import configure


def test_small_partitions_take_all_shards(spark, monkeypatch):
    configure(spark)
    draw = np.random.default_rng(9)
    rows = [(i, v) for i, v in enumerate(draw.standard_normal((80, 4)).tolist())]
    rows = spark.sparkContext.parallelize(rows, 8)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    held, kept = [], ann.kept
    monkeypatch.setattr(ann, "kept", lambda *args: held.append(kept(*args)) or held[-1])
    assert len(by_query(ann.nearest(df, 50, 5))) == 2
    places = held[0].select("shard", "block").distinct().collect()
    assert len(places) == 8 and len({p.shard for p in places}) == 8
