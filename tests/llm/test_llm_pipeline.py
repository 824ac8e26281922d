"""The corpus pipeline, stage by stage, against plain statements."""

import collections
import os
import zlib

import numpy as np
import plain
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from measlake.llm import quality
from measlake.llm.common import kept, table

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Rows of the documents and of every stage, each written and read again."""
    if not os.path.isdir(SF_DIR):
        pytest.skip("tables are not there")
    docs = table(spark, SF_DIR, "documents")
    found = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = kept(stage(spark, docs, SF_DIR), f"stage-{number}")
        found.append(docs)
    return found


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_stages_are_the_ones_named():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "simhash near-dedup", "secret scans", "source mixing", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_quality_stage_drops_what_it_rejects(spark, stages):
    scored = quality.digest(stages[0], table(spark, SF_DIR, "labels"))
    good = {r.doc_id for r in scored.collect() if r.predicted}
    assert stages[1].columns == COLUMNS
    assert plain.in_order(rows(stages[1])) == plain.in_order(
        r for r in rows(stages[0]) if r[0] in good
    )
    assert 0 < len(good) < stages[0].count()


def test_near_dedup_stage_keeps_one_of_each(stages):
    given = sorted(rows(stages[1]))
    roots = plain.linked([plain.fingerprint(r[1]) for r in given])
    # Rows are in the order of their ids, so a component's root is its smallest.
    wanted = [r for i, r in enumerate(given) if roots[i] == i]
    assert sorted(rows(stages[2])) == wanted


def test_secrets_stage_masks(stages):
    wanted = []
    for doc_id, text, lang, source, _ in rows(stages[2]):
        masked = plain.masked(text)
        wanted.append((doc_id, masked, lang, source, len(masked)))
    assert sorted(rows(stages[3])) == sorted(wanted)


def test_mixing_stage_draws_to_the_targets(stages):
    given = rows(stages[3])
    sizes = [(r[0], len(plain.words(r[1])), r[3]) for r in given]
    taken, target, _ = plain.mix(sizes)
    wanted = []
    for row, (_, size, _), words in zip(given, sizes, taken):
        while words > 0:
            cut = plain.first_words(row[1], words)
            wanted.append((row[0], cut, *row[2:4], row[4] if cut == row[1] else len(cut)))
            words -= size
    assert sorted(rows(stages[4])) == sorted(wanted)
    drawn = collections.Counter()
    for r in rows(stages[4]):
        drawn[r[3]] += len(plain.words(r[1]))
    assert all(abs(drawn[s] - target[s]) < 1 + 1e-6 for s in target)


def test_packing_stage_holds_every_token(stages):
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    wanted = collections.Counter()
    for r in rows(stages[4]):
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1]
        cuts = list(range(0, len(ids) // 2048 * 2048, 2048))
        cuts += range(len(ids) // 2048 * 2048, len(ids), 256)
        for a, b in zip(cuts, [*cuts[1:], len(ids)]):
            crc = zlib.crc32(np.array(ids[a:b], "<u4").tobytes())
            wanted[r[0], a, b - a, crc, len(ids)] += 1
    pieces = stages[5].collect()
    assert wanted == collections.Counter(
        (p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces
    )
    filled = collections.defaultdict(list)
    for p in pieces:
        filled[p.sequence_id].append((p.offset, p.length))
    for parts in filled.values():
        parts.sort()
        assert [p[0] for p in parts] == list(np.cumsum([0, *(p[1] for p in parts)])[:-1])
        assert sum(p[1] for p in parts) <= 2048


def test_run_applies_all_stages(spark, stages):
    def pieces(df):
        return collections.Counter((p.doc_id, p.start, p.length, p.ids_crc32) for p in df.collect())

    assert pieces(corpus_pipeline.run(spark, SF_DIR)) == pieces(stages[5])


def test_stages_bear_awkward_and_empty_tables(spark, tmp_path):
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    given = plain.documents(spark, plain.awkward_documents())
    for docs in (given, given.limit(0)):
        columns, empty = docs.columns, docs.limit(1).count() == 0
        for name, stage in corpus_pipeline.STAGES:
            docs = kept(stage(spark, docs, str(tmp_path)), "awkward")
            assert docs.columns == columns or name == "packing"
        assert (docs.count() == 0) == empty
