"""Operators on documents against plain statements of what they compute."""

import collections
import hashlib
import os
import zlib

import duckdb
import numpy as np
import plain
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from measlake.llm import (
    licenses,
    mixing,
    packing,
    quality,
    queries,
    repeats,
    secrets,
    sharding,
    simhash,
)
from measlake.llm.common import configure
from measlake.llm.tokens import Encoder
from measlake.llm.words import Words

TOKENIZER = str(public_tokenizers.path("word_bpe_49k.json"))
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    configure(spark)
    return plain.documents(spark, plain.awkward_documents())


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def given():
    if not os.path.isdir(SF_DIR):
        pytest.skip("tables are not there")
    return duckdb.sql(f"SELECT doc_id, text, source FROM '{SF_DIR}/documents.parquet'").fetchall()


def tuples(df, *columns):
    return plain.in_order(tuple(r) for r in df.select(*columns).collect())


# Packing


def check_packing(rows, texts, capacity=2048):
    """Every id in one piece, sequences within the capacity and without gaps; returns padding."""
    tokenizer = Tokenizer.from_file(TOKENIZER)
    wanted = collections.Counter()
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        wanted[doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    pieces = collections.defaultdict(list)
    filled = collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id, r.doc_tokens].append((r.start, r.length, bytes(r.ids)))
        filled[r.sequence_id].append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length > 0
    found = collections.Counter()
    for (doc_id, total), parts in pieces.items():
        # Repeated rows have equal pieces, each as often.
        copies = sum(1 for p in parts if p[0] == 0)
        parts = sorted(parts)
        one = parts[::copies]
        assert sorted(one * copies) == parts
        assert [p[0] for p in one] == list(np.cumsum([0, *(p[1] for p in one)])[:-1])
        found[doc_id, total, zlib.crc32(b"".join(p[2] for p in one))] += copies
    for parts in filled.values():
        parts.sort()
        assert [p[0] for p in parts] == list(np.cumsum([0, *(p[1] for p in parts)])[:-1])
        assert parts[-1][0] + parts[-1][1] <= capacity
    assert found == wanted
    used = sum(r.length for r in rows)
    return 1 - used / (capacity * len(filled))


def test_packing_round_trip(docs, nothing):
    rows = packing.pack(docs, TOKENIZER).collect()
    check_packing(rows, [(r[0], r[1]) for r in plain.awkward_documents()])
    small = packing.pack(docs, TOKENIZER, capacity=64, group=512).collect()
    check_packing(small, [(r[0], r[1]) for r in plain.awkward_documents()], capacity=64)
    assert packing.pack(nothing, TOKENIZER).collect() == []


def test_packing_query(spark, given):
    rows = packing.pack(queries.table(spark, SF_DIR, "documents"), TOKENIZER).collect()
    assert check_packing(rows, [(d, t) for d, t, _ in given]) < 0.01
    digest = queries.QUERIES["op1_packing"](spark, SF_DIR).collect()
    assert sorted((r.doc_id, r.start, zlib.crc32(r.ids)) for r in rows) == sorted(
        (r.doc_id, r.start, r.ids_crc32) for r in digest
    )


def test_differencing_is_even():
    sizes = np.random.default_rng(0).integers(1, 257, 3000)
    window, offset, count = packing.windows_of(sizes, 2048)
    loads = np.bincount(window, weights=sizes, minlength=count)
    assert loads.max() <= 2048 and loads.max() - loads.min() < 64
    assert count <= -(-sizes.sum() // 2048) + 2
    assert packing.windows_of(np.array([2048, 2047, 2]), 2048)[2] == 3


def test_words_encode_alone_as_in_texts():
    texts = [t or "" for _, t, *_ in plain.awkward_documents()]
    texts += ["''s 're'll x'd don't 12a3", "ÀÉß÷×ÿ\x85y", "a\x1fb\x0bc"]
    whole = Tokenizer.from_file(TOKENIZER)
    wanted = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    encoder = Encoder(TOKENIZER)
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == wanted


# Secrets


def secret_row(doc_id, text):
    found = plain.secrets(text)
    joined = ",".join(f"{kind}:{start}:{end}" for start, kind, end in found)
    kinds = [kind for _, kind, _ in found]
    counts = [kinds.count(k) for k in ("assign", "access", "hex")]
    return (doc_id, *counts, hashlib.sha256(joined.encode()).hexdigest(), joined)


SECRET_COLUMNS = "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"


def test_secrets(docs, nothing):
    found = secrets.digest(secrets.find_secrets(docs))
    wanted = [secret_row(r[0], r[1]) for r in plain.awkward_documents()]
    assert tuples(found, *SECRET_COLUMNS) == plain.in_order(wanted)
    assert sum(r[1] + r[2] + r[3] for r in wanted) >= 5
    assert secrets.digest(secrets.find_secrets(nothing)).collect() == []


def test_secrets_query(spark, given):
    found = queries.QUERIES["op2_secret_scans"](spark, SF_DIR)
    wanted = [secret_row(d, t) for d, t, _ in given]
    assert tuples(found, *SECRET_COLUMNS) == plain.in_order(wanted)


@pytest.mark.parametrize("lane,few", [(16, 1), (64, 1000), (2048, 48)])
def test_automaton_finds_what_the_rules_do(monkeypatch, lane, few):
    monkeypatch.setattr(secrets, "LANE", lane)
    monkeypatch.setattr(secrets, "FEW_LANES", few)
    monkeypatch.setattr(secrets, "SLICE", 500)
    parts = ["token", "=", ":", " ", '"', "'", "AKIA", "A9", "abcdef0123", "PassWD", "api_key", "\n", "é", ","]
    draw = np.random.default_rng(lane)
    texts = ["".join(draw.choice(parts, draw.integers(0, 60))) for _ in range(300)]
    automaton = secrets.compiled(secrets.RULES)
    kinds = [rule.kind for rule in secrets.RULES]
    found = secrets.spans_of(automaton, secrets.RULES, [t.encode() for t in texts])
    assert [[(s, kinds[i], e) for s, i, e in f] for f in found] == [plain.secrets(t) for t in texts]


def test_masked_documents(docs, nothing):
    masked = secrets.mask_secrets(docs)
    assert masked.columns == docs.columns
    wanted = [(r[0], plain.masked(r[1])) for r in plain.awkward_documents()]
    assert tuples(masked, "doc_id", "text") == plain.in_order(wanted)
    assert secrets.mask_secrets(nothing).collect() == []


# Quality


def test_word_vectors_by_counting(spark):
    configure(spark)
    rows = [(1, "b a, b c"), (2, None), (3, ""), (4, "a")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    vectors, often = quality.word_vectors(table)
    places, signs = quality.index_vectors()
    total = np.zeros((quality.BUCKETS, quality.DIMENSIONS))
    count = np.zeros(quality.BUCKETS)
    for text in [b"b a, b c", b"a"]:
        own = quality.Buckets()([text])[0].tolist()
        for i, a in enumerate(own):
            count[a] += 1
            for j in range(max(0, i - quality.WINDOW), min(len(own), i + quality.WINDOW + 1)):
                if j != i:
                    np.add.at(total[a], places[own[j]], signs[own[j]])
    lengths = np.linalg.norm(total, axis=1, keepdims=True)
    assert np.allclose(vectors, total / np.where(lengths > 0, lengths, 1), atol=1e-6)
    assert (often == count).all() and often.sum() == 6


def test_words_hash_alike_wherever_they_stand(monkeypatch):
    texts = [b"ab cd ab", b"", b"cd", b"x" * 50 + b" ab"]
    hashes, firsts = Words(quality.KINDS)(texts)
    assert firsts.tolist() == [0, 3, 3, 4, 6]
    assert hashes[0] == hashes[2] == hashes[5] and hashes[1] == hashes[3] != hashes[0]
    monkeypatch.setattr("measlake.llm.words.SLICE", 60)
    again, places = Words(quality.KINDS)(texts)
    assert (again == hashes).all() and (places == firsts).all()


def test_quality_learns(spark, docs):
    configure(spark)
    good = [(i, plain.prose(i, 40)) for i in range(200)]
    bad = [(i, " | ".join(plain.prose(i, 30).split()).upper()) for i in range(200, 260)]
    table = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, int(i < 200)) for i in range(260)] + [(None, 1), (5, None), (10**9, 0)],
        "doc_id long, quality int",
    )
    rows = quality.digest(table, labels).collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(260) if zlib.crc32(str(i).encode()) % 5 == 0}
    right = [r.predicted == int(r.doc_id < 200) for r in held]
    assert sum(right) / len(right) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_quality_of_awkward_documents(spark, docs, nothing):
    labels = spark.createDataFrame([(15, 1), (18, 0)], "doc_id long, quality int")
    rows = quality.digest(docs, labels).collect()
    assert len(rows) == len(plain.awkward_documents())
    assert len({r.score for r in rows}) == 1  # too few labels for more than their share
    many = spark.createDataFrame([(3 * i, i % 2) for i in range(20)], "doc_id long, quality int")
    rows = quality.digest(docs, many).collect()
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 27}) == 1
    assert quality.digest(nothing, labels).collect() == []
    assert {r.score for r in quality.digest(docs, labels.limit(0)).collect()} == {0.5}
    kept = quality.good_documents(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == len(plain.awkward_documents())


def test_quality_query_on_held_out_labels(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("tables are not there")
    larger = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op3_quality_classifier"](spark, larger).collect()
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{larger}/labels.parquet'").fetchall())
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) / len(held) > 0.95


# Mixing


def test_mixing(docs, nothing):
    rows = [(r[0], len(plain.words(r[1])), r[3]) for r in plain.awkward_documents()]
    taken, target, sizes = plain.mix(rows)
    wanted = [
        (d, n, sizes[s], round(target[s], 6), t) for (d, n, s), t in zip(rows, taken)
    ]
    sized = docs.withColumn("size", mixing.words())
    found = mixing.mix(sized)
    got = [
        (r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in found.collect()
    ]
    assert plain.in_order(got) == plain.in_order(wanted)
    assert mixing.mix(nothing.withColumn("size", mixing.words())).collect() == []
    # A single source stops at what there is: its share is all words.
    one = mixing.mix(sized.where("source = 's1'")).collect()
    assert all(r.taken == r.size for r in one)


def test_mixing_splits_sources_into_ranges(docs, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 1)
    rows = [(r[0], len(plain.words(r[1])), r[3]) for r in plain.awkward_documents()]
    taken = plain.mix(rows)[0]
    found = mixing.mix(docs.withColumn("size", mixing.words()))
    wanted = plain.in_order((d, n, t) for (d, n, _), t in zip(rows, taken))
    assert tuples(found, "doc_id", "size", "taken") == wanted


def test_mixed_documents(docs, nothing):
    given = plain.awkward_documents()
    rows = [(r[0], len(plain.words(r[1])), r[3]) for r in given]
    wanted = []
    for row, (_, size, _), taken in zip(given, rows, plain.mix(rows)[0]):
        while taken > 0:
            wanted.append((row[0], plain.first_words(row[1], taken)))
            taken -= size
    found = mixing.mixed_documents(docs)
    assert found.columns == docs.columns
    assert tuples(found, "doc_id", "text") == plain.in_order(wanted)
    assert all(r.n_chars == len(r.text) for r in found.collect())
    assert mixing.mixed_documents(nothing).collect() == []


# Repeats


REPEAT_COLUMNS = "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"


@pytest.mark.parametrize("chunk,bucket", [(repeats.CHUNK, repeats.BUCKET), (20_000, 500)])
def test_repeats(docs, nothing, monkeypatch, chunk, bucket):
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    monkeypatch.setattr(repeats, "BUCKET", bucket)
    monkeypatch.setattr(repeats, "SLICE", 1000)
    found = repeats.digest(repeats.cut_repeats(docs))
    wanted = plain.repeats(plain.awkward_documents())
    assert tuples(found, *REPEAT_COLUMNS) == plain.in_order(wanted)
    assert repeats.cut_repeats(nothing).collect() == []


def test_repeats_among_few_letters(spark, monkeypatch):
    """Many maximal repeats within each other, over texts of two letters with zeros between."""
    configure(spark)
    monkeypatch.setattr(repeats, "CHUNK", 600)
    monkeypatch.setattr(repeats, "BUCKET", 30)
    draw = np.random.default_rng(1)
    parts = ["".join(draw.choice(list("ab\0"), 45)) for _ in range(6)]
    rows = [(i, "".join(draw.choice(parts, draw.integers(0, 8)))) for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = repeats.digest(repeats.cut_repeats(table))
    assert tuples(found, *REPEAT_COLUMNS) == plain.in_order(plain.repeats(rows))


def test_repeats_query(spark, given):
    found = queries.QUERIES["op7_suffix_array_dedup"](spark, SF_DIR)
    assert tuples(found, *REPEAT_COLUMNS) == plain.in_order(plain.repeats(given))


# SimHash


def simhash_rows(rows):
    prints = [plain.fingerprint(r[1]) for r in rows]
    roots = plain.linked(prints)
    smallest = {}
    for r, root in zip(rows, roots):
        ids = [x for x in (r[0], smallest.get(root)) if x is not None]
        smallest[root] = min(ids, default=None)
    return [
        (r[0], f"{p:016x}", smallest[root]) for r, p, root in zip(rows, prints, roots)
    ], roots


def test_simhash(docs, nothing):
    rows = plain.awkward_documents()
    found = simhash.near_duplicates(docs)
    wanted, roots = simhash_rows(rows)
    assert tuples(found, "doc_id", "fingerprint", "component_id") == plain.in_order(wanted)
    assert simhash.near_duplicates(nothing).collect() == []
    stay = simhash.one_of_each(docs)
    assert stay.columns == docs.columns
    assert stay.count() == len(set(roots))
    first = {component for _, _, component in wanted}
    assert {r.doc_id for r in stay.collect()} == first
    assert simhash.one_of_each(nothing).collect() == []


def test_simhash_query(spark, given):
    found = queries.QUERIES["op8_simhash_near_dedup"](spark, SF_DIR)
    wanted, _ = simhash_rows(given)
    assert tuples(found, "doc_id", "fingerprint", "component_id") == plain.in_order(wanted)


@pytest.mark.parametrize("count,crowd", [(40, 4096), (10**6, 4096), (10**9, 4096), (40, 8)])
def test_simhash_links_are_whole(spark, monkeypatch, count, crowd):
    """Fingerprints in dense clusters, under codes of few, many and all blocks."""
    configure(spark)
    monkeypatch.setattr(simhash, "CROWD", crowd)
    monkeypatch.setattr(simhash, "VISITS", count * 100)  # few buckets, however many blocks
    draw = np.random.default_rng(2)
    prints = {0, 2**64 - 1}
    for centre in draw.integers(0, 2**63, 12).tolist():
        for _ in range(12):
            centre ^= sum(1 << int(b) for b in draw.integers(0, 64, draw.integers(0, 5)))
            prints.add(centre)
    prints = sorted(prints)
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), count).collect()
    place = {s[0]: i for i, s in enumerate(signed)}
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = root(place[a]), root(place[b])
        parent[max(x, y)] = min(x, y)
    assert [root(i) for i in range(len(prints))] == plain.linked(prints)


def test_blocks_are_odd_and_cover_all_bits():
    for count in (0, 1, 10, 10**3, 10**6, 10**9, 10**15, 2**70):
        lengths = simhash.block_lengths(count)
        assert sum(lengths) == 64 and all(n % 2 for n in lengths)


# Sharding


SHARD_COLUMNS = "doc_id", "size", "text_crc32", "shard", "slot"


def test_sharding(docs, nothing, monkeypatch):
    monkeypatch.setattr(sharding, "RANGES", 2)
    rows = [(r[0], r[1]) for r in plain.awkward_documents()]
    found = sharding.digest(docs)
    assert tuples(found, *SHARD_COLUMNS) == plain.in_order(plain.shards(rows))
    assert {(r.law, r.grown_shard) for r in found.collect()} == {("bytes", None)}
    assert sharding.digest(nothing).collect() == []
    placed = sharding.shard_documents(docs, 3)
    wanted = [(d, shard, slot) for d, _, _, shard, slot in plain.shards(rows, 3)]
    assert tuples(placed, "doc_id", "shard", "slot") == plain.in_order(wanted)


def test_sharding_query(spark, given):
    found = queries.QUERIES["op9_sharding"](spark, SF_DIR)
    rows = plain.shards([(d, t) for d, t, _ in given])
    assert tuples(found, *SHARD_COLUMNS) == plain.in_order(rows)


def test_written_shards(spark, docs, tmp_path):
    placed = sharding.shard_documents(docs, 4)
    sharding.write_shards(placed, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert tuples(back, "doc_id", "text", "shard", "slot") == tuples(
        placed, "doc_id", "text", "shard", "slot"
    )


# Licenses


def license_rows(rows):
    templates = [licenses.template(n, t) for n, t in licenses.NOTICES.items()]
    out = []
    for doc_id, text, *_ in rows:
        own = licenses.WORD.findall((text or "").encode().translate(licenses.LOWER))
        found = []
        for t in templates:
            best = licenses.contained(t, own, 0, len(own))
            if best:
                found.append(f"{t.name}:{best[0]}:{best[1]}:{best[2]:.3f}")
        out.append((doc_id, len(found), ",".join(found)))
    return out


def test_licenses(spark, docs, nothing):
    rows = plain.awkward_documents()
    long = licenses.NOTICES["mit"].replace("without limitation the", "all")
    more = [
        (100, plain.prose(9, 70) + " " + long + " " + plain.prose(10, 70)),
        (101, licenses.NOTICES["mit"][:200]),
        (102, "ALL   Rights\nReserved -- all rights reserved"),
        (103, licenses.NOTICES["gpl-header"].upper()),
    ]
    table = docs.select("doc_id", "text").union(
        spark.createDataFrame(more, "doc_id long, text string")
    )
    found = licenses.digest(licenses.find_licenses(table))
    wanted = license_rows([*rows, *more])
    assert tuples(found, "doc_id", "n_licenses", "licenses") == plain.in_order(wanted)
    assert sum(r[1] for r in wanted) == 6
    assert licenses.digest(licenses.find_licenses(nothing)).collect() == []


def test_licenses_query(spark, given):
    found = queries.QUERIES["op10_license_scans"](spark, SF_DIR)
    wanted = license_rows(given)
    assert tuples(found, "doc_id", "n_licenses", "licenses") == plain.in_order(wanted)
