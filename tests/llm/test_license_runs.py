"""All runs of a notice in a text are told."""

import time

from measlake.llm import licenses
from measlake.llm.common import configure


def plain(name):
    return licenses.NOTICES[name].replace("{{", "").replace("}}", "")


def test_all_runs(spark):
    configure(spark)
    between = " and now " + "something else follows here " * 20
    rows = [
        (1, between.join([plain("isc")] * 3 + [plain("mit-notice")] * 2)),
        (2, " ".join([plain("gpl-header")] * 4)),
        (3, between.join([plain("isc").replace("fee", "charge"), plain("isc"), plain("isc")])),
        (4, "nothing"),
        (5, None),
    ]
    found = licenses.find_licenses(spark.createDataFrame(rows, "doc_id long, text string"))
    spans = {r.doc_id: [(x.name, x.start, x.end, x.share) for x in r.licenses] for r in found.collect()}
    size = {n: len(licenses.words_of(plain(n))) for n in ("isc", "mit-notice", "gpl-header")}
    gap = len(licenses.words_of(between))
    starts = [i * (size["isc"] + gap) for i in range(4)]
    notices = [starts[3], starts[3] + size["mit-notice"] + gap]
    assert spans[1] == [
        *(("mit-notice", s, s + size["mit-notice"], 1.0) for s in notices),
        *(("isc", s, s + size["isc"], 1.0) for s in starts[:3]),
    ]
    assert spans[2] == [
        ("gpl-header", i * size["gpl-header"], (i + 1) * size["gpl-header"], 1.0) for i in range(4)
    ]
    assert [s for _, s, _, _ in spans[3]] == [starts[1], starts[2], 0]
    assert spans[4] == spans[5] == []
    told = {r.doc_id: r for r in licenses.digest(found).collect()}
    assert [(told[i].n_licenses, told[i].n_runs) for i in range(1, 6)] == [
        (2, 5),
        (1, 4),
        (1, 3),
        (0, 0),
        (0, 0),
    ]
    first = starts[1]
    assert told[3].licenses == f"isc:{first}:{first + size['isc']}:1.000"


def test_many_runs_take_time_in_proportion():
    scanner = licenses.Scanner(licenses.NOTICES)
    text = (plain("all-rights-reserved") + " ").encode() * 50_000
    before = time.perf_counter()
    assert len(scanner([text])[0]) == 50_000
    assert time.perf_counter() - before < 30
