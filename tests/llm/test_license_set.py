"""The shipped licenses, and what tells them apart."""

import pytest

from measlake.llm import licenses
from measlake.llm.common import configure

APACHE = """Copyright 2020 Some One

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    https://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""


def plain(name):
    return licenses.NOTICES[name].replace("{{", "").replace("}}", "")


@pytest.fixture(scope="module")
def scanner():
    return licenses.Scanner(licenses.NOTICES)


def names(scanner, *texts):
    order = list(licenses.NOTICES)
    return [{order[f[0]] for f in found} for found in scanner([t.encode() for t in texts])]


def test_each_notice_is_found_and_no_relative_of_it(scanner):
    parts = {  # what a license rightly holds of others
        "apache-2.0-header": {"apache-2.0"},
        "apache-2.0-text": {"apache-2.0", "apache-2.0-header"},
        "mit-text": {"mit"},
        "gpl-2.0-text": {"gpl-2.0-header"},
        "gpl-3.0-text": {"gpl-header"},
        "lgpl-2.1-text": {"lgpl-2.1-header"},
        "mpl-2.0-text": {"mpl-2.0-header"},
    }
    texts = {n: f"one two three {plain(n)} four five six seven" for n in licenses.NOTICES}
    for (name, _), found in zip(texts.items(), names(scanner, *texts.values())):
        assert found == {name} | parts.get(name, set()), name


def test_versions_are_told_apart(scanner):
    sentence = "This work is licensed under the GNU General Public License, version {}."
    header = plain("gpl-header")
    assert names(
        scanner,
        sentence.format(2),
        sentence.format(3),
        sentence.format(4),
        header.replace("version 3", "version 2"),
        header.replace("GNU General", "GNU Affero General"),
        APACHE,
        APACHE.replace("Version 2.0", "Version 3.0"),
        plain("cc-by-4.0").replace("4.0", "3.0"),
    ) == [
        {"gpl-2.0"},
        {"gpl-3.0"},
        set(),
        {"gpl-2.0-header"},
        {"agpl-3.0-header"},
        {"apache-2.0", "apache-2.0-header"},
        set(),
        set(),
    ]


def test_own_set_as_parameter(spark):
    configure(spark)
    docs = spark.createDataFrame([(1, "no more than " + plain("isc"))], "doc_id long, text string")
    own = {"ours": "Use of this text is granted by us under version {{seven}} of our terms"}
    row = (2, "use of this text is granted by us under version seven of our terms")
    docs = docs.union(spark.createDataFrame([row], docs.schema))
    found = licenses.find_licenses(docs, own).collect()
    assert {r.doc_id: [x.name for x in r.licenses] for r in found} == {1: [], 2: ["ours"]}
    found = licenses.find_licenses(docs).collect()
    assert {r.doc_id: [x.name for x in r.licenses] for r in found} == {1: ["isc"], 2: []}
