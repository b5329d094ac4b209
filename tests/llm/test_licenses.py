import re

import pytest
from hypothesis import given, settings, strategies as st

from voltlens.llm import licenses

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(text):
    w = WORDS.findall(low(text or ""))
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        for k in range(len(w) - len(p) + 1):
            if w[k:k + len(p)] == p:
                places.append(k)
                labels.add(label)
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


pieces = st.sampled_from(["MIT", "mit", "License", "license", "Apache", "GNU", "General", "Public", "public", " ", "\n", ", ",
                          "é", "İ", "K", "-", "and", "affero general public license", "version 2.0", "x1", "\x85"])


@given(st.lists(pieces, max_size=25).map(" ".join))
@settings(max_examples=300, deadline=None)
def test_base_against_brute_force(text):
    assert licenses.Scanner().scan(text)[:5] == brute(text)


@pytest.mark.parametrize("expression,labels,value", [
    ("mit", {"mit"}, 1.0), ("mit or gpl-3.0-only", {"mit", "gpl-3.0-only"}, 1.0),
    ("mit and gpl-3.0-only", {"mit", "gpl-3.0-only"}, 0.3),
    ("mit or apache-2.0 and gpl-2.0", {"mit", "apache-2.0", "gpl-2.0"}, 1.0),
    ("( mit or apache-2.0 ) and gpl-2.0", {"mit", "apache-2.0", "gpl-2.0"}, 0.3),
    ("gpl-2.0 with classpath-exception-2.0", {"gpl-2.0"}, 0.65),
    ("gpl-2.0 with x and mit", {"gpl-2.0", "mit"}, 0.65),
    ("mit or", {"mit"}, 1.0), (") mit ( gpl", {"mit", "gpl"}, 0.3), ("foo-1.0", {"foo-1.0"}, licenses.UNKNOWN),
])
def test_shunting_yard(expression, labels, value):
    got, score = licenses.evaluate(expression.split())
    assert got == labels and score == pytest.approx(value)


def test_tags_and_notices():
    s = licenses.Scanner()
    row = s.scan("// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only\ncode")
    assert row[5] == "apache-2.0,gpl-2.0-only,mit" and row[6] == pytest.approx(0.3)
    row = s.scan("Under the MIT License or the Apache License, Version 2.0.")
    assert row[4] == "apache,mit" and row[5] == "apache,apache-2.0,mit" and row[6] == 1.0
    assert s.scan("GNU Affero General Public License")[4:6] == ("gpl", "agpl,gpl")
    assert s.scan("no such thing")[1:7] == (0, None, None, "", "", 0.0)


def test_edges(edge, frame):
    out = licenses.scan_licenses(edge)
    assert [c.lower() for c in out.columns].count("score") == 1
    assert sorted((r.doc_id or 0, r.n_words) for r in out.select("doc_id", "n_words").collect()) == sorted(
        (r[0] or 0, brute(r[1])[0]) for r in edge.collect())
    assert licenses.scan_licenses(frame([])).count() == 0
