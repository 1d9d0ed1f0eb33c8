"""Operators 2, 4, 5 and 9."""

import os
import random
import textwrap
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saleslake.llm import decontaminate, licenses, toxicity, url_filter
from saleslake.llm.license_texts import ISC, MIT, TEXTS

DOCS = "doc_id long, text string"


def test_licenses(spark):
    rows = [(1, "Copyright (c) 2020 A. Person\n\n" + MIT.replace("\n", "  \n ")), (2, MIT.upper().replace('"', "“")),
            (3, ISC), (4, MIT + " and more"), (5, None), (6, ""), (7, "Some text.\nReleased under the MIT License.\nMore\n"
             "Licensed under the Apache Licence, version 2.0"), (8, "!!!"), (1, ISC), (9, "word " * 50_000)]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], DOCS + ", license_id string, digest string")
    got = sorted(((r.doc_id, r.license_id, r.line_licenses) for r in licenses.scan_licenses(df).collect()), key=str)
    assert got == sorted([(1, "MIT", ""), (2, "MIT", ""), (3, "ISC", ""), (4, None, ""), (5, None, ""), (6, None, ""),
                          (7, None, "Apache-2.0,MIT"), (8, None, ""), (1, "ISC", ""), (9, None, "")], key=str)
    assert licenses.scan_licenses(spark.createDataFrame([], DOCS)).collect() == []


RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"),
         ("block", "a.example.net/en/x"), ("allow", "b.org"), ("block", "org/fr/"), ("allow", "net/en/zzzzzzzzzzz")]


def brute_url(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    rest = rest[cut:]
    path = rest[: min([rest.index(c) for c in "?#" if c in rest] or [len(rest)])]
    best = None
    for verdict, rule in sorted(rules, key=lambda r: r[0] == "allow"):
        h, slash, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            if best is None or (len(rule), len(h)) > (len(best[1]), len(best[1].partition("/")[0])):
                best = (verdict, rule)
    return host, path, best and best[1], best[0] if best else "allow"


def test_url_rules_match_brute_force(spark):
    rng = random.Random(3)
    hosts = ["net", "example.net", "A.Example.NET", "xexample.net", "a.b.example.com", "example.com", "org", "b.org", "c.b.org", "q.de",
             "net.example", "", "example.net:80", "..", "a..net"]
    urls = [f"{rng.choice(['http', 'https', 'x'])}://{rng.choice(hosts)}{rng.choice(['', '/', '/en/', '/en/x1', '/de/a', '/fr/', '/frx', '/en'])}"
            f"{rng.choice(['', '?a=/en/', '#x', '?q#z'])}" for _ in range(200)] + [None, "", "no scheme/net/", "http://", "a://b://net/", "http://net?x://y"]
    df = spark.createDataFrame([(i, u, "r", "v") for i, u in enumerate(urls)] + [(0, urls[0], "r", "v")],
                               "page_id long, url string, rule string, key string").repartition(5)
    got = url_filter.judge_urls(df, RULES).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == brute_url(urls[r.page_id], RULES), urls[r.page_id]


def test_url_rules_edge_tables(spark):
    df = spark.createDataFrame([(1, "http://a.net/x"), (None, None)], "page_id long, url string")
    assert {r.verdict for r in url_filter.judge_urls(df, []).collect()} == {"allow"}
    assert {r.verdict for r in url_filter.judge_urls(df, [], default="block").collect()} == {"block"}
    assert url_filter.judge_urls(df.limit(0), RULES).collect() == []


def edit_within(pattern, text):
    """The least edit distance of the pattern to any part of the text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != c)))
        row = new
    return min(row)


@settings(max_examples=150, deadline=None)
@given(st.text("abc ", min_size=1, max_size=12), st.text("abc ", min_size=1, max_size=30))
def test_myers_matches_the_plain_table(pattern, text):
    distance, start, end = decontaminate.best_match(pattern, text)
    assert distance == edit_within(pattern, text)
    assert edit_within(pattern, text[start:end]) == distance if start < end else distance == len(pattern)


def test_contamination_matches_brute_force(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(rng.choice([3, 12, 40])).capitalize() + ".") for i in range(15)] + [(90, None), (91, "  "), (92, "Short")]
    rows = []
    for i in range(60):
        body = text(60)
        if i % 2:
            passage = list(rng.choice(items[:15])[1])
            for _ in range(rng.choice([0, 1, 2, 5, 9])):
                at = rng.randrange(len(passage))
                passage[at:at + 1] = rng.choice([[], [rng.choice("xyz")], [passage[at], "z"]])
            body = body[: 150] + " " + "".join(passage).replace(" ", " \n") + " " + body[150:]
        rows.append((i, body))
    rows += [(100, None), (101, ""), (102, items[0][1]), (102, items[0][1]), (103, (text(30_000) + " " + items[1][1]))]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], DOCS + ", contaminated int")
    bench = spark.createDataFrame(items + [items[0]], "item_id long, text string")
    expected = set()
    for n, (i, t) in enumerate(rows):
        for k, item in items:
            p = decontaminate.canonical(item)
            if p and i != 103 and edit_within(p, decontaminate.canonical(t)) <= len(p) // 16:
                expected.add((i, k))
    expected.add((103, items[1][0]))
    for block_items in (20_000, 4):
        got = decontaminate.contamination(df, bench, block_items=block_items).collect()
        assert {(r.doc_id, r.item_id) for r in got if r.doc_id != 103} == {e for e in expected if e[0] != 103}
        assert (103, items[1][0]) in {(r.doc_id, r.item_id) for r in got}
        assert len(got) == len({(r.doc_id, r.item_id) for r in got}) + sum(r.doc_id == 102 for r in got) // 2
    kept = decontaminate.drop_contaminated(df, bench)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - {i for i, _ in expected}
    empty = bench.limit(0)
    assert decontaminate.contamination(df, empty).count() == 0
    assert decontaminate.drop_contaminated(df, empty).count() == len(rows)
    assert decontaminate.contamination(df.limit(0), bench).count() == 0


def toxic_corpus(n=600, seed=2):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.2
        t = [rng.choice(words) for _ in range(rng.randint(5, 120))]
        if toxic:
            for _ in range(3):
                t.insert(rng.randrange(len(t)), rng.choice(["vile", "nasty", "foul"]))
        docs.append((i, " ".join(t), "x"))
        labels.append((i, int(toxic)))
    return docs, labels


def test_toxicity_learns_and_holds_out(spark):
    docs, labels = toxic_corpus()
    extra = [(9000, None, "x"), (9001, "", "x"), (None, "vile nasty foul", "x"), (9002, "clean w1 " * 20_000, "x"), (0, docs[0][1], "x")]
    df = spark.createDataFrame(docs + extra, DOCS + ", score string")
    lab = spark.createDataFrame([*labels, labels[0], (5, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(df, lab).collect()
    assert len(got) == len(docs) + len(extra)
    truth = dict(labels)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    out = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in out]) > 0.95
    assert {r.predicted for r in got if r.doc_id in (9000, 9001, 9002)} == {0}
    kept = toxicity.drop_toxic(df, lab)
    assert kept.columns == df.columns
    assert kept.count() == sum(r.predicted == 0 for r in got)


def test_toxicity_ignores_held_out_labels(spark):
    docs, labels = toxic_corpus(200)
    flipped = [(i, 1 - y) if zlib.crc32(str(i).encode()) % 5 == 0 else (i, y) for i, y in labels]
    df = spark.createDataFrame(docs, DOCS + ", source string")
    a, b = (toxicity.train(df, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, flipped))
    assert a == b and a


def test_toxicity_without_labels_or_rows(spark):
    docs, labels = toxic_corpus(20)
    df, lab = spark.createDataFrame(docs, DOCS + ", source string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.toxicity(df, lab.limit(0)).collect()
    assert {(round(r.score, 6), r.predicted) for r in got} == {(0.1, 0)}
    assert toxicity.toxicity(df.limit(0), lab).collect() == []


def test_licenses_wherever_they_are_wrapped(spark):
    """Each whole text is recognised on one line and at any width, with a statement before it; a wrapped sentence is no statement."""
    rows, want = [], []
    for license_id, text in TEXTS:
        paragraphs = text.split("\n")
        for n, width in enumerate((40, 60, 68, 72, 76, 79, 80, 100, 10_000)):
            for head in ("", "Copyright (c) 2020 A. Person\n\n", "Copyright A. Person and others\n\n", "(C) 1999-2001 by B\nAll rights reserved.\n"):
                rows.append((len(rows), head + "\n".join(textwrap.fill(p, width) for p in paragraphs)))
                want.append(license_id)
        rows.append((len(rows), " ".join(text.split())))
        want.append(license_id)
    # the usual wraps
    rows += [(len(rows), MIT.replace("\n", " ").replace("AUTHORS OR COPYRIGHT", "AUTHORS OR\nCOPYRIGHT")),
             (len(rows) + 1, ISC.replace("\n", " ").replace("above copyright notice", "above\ncopyright notice"))]
    got = {r.doc_id: r.license_id for r in licenses.scan_licenses(spark.createDataFrame(rows, DOCS)).collect()}
    assert [got[i] for i, _ in rows] == [*want, "MIT", "ISC"]
    kept = "(c) You must retain all notices\ncopyright law applies to it"
    df = spark.createDataFrame([(kept,)], "t string")
    assert df.select(licenses.canonical(licenses.canonical_lines(F.col("t")))).first()[0] == "c you must retain all notices copyright law applies to it"


APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    https://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""


def test_whole_texts_and_headers_of_long_licenses(spark):
    rows = [(0, APACHE_HEADER.replace("https:", "http:")), (1, "Copyright 2020 A. Person\n\n" + " ".join(APACHE_HEADER.split())),
            (2, APACHE_HEADER + " More.")]
    want = {0: "Apache-2.0", 1: "Apache-2.0", 2: None}
    folder = "/usr/share/common-licenses/"
    for name, license_id in (("Apache-2.0", "Apache-2.0"), ("CC0-1.0", "CC0-1.0"), ("GPL-2", "GPL-2.0"), ("GPL-3", "GPL-3.0"),
                             ("LGPL-3", "LGPL-3.0"), ("MPL-2.0", "MPL-2.0")):
        if os.path.exists(folder + name):
            with open(folder + name, encoding="utf-8") as f:
                want[len(rows)] = license_id
                rows.append((len(rows), f.read()))
    got = {r.doc_id: r.license_id for r in licenses.scan_licenses(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == want


def test_class_weights_restore_rare_shares():
    for toxic in (0.3, 0.1, 0.03, 0.001):
        counts = {1: round(10_000_000 * toxic), 0: round(10_000_000 * (1 - toxic))}
        took = {1: min(counts[1], 16_000 // 3), 0: 16_000 - 16_000 // 3}
        clean, one = toxicity.class_weights(counts, took)
        assert abs(took[0] * clean / (took[1] * one) / (counts[0] / counts[1]) - 1) < 1e-9
    assert toxicity.class_weights({0: 5}, {0: 5, 1: 0}) == [1.0, 1.0]


def test_many_hits_of_an_item_cost_one_look(spark):
    """20,000 hits of pieces of one item in one text are verified once over the text."""
    import time

    from saleslake.llm.decontaminate import Matcher
    item = "".join(f"{c}{i % 7}" for i, c in enumerate("abcdefghijklmnopqrstuvwxyz" * 2))
    matcher = Matcher([(1, item)])
    text = (item[:15] + " ") * 20_000
    t = time.perf_counter()
    assert matcher.matches(text) == []
    assert matcher.matches(text + item[:50] + "#" + item[51:])[0][:2] == (1, 1)
    assert time.perf_counter() - t < 8


def test_a_rule_in_two_cases_and_rules_from_a_table(spark):
    rules = [("block", "NET/"), ("allow", "net/"), ("allow", "Example.net/en/")]
    pages = spark.createDataFrame([(1, "http://a.net/x"), (2, "http://example.NET/en/x")], "page_id int, url string")
    table = spark.createDataFrame(rules, "verdict string, rule string")
    for given in (rules, table):
        got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge_urls(pages, given).collect()}
        assert got == {1: ("net/", "block"), 2: ("example.net/en/", "allow")}


def test_class_weights_restore_shares_both_ways():
    assert toxicity.class_weights({0: 8000, 1: 8000}, {0: 8000, 1: 5333})[0] == pytest.approx(5333 / 8000)


def test_repeated_ids_are_learnt_alike(spark):
    """Of texts that share an id one counts, whatever the order of the rows."""
    rows = [(1, "good words here"), (1, "a second text"), (2, "bad bad words"), (3, "nice"), (3, "nice"), (4, "bad thing")]
    labels = spark.createDataFrame([(1, 0, 0), (2, 0, 1), (3, 1, 0), (4, 0, 1), (4, 0, 1)], "doc_id long, quality int, toxic int")
    learnt = [toxicity.train(spark.createDataFrame(r, "doc_id long, text string").repartition(n), labels)
              for r, n in ((rows, 1), (rows[::-1], 4))]
    assert learnt[0] == learnt[1] and learnt[0]


def test_ftrl_is_that_of_plain_floats():
    """Per-coordinate updates against FTRL-proximal written out coordinate by coordinate."""
    import math
    model, z, n = toxicity.Ftrl(16, l1=0.3), {}, {}
    rng = np.random.default_rng(3)
    for _ in range(60):
        at, label = np.unique(rng.integers(0, 16, 5)), int(rng.integers(2))
        w = {}
        for i in at.tolist():
            zi, ni = z.get(i, 0.0), n.get(i, 0.0)
            w[i] = 0.0 if abs(zi) <= model.l1 else -(zi - math.copysign(model.l1, zi)) / ((model.beta + math.sqrt(ni)) / model.alpha + model.l2)
        assert np.allclose(model.weights(at), [w[i] for i in at.tolist()])
        p = 1 / (1 + math.exp(-(sum(w.values()) + model.bias)))
        model.learn(at, label, 1.0)
        for i in at.tolist():
            g = p - label
            s = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / model.alpha
            z[i], n[i] = z.get(i, 0.0) + g - s * w[i], n.get(i, 0.0) + g * g
