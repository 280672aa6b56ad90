from __future__ import annotations

import itertools
import random
import re
import time
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetspark.llm import html_text, license_rules, quality_rules, toxicity, url_filter
from fleetspark.llm.html_pages import example_pages


def brute_statistics(t):
    t = t or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    places, covered = {}, set()
    for k in range(len(words) - 4):
        places.setdefault(tuple(words[k : k + 5]), []).append(k)
    for starts in places.values():
        if len(starts) > 1:
            covered.update(k + i for k in starts for i in range(5))
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_statistics_equal_brute_force(spark, docs):
    rng = random.Random(4)
    texts = [None, "", " \t\n", "é ü|x", "a b c d e a b c d e", "a a a a a a a", "x\nx\n\n \nx", "a b c d e f\r\ng a b c d e", "w " * 5000]
    texts += [" ".join(rng.choices("a b c # <x> \n".split(" "), k=rng.randint(0, 60))) for _ in range(60)]
    df = docs(texts).withColumn("n_words", F.lit("clash"))
    rows = {r["doc_id"]: r for r in quality_rules.with_statistics(df).collect()}
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert [tuple(rows[i][n] for n in names) for i in range(len(texts))] == [brute_statistics(t) for t in texts]


def test_rules_find_planted_thresholds(spark, docs):
    rng = random.Random(1)
    texts, bad = [], []
    for k in range(600):
        words = [rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randint(0, 99)) for _ in range(rng.randint(12, 40))]
        bad.append(k % 5 == 0)
        texts.append(" ".join(w + "##" if bad[-1] else w for w in words))
    df = quality_rules.with_statistics(docs(texts)).join(spark.createDataFrame(list(enumerate(bad)), "doc_id long, bad boolean"), "doc_id")
    rules = quality_rules.learn(df, "doc_id", F.col("bad"))
    got = {r["doc_id"]: r["why"] for r in df.select("doc_id", quality_rules.decide(rules, quality_rules.features()).alias("why")).collect()}
    assert rules and [got[i] is not None for i in range(600)] == bad
    assert quality_rules.learn(df, "doc_id", F.lit(False)) == [] and quality_rules.learn(df.limit(0), "doc_id", F.col("bad")) == []
    nulls = df.select(quality_rules.decide([], quality_rules.features()).alias("why"))
    assert nulls.where("why is not null").count() == 0


def test_toxicity_learns_and_keeps_its_folds(spark):
    rng = random.Random(2)
    vocabulary = [f"word{k}" for k in range(300)]
    rows = []
    for i in range(1500):
        words = rng.choices(vocabulary, k=rng.randint(5, 60))
        toxic = i % 8 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["Vile", "nasty", "rotten"])
        rows.append((i, " ".join(words), toxic))
    df = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(9000, None, "x"), (9001, "", "x")], "doc_id long, text string, score string")
    own = df.selectExpr("doc_id AS id", "text")
    shown = spark.createDataFrame([(i, t) for i, _, t in rows if i % 2 and zlib.crc32(str(i).encode()) % 5 or i % 16 == 0], "id long, toxic boolean")
    model = toxicity.train(own, shown.where("toxic").select("id"), shown.select("id"))
    got = {r["doc_id"]: r["score"] for r in toxicity.with_scores(df, model).collect()}
    right = np.mean([(got[i] >= 0.5) == t for i, _, t in rows])
    assert right >= 0.98 and 0 <= got[9000] == got[9001] < 0.5
    nothing = toxicity.train(own, shown.limit(0).select("id"), shown.limit(0).select("id"))
    assert all(r["score"] < 1e-9 for r in toxicity.with_scores(df, nothing).collect())
    assert toxicity.train(own.limit(0), shown.select("id"), shown.select("id")).features.size == 0


def test_toxicity_where_every_document_is_labelled(spark):
    rng = random.Random(5)
    vocabulary = [f"word{k}" for k in range(300)]
    rows = []
    for i in range(2000):
        words = rng.choices(vocabulary, k=rng.randint(5, 60))
        if i % 8 == 0:
            words[rng.randrange(len(words))] = rng.choice(["vile", "nasty", "rotten", "foul", "gross", "awful", "horrid", "wicked", "mean", "cruel"])
        rows.append((i, " ".join(words), i % 8 == 0))
    df = spark.createDataFrame(rows, "id long, text string, toxic boolean")
    own = df.where("id < 1600")
    model = toxicity.train(own.select("id", "text"), own.where("toxic").select("id"), own.select("id"))
    got = {r["id"]: r["score"] for r in toxicity.with_scores(df.where("id >= 1600"), model).collect()}
    found = [got[i] >= 0.5 for i, _, t in rows if i >= 1600 and t]
    wrong = [got[i] >= 0.5 for i, _, t in rows if i >= 1600 and not t]
    assert np.mean(found) >= 0.95 and np.mean(wrong) <= 0.02


def test_features_are_found_again():
    column = pa.array(["Vile word", None, "", "vile vile", "wordy"])
    lists = toxicity.all_features(column, (4,))
    names = np.unique(np.concatenate(lists).view(np.uint64))
    owner, which = toxicity.kept_features(column, names, (4,))
    assert [sorted(names[which[owner == i]].tolist()) for i in range(5)] == [sorted(x.view(np.uint64).tolist()) for x in lists]


URLS = [
    (None, "", "", None),
    ("no scheme/x", "", "", None),
    ("http://A.Example.COM/en/x?q#f", "a.example.com", "/en/x", "example.com/en/"),
    ("https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/"),
    ("x://b.com", "b.com", "", None),
    ("x://b.com/a://c.net/es/", "b.com", "/a://c.net/es/", "com/"),
    ("https://s.net/es/1#a/b", "s.net", "/es/1", "net/es/"),
    ("https://snet/es/", "snet", "/es/", None),
    ("ftp://h.org?x=/fr/", "h.org", "", None),
]


def test_urls_and_rules(spark):
    from fleetspark.llm.queries.urls import RULES

    df = spark.createDataFrame([(i, u[0], "clash") for i, u in enumerate(URLS)], "page_id long, url string, verdict string")
    rows = {r["page_id"]: r for r in url_filter.judged(df, RULES).collect()}
    assert [(rows[i]["host"], rows[i]["path"], rows[i]["rule"]) for i in range(len(URLS))] == [u[1:] for u in URLS]
    listed = dict((h + p, v) for v, h, p in RULES)
    assert all(r["verdict"] in ("allow", "block") for r in rows.values()) and all(r["verdict"] == listed[r["rule"]] for r in rows.values() if r["rule"])
    assert url_filter.judged(df.limit(0), RULES).count() == 0


def test_url_models(spark):
    rng = random.Random(6)
    rows = [("".join(rng.choices("abcd" if good else "wxyz", k=rng.randint(1, 12))), good) for good in (True, False) for _ in range(400)]
    ratio = url_filter.train(spark.createDataFrame(rows, "text string, accepted boolean"))
    scores = ratio.scores(pa.array([t for t, _ in rows]))
    assert np.mean((scores >= ratio.threshold) == [g for _, g in rows]) > 0.99
    only = url_filter.train(spark.createDataFrame(rows[:400], "text string, accepted boolean"))
    assert only.threshold <= 0 and url_filter.train(spark.createDataFrame(rows[400:], "text string, accepted boolean")).threshold == np.inf


def test_url_probabilities_by_hand():
    codes, bounds = url_filter.grams(pa.array(["ab", None, "ab"]))
    assert np.diff(bounds).tolist() == [3, 1, 3] and np.array_equal(codes[:3], codes[4:])
    counts = np.bincount(codes, minlength=url_filter.SIZE ** (url_filter.ORDER + 1))
    p = np.exp(url_filter.log_likelihoods(counts)).reshape(-1, url_filter.SIZE)
    assert np.allclose(p[:, 1:].sum(axis=1), 1, atol=0.03)
    # After (pad, pad, a) only b was seen, twice: (2 + 1 * what the shorter context says) / 3.
    assert p[1, 2] > 2 / 3 and p[1, 2] > p[1, 1]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><!-- <p>no</p> --><nav><ul><li><a href=/a>Menu</a></li></ul></nav>
<div class="ad">Buy now and more.</div><article><h1>A &amp; B</h1><p><b>One   two<br><p>Thr<i>ee</i> four&nbsp;five &lt;six&gt;</p><script>var t="</p>";</script><ul><li>item<li>next</ul></article>
<section class="comments"><p>I disagree with this.</p></section><footer>&copy; x</footer>"""


@pytest.fixture(scope="module")
def html_model(spark):
    return html_text.train(spark.createDataFrame([(p,) for p in example_pages()], "html string"))


def test_main_text(spark, html_model):
    assert html_model.text(PAGE) == "A & B One two Three four\xa0five <six> item next"
    for page in (None, "", "<", "<p", "</p></p>", "<a <b>", "plain", "<article>" * 300, "<script>x", "&#0;&bad", "<p>" + "w " * 50_000):
        assert isinstance(html_model.text(page), str)
    df = spark.createDataFrame([(1, PAGE, "x"), (2, None, "x"), (3, "", "x")], "page_id long, html string, main_text string")
    got = {r["page_id"]: r["main_text"] for r in html_text.with_main_text(df, html_model).collect()}
    assert got[1].startswith("A & B") and got[2] == got[3] == ""


@pytest.mark.parametrize("page", ['<p>x</p><a ' + '""' * 10_000, "<a " * 100_000, "<!" * 100_000, '<a ">' * 50_000, "<a \"'" * 50_000 + ">", "<p>" * 20_000])
def test_broken_tags_take_time_in_proportion(html_model, page):
    start = time.perf_counter()
    html_text.parse(page)
    assert time.perf_counter() - start < 1


def test_a_page_cut_at_every_byte(html_model):
    start = time.perf_counter()
    for cut in range(len(PAGE)):
        assert isinstance(html_model.text(PAGE[:cut]), str)
    assert time.perf_counter() - start < 5


def test_text_outside_every_element(html_model):
    assert html_model.text("plain text") == "plain text"
    assert html_model.text("Intro <b>x</b> text") == "Intro x text"
    assert html_model.text("1 < 2 and 3 > 2") == "1 < 2 and 3 > 2"
    assert html_model.text("one <a href='x>y") == "one y"
    assert html_model.text("one <a href=x") == "one"
    assert html_model.text('one <b title="x>two</b> three') == "one two three"


def test_held_out_pages(html_model):
    wrong = total = 0
    for page in example_pages(120, seed=77):
        nodes, _ = html_text.parse(page)
        pairs = list(zip(html_text.labels(nodes)[1:], html_model.marginals(nodes)[1:], strict=True))
        total += len(pairs)
        wrong += sum(main != (p >= 0.5) for main, p in pairs)
    assert wrong <= 0.03 * total


def test_marginals_by_enumeration(html_model):
    nodes, _ = html_text.parse("<div><p>some words here</p><ul class=menu><li>x</li></ul></div>")
    own = [sum(html_model.odds.get(f, 0.0) for f in names) for names in html_text.features(nodes)]
    nodes, _ = html_text.parse("<div><p>some words here</p><ul class=menu><li>x</li></ul></div>")
    below = (html_model.below_rest, html_model.below_main)
    weight = np.zeros(len(nodes))
    total = 0.0
    for state in itertools.product((0, 1), repeat=len(nodes) - 1):
        s, w = (0, *state), 1.0
        for k in range(1, len(nodes)):
            p = below[s[nodes[k].parent]]
            w *= (p if s[k] else 1 - p) * np.exp(own[k] * s[k])
        total += w
        weight += w * np.array(s)
    assert np.allclose(html_model.marginals(nodes)[1:], (weight / total)[1:], atol=1e-9)


def test_licenses_equal_sql(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including more. The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, express or implied."
    texts = [None, "", "Released under the MIT License.", f"Intro.\n{mit} End.", "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0.", "no license here", "See the license for the specific language governing permissions and limitations under the License.", "This work is licensed under the GNU General Public License, version 3. " * 3]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (len(r["license_sentences"]), "".join(f"[{n}]" for n in r["licenses"]), ",".join(r["unmatched"])) for r in license_rules.with_licenses(df).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    assert got == {r[0]: r[1:] for r in con.execute(license_rules.duckdb_sql()).fetchall()}
    assert [got[i][1] for i in range(8)] == ["", "", "[MIT]", "[MIT]", "[Apache-2.0][CC-BY-NC-4.0]", "", "", "[GPL-3.0]"] and got[6][2] == "apache2-see"


MIT_TEXT = """\
MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD3_TEXT = """\
Copyright (c) 2020, Some One
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED.
"""
APACHE_TEXT = """\
Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL3_TEXT = """\
This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""
GPL2_TEXT = """\
This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2
of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program; if not, write to the Free Software
Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA  02110-1301, USA.
"""


def test_licenses_in_their_usual_wrapping(spark):
    bsd2 = BSD3_TEXT[: BSD3_TEXT.index("3. ")] + BSD3_TEXT[BSD3_TEXT.index("THIS ") :]
    starred = BSD3_TEXT.replace("1. ", " * ").replace("2. ", " * ").replace("3. ", " * ").replace("met:\n\n", "met:\n")
    texts = {"MIT": [MIT_TEXT, MIT_TEXT.replace("One\n\n", "One\n")], "BSD-3-Clause": [BSD3_TEXT, starred], "BSD-2-Clause": [bsd2], "Apache-2.0": [APACHE_TEXT], "GPL-3.0-or-later": [GPL3_TEXT], "GPL-2.0-or-later": [GPL2_TEXT]}
    marks = ["", "    ", " * ", "# ", "// ", "-- ", ";; ", "! "]
    cases = [(mark, name, "".join(f"{mark}{line}".rstrip() + end for line in t.splitlines())) for name, ts in texts.items() for t in ts for mark in marks for end in ("\n", "\r\n")]
    cases = [(m, n, f"/*\n{t} */\nint main() {{}}\n" if m == " * " else t) for m, n, t in cases]
    rows = spark.createDataFrame([(i, t) for i, (_, _, t) in enumerate(cases)], "doc_id long, text string")
    got = {r["doc_id"]: ([n for n in r["licenses"] if n != "all rights reserved"], r["unmatched"]) for r in license_rules.with_licenses(rows).collect()}
    assert {i: got[i] for i in got} == {i: ([n], []) for i, (_, n, _) in enumerate(cases)}


def test_license_headings_and_tags(spark):
    texts = {
        "# SPDX-License-Identifier: MIT\nimport os\n": ["MIT"],
        "/* SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note */\nint x;": ["GPL-2.0"],
        "// SPDX-License-Identifier: Apache-2.0 OR LGPL-2.1-or-later": ["Apache-2.0", "LGPL-2.1-or-later"],
        "SPDX-License-Identifier: (GPL-3.0+ AND BSD-3-Clause)": ["BSD-3-Clause", "GPL-3.0-or-later"],
        "SPDX-License-Identifier: Foo-1.0": [],
        "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007": ["GPL-3.0"],
        "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS": ["Apache-2.0"],
        "Mozilla Public License Version 2.0\n==================================\n": ["MPL-2.0"],
        "The MIT License (MIT)\n\nCopyright (c) 2020": ["MIT"],
        "We looked at the\nMIT License\nand others": [],
        "A title without a full stop\nReleased under the MIT License.\nMore": ["MIT"],
    }
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_rules.with_licenses(rows).collect()}
    assert {i: got[i]["licenses"] for i in got} == dict(enumerate(texts.values()))
    assert got[4]["unmatched"] == ["spdx-other"]


def test_toxic_scores_follow_from_texts_and_not_from_rows(spark):
    """Each confirmed text has a copy without a label; scores are the same however rows are dealt and repeated."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(600):
        text = " ".join(rng.choice(words) for _ in range(30))
        if i < 150:
            text += " vile" + " slur" * (i % 3) + " insult" * (i % 2)
            rows.append((2000 - i, text))
        rows.append((i, text))
    df = spark.createDataFrame(rows, "id long, text string")
    labelled = spark.createDataFrame([(i,) for i in range(600)], "id long")
    confirmed = labelled.where("id < 150")
    seen = []
    for docs in (df.repartition(1), df.repartition(7), df.orderBy(F.desc("id")), df.unionByName(df.where("id % 2 = 0"))):
        model = toxicity.train(docs, confirmed, labelled)
        scores = {r["id"]: r["score"] for r in toxicity.with_scores(df, model).collect()}
        seen.append(scores)
    assert all(scores == seen[0] for scores in seen)
    assert sum(seen[0][i] >= 0.5 for i in range(150)) >= 140 and sum(seen[0][i] >= 0.5 for i in range(150, 600)) <= 5
