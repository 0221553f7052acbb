import re

import numpy as np

from strata.llm.license_rules import build_rules
from strata.llm.license_scan import BASE, Scanner, op4_license_scan, scan_licenses, suppress


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


TEXTS = ["Licensed under the MIT License.", "under the mit-license; UNDER THE\nMIT\tLICENSE and Apache License, Version 2.0", "CC BY NC and cc-by-nc 4.0",
         "thunder the mit license", "under the mit licenses", None, "", "…", "Apache License Version 2 cc by nc under the mit license " * 500,
         "SPDX-License-Identifier: GPL-3.0-or-later", "All rights reserved.", "nothing here at all", "é under the mit licenseé", "\x00under\x00the\x7fmit{license}",
         "This work is licensed under the GNU General Public License, version 3.", "Under The MIT License under the mit license"]


def test_base_phrases_against_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS + TEXTS[:1])], "doc_id long, text string, n_words string")
    got = {r.doc_id: r for r in scan_licenses(docs).collect()}
    assert len(got) == len(TEXTS) + 1
    for i, t in enumerate(TEXTS + TEXTS[:1]):
        w = words(t)
        want = sorted((k, label) for p, label in BASE for k in range(len(w)) if w[k:k + len(p.split())] == p.split())
        assert got[i].n_words == len(w), t
        assert sorted((d.start, d.label) for d in got[i].detections if d.base) == want, t
        assert all(0 <= d.start < d.end <= len(w) for d in got[i].detections)


def test_labels_of_the_rules():
    s = Scanner(BASE, build_rules())
    label = lambda t: {d[1] for d in s.scan(t.lower().encode()) if d[-1]}
    assert label("Released under the MIT License.") == {"mit"}
    assert label("Licensed under the Apache License, Version 2.0.") == {"apache-2"}
    assert label("This work is licensed under the GNU General Public License, version 3.") == {"gpl-3"}
    assert label("licensed under cc by-nc 4.0") == {"cc-by-nc"}
    assert label("licensed under CC BY-NC-SA 4.0") == {"cc-by-nc", "cc-by-nc-sa"}    # the base phrase stays
    assert label("SPDX-License-Identifier: BSD-3-Clause") == {"bsd-3-clause"}
    assert label("submit the report and transmit it") == set()
    assert len(build_rules()) >= 250 and len({r[0] for r in build_rules()}) == len(build_rules())


def test_suppression_against_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(300):
        found = [(int(s), int(s + n), int(p), i) for i, (s, n, p) in enumerate(zip(
            rng.integers(0, 12, 9), rng.integers(1, 8, 9), rng.integers(0, 3, 9), strict=True))]
        want = []
        for s, e, p, i in found:
            inside = [x for x in found if x[3] != i and x[0] <= s and x[1] >= e]
            want.append(not any(x[2] > p or (x[2] == p and (x[1] - x[0] > e - s or x[3] < i)) for x in inside))
        assert suppress(found) == want


def test_query_columns(spark):
    out = op4_license_scan(spark, "/root/testdata/sf0.001")
    rows = out.collect()
    assert len(rows) == 200 and all(0 <= r.score <= 1 for r in rows)
    assert all((r.first_word is None) == (r.n_base == 0) for r in rows)
    assert scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def example(items, rng):
    """A random text that the parsed pattern fits, look-ahead left aside."""
    out = ""
    for op, arg in items:
        name = str(op)
        if name == "LITERAL":
            out += chr(arg)
        elif name == "IN":
            kind, one = arg[rng.integers(len(arg))]
            out += chr(one if str(kind) == "LITERAL" else rng.integers(one[0], one[1] + 1))
        elif name == "BRANCH":
            out += example(arg[1][rng.integers(len(arg[1]))], rng)
        elif name == "SUBPATTERN":
            out += example(arg[3], rng)
        elif name == "MAX_REPEAT":
            out += "".join(example(arg[2], rng) for _ in range(rng.integers(arg[0], arg[1] + 1)))
        else:
            assert name == "ASSERT_NOT", name
    return out


def every_rule(rules, text):
    """Detections of all rules by their patterns alone: no gate, no keyword."""
    norm = " " + " ".join(words(text)) + " "
    return sorted((rid, norm[:m.start() - 1].count(" "), norm[:m.end()].count(" "))
                  for rid, rx in rules for m in rx.finditer(norm))


def test_gate_and_keywords_lose_nothing(spark):
    rng = np.random.default_rng(4)
    rules = [(r[0], re.compile(rf"(?<= )(?:{r[4]})(?= )")) for r in build_rules()]
    texts = ["Released under MIT.", "Distributed under the BSD 3-Clause.", "This work is in the public\ndomain.",
             "Provided under Creative-Commons Attribution 4.0", "released under expat", "SPDX-License-Identifier: GFDL-1.3-only"]
    for (rid, rx), rule in zip(rules, build_rules(), strict=True):
        tree = re._parser.parse(rule[4])
        own = [t for t in (example(tree, rng) for _ in range(24)) if rx.search(f" {' '.join(words(t))} ")][:6]
        assert own, rid
        texts += ["".join(str(rng.choice([" ", "\n", "-", ", "])) if c == " " else c for c in t.title()) for t in own]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: sorted((d.rule, d.start, d.end) for d in r.detections if not d.base) for r in scan_licenses(docs).collect()}
    for i, t in enumerate(texts):
        assert got[i] == every_rule(rules, t) and got[i], t
