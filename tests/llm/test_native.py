"""Sharding, quality rules and licence scans against brute force."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from basketry.llm import licenses, rules, sharding

EDGE = [(1, "a b c"), (2, None), (3, ""), (4, "  \n\t "), (5, "w " * 30000), (None, "a b c"), (7, "a b c"), (7, "a b c"),
        (8, "one two three four five six seven eight nine " * 3), (9, "x\ny\nx\n\nx"), (10, "é" * 25 + " ## |<>")]


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    win = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    hit = {p for k in range(len(w) - 7) if win[tuple(w[k:k + 8])] > 1 for p in range(k, k + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit))


def test_rules_match_brute_force(docs):
    rng = random.Random(3)
    rows = EDGE + [(100 + k, " ".join(rng.choice("abc") for _ in range(rng.randrange(60)))) for k in range(60)]
    got = rules.quality_digest(docs(rows)).collect()
    want = Counter((i, *brute(t)) for i, t in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_rule_order_changes_no_verdict(docs):
    d = docs(EDGE + [(50 + k, "word%d " % k * 5 + "plain text of many different words " + " ".join(map(str, range(k)))) for k in range(30)])
    names = [r.name for r in rules.RULES]
    kept = [sorted((r.doc_id or -1) for r in rules.cascade(d, order=o).where("failed_rule is null").collect())
            for o in (names, names[::-1], rules.rule_order(d))]
    assert kept[0] == kept[1] == kept[2]
    assert rules.cascade(d, order=names).columns == d.columns + ["failed_rule"]


def test_rules_of_empty_table(docs):
    assert rules.quality_digest(docs([(1, "a")]).where("false")).count() == 0


def test_digest_counts_only_what_it_returns(docs):
    d = rules.quality_digest(docs(EDGE))
    assert "n_lines" not in d._jdf.queryExecution().optimizedPlan().toString()
    names = [r.name for r in rules.RULES]
    by_rule = {(r.doc_id, r.text): r.failed_rule is None for r in rules.cascade(docs(EDGE), order=names).collect()}
    assert Counter((r.doc_id, r.kept) for r in d.collect()) == Counter((i, by_rule[i, t]) for i, t in EDGE)


def test_rule_order_takes_no_texts_to_the_driver(docs, monkeypatch):
    d, sent = docs([(k, "long text " * 5000) for k in range(3)] + EDGE), []
    plain = type(d).collect
    monkeypatch.setattr(type(d), "collect", lambda self: sent.extend(rows := plain(self)) or rows)
    assert sorted(rules.rule_order(d)) == sorted(r.name for r in rules.RULES)
    assert sent and all(isinstance(x, int) for row in sent for x in row)


def test_rules_run_no_python(docs, spark):
    plan = rules.quality_digest(docs(EDGE))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("n,per", [(0, 10), (5, 10), (1000, 37), (997, 10_000)])
def test_shards_are_exact(spark, n, per):
    rows = spark.range(n).select((F.col("id") % 50).alias("doc_id"), F.lit("q").alias("shard"))
    got = sharding.uniform_shards(rows, 24, rows_per_partition=per).collect()
    assert len(got) == n
    assert Counter(r.doc_id for r in got) == Counter(k % 50 for k in range(n))
    by = {s: sorted(r.slot for r in got if r.shard == s) for s in range(24)}
    assert all(v == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1


def test_sharding_digest_of_edges(docs):
    import zlib
    got = sharding.shard_documents(docs(EDGE)).collect()
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in EDGE)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want


def test_hypergeometric_mean_and_range():
    import numpy as np
    rng = np.random.default_rng(1)
    draws = [sharding.hypergeometric(rng, 300, 700, 100) for _ in range(4000)]
    assert abs(np.mean(draws) - 30) < 0.4 and abs(np.var(draws) - 100 * .3 * .7 * 900 / 999) < 1.5
    assert sharding.hypergeometric(rng, 3, 0, 2) == 2 and sharding.hypergeometric(rng, 0, 9, 4) == 0
    big = sharding.hypergeometric(rng, 10**11, 10**12, 10**10)
    assert abs(big - 10**10 / 11) < 10**6


def test_shards_are_uniform(spark):
    """Each row is equally likely in each shard, over seeds."""
    seen = Counter()
    for seed in range(12):
        for r in sharding.uniform_shards(spark.range(48), 4, seed, rows_per_partition=20).collect():
            seen[r.shard, r.id < 24] += 1
    assert all(abs(n - 72) < 36 for n in seen.values())


def test_licence_rules(docs):
    full = ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
            "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software.")
    rows = [(1, full), (2, "Hi.\nReleased under the MIT License.\nBye"), (3, None), (4, ""),
            (5, "Licensed under CC BY-NC 4.0. Licensed under the Apache License, Version 2.0."),
            (6, "we talk about the MIT License here."), (None, "Released under the  MIT license!"),
            (8, "Released under the MIT License.\n" * 2000), (8, "Licensed under CC BY-NC 4.0")]
    got = {(r.doc_id, r.sentence_ids[:200]): r.licences for r in licenses.licence_query(docs(rows)).collect()}
    assert got[1, "mit-grant,mit-keep"] == "MIT"
    assert got[2, "mit-notice"] == "MIT"
    assert got[3, ""] == got[4, ""] == got[6, ""] == ""
    assert got[5, "ccbync4-notice,apache2-notice"] == "Apache-2.0,CC-BY-NC-4.0"
    assert got[None, "mit-notice"] == "MIT" and got[8, "ccbync4-notice"] == "CC-BY-NC-4.0"


NOTICES = {
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\n"
        "the Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.\n\n"
        "This program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\n"
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU General Public License for more details.\n\n"
        "You should have received a copy of the GNU General Public License\nalong with this program.  If not, see <https://www.gnu.org/licenses/>.",
        "gpl-free,gpl-asis,gpl-see,gpl-copy"),
    "GPL-2.0-or-later": (
        "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\n"
        "the Free Software Foundation; either version 2 of the License, or\n(at your option) any later version.\n\n"
        "This program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\n"
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU General Public License for more details.\n\n"
        "You should have received a copy of the GNU General Public License along\nwith this program; if not, write to the Free Software Foundation, Inc.,\n"
        "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.", "gpl2-free,gpl-asis,gpl-see,gpl-copy"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\n"
        "file, You can obtain one at https://mozilla.org/MPL/2.0/.", "mpl2-terms"),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\n"
        "in the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\n"
        "copies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\n"
        "The above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.\n\n"
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\n"
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE\nAUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM.",
        "mit-grant,mit-keep,mit-asis"),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\n"
        "You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\n"
        "Unless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an \"AS IS\" BASIS,\n"
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\nSee the License for the specific language governing permissions and\n"
        "limitations under the License.", "apache2-header,apache2-use,apache2-copy,apache2-asis,apache2-see"),
}


def test_licence_notices_as_printed(docs):
    rows, want = [], {}
    for licence, (notice, ids) in NOTICES.items():
        forms = [notice, notice.replace("\n", "\r\n"), "/*\n" + "".join(f" * {x}".rstrip() + "\n" for x in notice.split("\n")) + " */\nint x;\n"]
        forms += ["code()\n" + "".join(f"{mark} {x}".rstrip() + "\n" for x in notice.split("\n")) for mark in ("#", "//", ";;", "!", "dnl", "REM", "--")]
        for form in [*forms, " ".join(notice.split())]:
            want[len(rows)] = (ids, licence)
            rows.append((len(rows), form))
    got = {r.doc_id: (r.sentence_ids, r.licences) for r in licenses.licence_query(docs(rows)).collect()}
    assert got == want


def test_licence_sentences_end_at_lines_and_stops(docs):
    rows = [(1, "Released under the MIT License\nBy me"), (2, "Licensed under the MIT license\nwith changes"), (3, "MIT\n* licensed under cc by 4.0"),
            (4, "Licensed under. The MIT license."), (5, "Not licensed under the MIT license"), (6, "Licensed under\x01the MIT license\n\n\n"),
            (7, "Licensed under the Apache License, Version 2.0\nLicensed under the MIT license"), (8, " \n; \n" * 50_000 + "Licensed under the MIT license")]
    got = {r.doc_id: r.sentence_ids for r in licenses.licence_query(docs(rows)).collect()}
    assert got == {1: "mit-notice", 2: "", 3: "ccby4-notice", 4: "", 5: "", 6: "mit-notice-2", 7: "apache2-notice,mit-notice-2", 8: "mit-notice-2"}
