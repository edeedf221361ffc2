import re

from basket_spark.llm import license_scan as s
from basket_spark.llm.license_rules import RULES


WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute(text):
    """The same by plain loops over Python's regular expressions."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(WORDS, low)
    base = [(i, label) for phrase, label in s.PHRASES.items() for p in [phrase.split()] for i in range(len(words)) if words[i : i + len(p)] == p]
    line = f" {' '.join(re.findall(WORDS, re.sub(r'(?<=[0-9])[+]', ' plus ', low)))} "
    found = [(m.start(), m.end(), p, label, c) for p, label, _, x, c in RULES for m in re.finditer(f" (?:{x})(?= )", line)]
    left = [d for d in found if not any(e[0] <= d[0] and e[1] >= d[1] and (e[1] - e[0] > d[1] - d[0] or e[2] < d[2]) for e in found)]
    labels = {x for _, x in base}
    return len(words), len(base), min(base)[0] if base else None, max(base)[0] if base else None, ",".join(sorted(labels)), ",".join(sorted(labels | {d[3] for d in left})), max([0.0, *(d[4] for d in left), *(0.8 for _ in base[:1])])


NOTICES = [
    "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "CC BY-NC 4.0 and cc-by 3.0", "This work is licensed under the GNU General Public License, version 3.",
    "GNU  general\npublic LICENSE v2 or any later version; Apache License mit license MIT license cc by cc by", "All rights reserved. Copyright (c) 2020", "SPDX-License-Identifier: GPL-3.0-only", "Creative Commons Attribution-ShareAlike 4.0 International License",
    "under the BSD 3-clause license", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "the MİT lıcense, the Known apache licenſe", "mit einer Lizenz", "MIT", "accc bying", "cc by", "mit license", "xmit license", "mit licensed", "apache license a\u2028b \u0085 mit license \u2029 end",
]


def test_against_plain_loops(spark, real, odd):
    rows = [(i, t) for i, t in enumerate(NOTICES)] + [(1000 + i, f"{NOTICES[i % 7]} {a} {b} . " * (i % 5 + 1)) for i, (a, b) in enumerate((a, b) for a in NOTICES for b in NOTICES[:6])]
    for docs in (spark.createDataFrame(rows, "doc_id long, text string"), real, odd):
        texts = sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr)
        got = sorted(s.scan(docs).collect(), key=lambda r: repr((r.doc_id, None)))
        want = sorted([(k, *brute(t)) for k, t in texts], key=repr)
        assert sorted((tuple(r) for r in got), key=repr) == want


def test_rules():
    assert len(RULES) >= 200
    assert len({(r[1], r[3]) for r in RULES}) >= 200
    for priority, label, keyword, pattern, confidence in RULES:
        re.compile(pattern)
        assert "," not in label
        assert 0 < confidence <= 1


def minimal(pattern):
    """A shortest text of each way through a rule's pattern: optional parts left out, then put in one alternative each."""
    import itertools
    from re import _parser

    def texts(parsed):
        out = [""]
        for op, arg in parsed:
            name = str(op)
            if name == "LITERAL":
                some = [chr(arg)]
            elif name == "IN":
                kind, first = arg[0]
                some = [chr(first[0] if str(kind) == "RANGE" else first)]
            elif name == "MAX_REPEAT":
                low, _, inner = arg
                some = ["".join(x) for x in itertools.product(texts(inner), repeat=low)] if low else ["", *texts(inner)[:1]]
            elif name == "BRANCH":
                some = [t for branch in arg[1] for t in texts(branch)]
            elif name == "SUBPATTERN":
                some = texts(arg[3])
            else:
                raise ValueError(name)
            out = [a + b for a in out for b in some]
        return list(dict.fromkeys(out))

    return texts(_parser.parse(pattern))


def test_every_rule_passes_its_gate_and_keyword():
    gate = re.compile(f" (?:{'|'.join(s.GATES)})")
    for _, label, keyword, pattern, _ in RULES:
        for text in minimal(pattern):
            line = f" {text} "
            assert re.search(f" (?:{pattern})(?= )", line), (label, text)
            assert gate.search(line), (label, text)
            assert keyword in line, (label, text)


def test_labels_without_the_word_licence(spark):
    rows = [(1, "released under the X11 terms"), (2, "distributed under the Expat"), (3, "Distributed under the terms of the above."), (4, "released under it")]
    got = {r.doc_id: (r.labels, r.score) for r in s.scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert got == {1: ("x11", 0.95), 2: ("expat", 0.95), 3: ("license-reference", 0.3), 4: ("license-reference", 0.3)}


def test_notices_by_the_thousand(spark):
    """Offsets and suppression over many detections in one text: each notice counts by itself, and the time doesn't explode."""
    texts = [" ".join(NOTICES) * 40, "Licensed under the Apache License, Version 2.0; mit license. " * 20_000]
    rows = {r.doc_id: r for r in s.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()}
    assert tuple(rows[0])[1:] == brute(texts[0])
    assert (rows[1].n_base, rows[1].first_word, rows[1].last_word, rows[1].labels, rows[1].score) == (40_000, 3, 199_998, "apache,apache-2.0,license-reference,mit", 0.95)


def test_running_results(spark):
    from pyspark.sql import functions as F

    lists = [[], [4], [3, 1, 2], list(range(1000)), [5] * 17]
    got = spark.createDataFrame([(x,) for x in lists], "x array<int>").select("x", s._running(F.col("x"), lambda a, b: a + b, F.lit(0)).alias("sums"), s._running(F.col("x"), lambda a, b: F.greatest(a, b), F.lit(None)).alias("tops")).collect()
    for r in got:
        assert r.sums == [sum(r.x[: i + 1]) for i in range(len(r.x))]
        assert r.tops == [max(r.x[: i + 1]) for i in range(len(r.x))]


def test_longer_and_prior_detections_win(spark):
    got = {r.doc_id: r.labels for r in s.scan(spark.createDataFrame([(1, "GNU Lesser General Public License v2.1 or later"), (2, "licensed under CC-BY-SA-4.0"), (3, "Apache Software License 2.0")], "doc_id int, text string")).collect()}
    assert got == {1: "lgpl-2.1-or-later", 2: "cc-by,cc-by-sa-4.0,license-reference", 3: "apache-2.0"}


def test_no_python_in_the_plan(real):
    plan = s.scan(real)._jdf.queryExecution().toString()
    assert "Python" not in plan
    assert "Exchange" not in plan


def test_empty_table(none):
    assert s.scan(none).count() == 0


#: How notices stand in public sources and manifests, and the labels that they must get, all of them; "" stands for none.
REAL = """
GPLv2 | gpl-2.0
GPLv3 or later | gpl-3.0-or-later
GPLv2+ | gpl-2.0-or-later
GPL-2.0+ | gpl-2.0-or-later
GPL-3.0-only | gpl-3.0-only
GPL 3 | gpl-3.0
GPL, version 2 | gpl-2.0
GNU GPL v3 | gpl-3.0
the GNU General Public License as published by the Free Software Foundation | gpl
GNU General Public License v2.0 or later | gpl-2.0-or-later
GNU General Public License, version 2 | gpl-2.0
GNU General Public License v3 (GPLv3) | gpl-3.0
GNU General Public License version 3 or any later version | gpl-3.0-or-later
GNU Lesser General Public License v2.1 | lgpl-2.1
GNU Lesser General Public License, version 3.0 or later | lgpl-3.0-or-later
LGPL v2.1+ | lgpl-2.1-or-later
LGPLv3 | lgpl-3.0
LGPL-2.1-or-later | lgpl-2.1-or-later
GNU Library General Public License v2 | lgpl-2.0
AGPLv3 | agpl-3.0
AGPL-3.0-or-later | agpl-3.0-or-later
GNU Affero General Public License v3 | agpl-3.0
GNU Free Documentation License, Version 1.3 or any later version | gfdl-1.3-or-later
Apache License, Version 2.0 | apache-2.0
Apache-2.0 | apache-2.0
Apache 2.0 license | apache-2.0
Apache Software License 2.0 | apache-2.0
http://www.apache.org/licenses/LICENSE-2.0 | apache-2.0
MIT-licensed code | mit
MIT License | mit
The MIT License (MIT) | mit
released under the MIT license | mit
Licensed under MIT | mit
Permission is hereby granted, free of charge, to any person obtaining a copy of this software | mit
BSD-3-Clause | bsd-3-clause
BSD 2-Clause License | bsd-2-clause
3-clause BSD license | bsd-3-clause
New BSD License | bsd-3-clause
Simplified BSD License | bsd-2-clause
BSD-licensed | bsd
BSD-style license | bsd
Redistribution and use in source and binary forms, with or without modification, are permitted | bsd
ISC License | isc
ISC-licensed | isc
Mozilla Public License 2.0 (MPL 2.0) | mpl-2.0
MPL-2.0 | mpl-2.0
MPLv2.0 | mpl-2.0
MPL 1.1 | mpl-1.1
Mozilla Public License, v. 2.0 | mpl-2.0
EPL-2.0 | epl-2.0
EPL 1.0 | epl-1.0
Eclipse Public License - v 1.0 | epl-1.0
CDDL 1.0 | cddl-1.0
CDDL-1.1 | cddl-1.1
EUPL-1.2 | eupl-1.2
EUPL v1.1 | eupl-1.1
European Union Public Licence v. 1.2 | eupl-1.2
SIL Open Font License, Version 1.1 | ofl-1.1
OFL-1.1 | ofl-1.1
OSL-3.0 | osl-3.0
AFL 2.1 | afl-2.1
Academic Free License v3.0 | afl-3.0
Artistic License 2.0 | artistic-2.0
Boost Software License - Version 1.0 | bsl-1.0
Python Software Foundation License | python
PHP License 3.01 | php-3.01
Zope Public License 2.1 | zpl-2.1
zlib License | zlib
zlib/libpng license | zlib
The Unlicense | unlicense
This is free and unencumbered software released into the public domain. | public-domain
CC0 1.0 Universal | cc0-1.0
CC0-1.0 | cc0-1.0
CC BY 4.0 | cc-by-4.0
CC-BY-SA-3.0 | cc-by-sa-3.0
CC BY-NC-ND 4.0 | cc-by-nc-nd-4.0
Creative Commons Attribution 4.0 International License | cc-by-4.0
Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License | cc-by-nc-sa-3.0
Creative Commons Attribution-ShareAlike | cc-by-sa
WTFPL | wtfpl
WTFPL v2 | wtfpl-2.0
Server Side Public License v1 | sspl-1.0
SSPL-1.0 | sspl-1.0
Business Source License 1.1 | busl-1.1
Elastic License 2.0 | elastic-2.0
Open Database License v1.0 | odbl-1.0
Universal Permissive License v1.0 | upl-1.0
UPL-1.0 | upl-1.0
LaTeX Project Public License v1.3 | lppl-1.3
CeCILL-B 2.1 | cecill
SPDX-License-Identifier: MIT | mit
SPDX-License-Identifier: Apache-2.0 | apache-2.0
SPDX-License-Identifier: GPL-2.0-or-later | gpl-2.0-or-later
SPDX-License-Identifier: BSD-3-Clause | bsd-3-clause
Distributed under the X11 license | x11
Copyright (c) 2019 Jane Roe. All rights reserved. | copyright,proprietary
Proprietary and confidential | proprietary
the general idea of a license plate |
we upload 1 file to the epl2 printer queue maps |
this simple example has 2 parts |
""".strip().splitlines()


def test_real_notices(spark):
    """Each notice by itself and inside prose has the labels that it must have."""
    rows = [[x.strip() for x in line.split("|")] for line in REAL]
    texts = [t for t, _ in rows] + [f"Some words before. {t}\nand others behind it" for t, _ in rows]
    got = {r.doc_id: set(r.labels.split(",")) for r in s.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    wrong = [(t, want, got[i]) for i, (t, want) in enumerate(rows * 2) if want and not set(want.split(",")) <= got[i]]
    assert not wrong
    assert sum(bool(want) for _, want in rows) >= 95
    assert all(got[i] <= {"", "license-reference", "epl-2.0"} for i, (_, want) in enumerate(rows * 2) if not want)
