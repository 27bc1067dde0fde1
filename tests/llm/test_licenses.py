"""License scans against a TF-IDF cosine made by hand, on documents and on trees of files."""

import math
import random
import re
from collections import Counter

import pytest

from crestline.llm import common, licenses, queries
from crestline.llm.common import read
from crestline.llm.licence_texts import NOTICES, RESERVED, TEXTS

ROOT = [("a/LICENSE", TEXTS["MIT"][1])]


def brute(files):
    """path -> (licence, via, inherited_from) of (path, text) by cosines to all templates of all statements, and a walk up the directories."""
    vocabulary = set(licenses.VOCABULARY)
    df = Counter(t for _, text in files for t in set(licenses.terms(text or "")) & vocabulary)
    idf, unseen, unit = licenses.weights(len(files), df)

    def best(text):
        v = {t: (1 + math.log(c)) * idf[t] if t in vocabulary else unseen for t, c in Counter(licenses.terms(text)).items()}
        length = math.sqrt(sum(x * x for x in v.values()))
        if not vocabulary & set(v):
            return None
        scores = [(round(sum(x * v.get(t, 0) for t, x in u.items()) / length, 9), k) for (k, _), u in zip(licenses.TEMPLATES, unit)]
        top = max(s for s, _ in scores)
        return top, min(k for s, k in scores if s == top)

    own = []
    for path, text in files:
        text = text or ""
        parts = text.split("\n") + [p for p in re.split(licenses._GAP, text) if "\n" in p]
        said = [b for b in map(best, parts) if b and b[0] >= licenses.LINE_SCORE]
        head = re.match(licenses.COMMENT.replace(r"\z", r"\Z"), text)
        whole, lead = best(text), best(head[0]) if head else None
        ok = lambda b, s: b is not None and b[0] >= s
        line = max([b for b in said if b[1] != RESERVED], default=max(said, default=None))
        named = re.sub(r"[.-].*$", "", (path or "").rsplit("/", 1)[-1].lower()) in licenses.FILE_NAMES
        is_file = ok(whole, 0.9) or named and (ok(lead, 0.9) or line is not None or ok(whole, licenses.LINE_SCORE))
        own.append((whole if ok(whole, 0.9) else lead if ok(lead, 0.9) else line if line else whole if is_file else None, bool(is_file)))
    given = {}
    for (path, _), (b, is_file) in zip(files, own):
        if is_file and path is not None:
            d = path.rsplit("/", 1)[0] if "/" in path else ""
            given[d] = max(given.get(d, (-1, "")), b, key=lambda x: (x[0], [-ord(c) for c in x[1]] + [1]))
    out = {}
    for (path, _), (b, is_file) in zip(files, own):
        if b:
            out[path] = (b[1], "file" if is_file else "header", None)
            continue
        d = None if path is None else path.rsplit("/", 1)[0] if "/" in path else ""
        while d is not None and d not in given:
            d = None if d == "" else d.rsplit("/", 1)[0] if "/" in d else ""
        out[path] = (None, "none", None) if d is None else (given[d][1], "inherited", d)
    return out


def scanned(spark, files):
    table = spark.createDataFrame([(*f, "clash", 1) for f in files], "path string, text string, licence string, _n int")
    return {r["path"]: (r["licence"], r["via"], r["inherited_from"]) for r in licenses.scan(table, []).collect()}


def test_documents_equal_the_brute_force(spark):
    rows = [(r["doc_id"], f"{r['source']}/{r['lang']}/{r['doc_id']}", r["text"]) for r in read(spark, "/root/testdata/sf0.01", "documents").collect()]
    want = brute([(p, t) for _, p, t in rows])
    got = {r["path"]: (r["licence"], r["via"], r["inherited_from"]) for r in queries.op2_license_scan(spark, "/root/testdata/sf0.01").collect()}
    assert got == want and len({v[0] for v in want.values()}) > 4


def prose(rng, n):
    words = "the of and a to in is that it was for on are as with his they at be this from have or by one had not but what all were when we there can an your which their said if do will each about how up out them then she many some so these would other into has more her two like him see time could no make than first been its who now people my made over did down only way find use may water long little very after words called just where most know".split()
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.mark.parametrize("least", [1000, 1])
def test_a_tree_of_files(spark, monkeypatch, least):
    monkeypatch.setattr(common, "LEAST_HOT", least)
    rng = random.Random(9)
    dirs = [""] + ["/".join(rng.choice("abc") for _ in range(rng.randrange(1, 6))) for _ in range(40)]
    files = {}
    for i in range(300):
        d = rng.choice(dirs)
        files[f"{d}/f{i}.py" if d else f"f{i}.py"] = prose(rng, 30)
    for d in rng.sample(dirs, 15):
        k = rng.choice(sorted(NOTICES))
        files[f"{d}/LICENSE" if d else "LICENSE"] = rng.choice(NOTICES[k]) + "\n\n" + rng.choice(["", prose(rng, 20)])
    for i, path in enumerate(rng.sample(sorted(files), 60)):
        k = rng.choice(sorted(NOTICES))
        files[path] = "# " + rng.choice(NOTICES[k]) + "\n" + files[path]
    files |= {"x/full": TEXTS["BSD-3-Clause"][0], None: prose(rng, 9), "y/none.py": None, "y/empty.py": "", "y/LICENSE-MIT": "", "y/COPYING.txt": "Copyright 2001 A Person\nMIT License"}
    files = list(files.items())
    want = brute(files)
    got = scanned(spark, files)
    assert got == want and sum(v[1] == "inherited" for v in want.values()) > 50


def test_real_licences(spark):
    rng = random.Random(1)
    code = "\nimport os\nprint(os.name)\n"
    bsd3 = "\n".join("# " + x for x in TEXTS["BSD-3-Clause"][0].split("\n"))
    cases = {
        "gpl3/LICENSE": ("GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc.\n\n" + prose(rng, 300), "GPL-3.0"),
        "gpl2/COPYING": ("\t\t    GNU GENERAL PUBLIC LICENSE\n\t\t       Version 2, June 1991\n\n" + prose(rng, 300), "GPL-2.0"),
        "lgpl/LICENSE": ("GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1, February 1999\n\n" + prose(rng, 100), "LGPL-2.1"),
        "apache/LICENSE.txt": ("\n                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n" + prose(rng, 300), "Apache-2.0"),
        "s/a.c": ("# SPDX-License-Identifier: MIT" + code, "MIT"),
        "s/b.c": ("/* SPDX-License-Identifier: GPL-2.0-or-later */" + code, "GPL-2.0"),
        "s/c.c": ("// SPDX-License-Identifier: Some-Other-1.0" + code, None),
        "isc/LICENSE": ("ISC License\n\nCopyright (c) 2004-2010 by A Person\n\n" + TEXTS["ISC"][1], "ISC"),
        "isc/x.c": ("/*\n * " + TEXTS["ISC"][1].replace(". ", ".\n * ") + "\n */" + code, "ISC"),
        "mit/LICENSE": ("Copyright (c) 2012 A Person\n\n" + TEXTS["MIT"][1], "MIT"),
        "bsd2/LICENSE": ("Copyright (c) 2012, A Person\n\n" + TEXTS["BSD-2-Clause"][0], "BSD-2-Clause"),
        "bsd3/LICENSE": ("Copyright (c) 2012, A Person\n\n" + TEXTS["BSD-3-Clause"][0], "BSD-3-Clause"),
        "bsd3/x.py": (bsd3 + code, "BSD-3-Clause"),
        "zlib/x.h": ("/* " + TEXTS["Zlib"][0] + " */" + code, "Zlib"),
        "pd/UNLICENSE": ("This is free and unencumbered software released into the public domain.\n\n" + TEXTS["Unlicense"][0], "Unlicense"),
        "h/g.py": ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.\n#\n# " + prose(rng, 20) + code, "GPL-3.0"),
    }
    files = [(p, t) for p, (t, _) in cases.items()] + [(f"prose/{i}", prose(rng, 60)) for i in range(60)]
    got = scanned(spark, files)
    assert {p: got[p][0] for p in cases} == {p: k for p, (_, k) in cases.items()}
    assert all(got[f"prose/{i}"][1] == "none" for i in range(60))


def test_empty_table(spark):
    assert scanned(spark, []) == {}
