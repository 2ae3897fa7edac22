from __future__ import annotations

import textwrap
from pathlib import Path

from fundflow.llm import licenses

SCHEMA = "doc_id long, text string, line string, digest int, license_id long"


def test_matches(spark):
    mit = "Copyright (c) 2020 Some Body\n\n" + licenses.KNOWN["MIT"][0].upper().replace(" ", "  ")
    rows = [
        (1, mit),
        (2, "one line\n/* Licensed under the apache LICENCE version 2.0 */\nlast"),
        (3, "Released under the MIT License!"),
        (4, "not Released under the MIT License."),
        (5, None), (6, ""), (7, "\n\n"), (8, "(c) 2020 nobody\n# Copyright all"),
        (9, "x\n" * 50_000 + "SPDX-License-Identifier: ISC"),
        (3, "Released under the MIT License!"),
    ]
    frame = spark.createDataFrame([(i, t, "l", 1, 2) for i, t in rows], SCHEMA)
    got = licenses.matches(frame, licenses.known_digests(spark)).collect()
    assert sorted((r["doc_id"], r["line"], r["license_id"]) for r in got) == [
        (1, 0, "MIT"), (2, 2, "Apache-2.0"), (3, 0, "MIT"), (3, 0, "MIT"), (9, 50_001, "ISC"),
    ]


def test_equivalent_spellings_and_empty_table(spark):
    frame = spark.createDataFrame(
        [("The Licence, sub-licence and http://x",), ("the license sub license and https x",)], "t string"
    )
    forms = frame.select(licenses.canonical_text(licenses.canonical_lines(frame["t"])).alias("c"))
    assert {r["c"] for r in forms.collect()} == {"the license sublicense and https x"}
    known = licenses.known_digests(spark, {"A": ["same"], "B": ["Same!"]})
    two = spark.createDataFrame([(1, "SAME", "", 0, 0)], SCHEMA)
    assert sorted(r["license_id"] for r in licenses.matches(two, known).collect()) == ["A", "B"]
    assert licenses.matches(spark.createDataFrame([], SCHEMA), known).count() == 0


def test_entire_text_of_each_licence(spark):
    folder = Path(licenses.__file__).parent / "license_texts"
    texts = {f.stem: f.read_text(encoding="utf-8") for f in folder.glob("*.txt")}
    assert len(texts) >= 17 and {"Apache-2.0", "GPL-3.0", "MPL-2.0", "BSD-3-Clause"} <= set(texts)
    two = licenses.KNOWN["BSD-2-Clause"][0]
    assert "Neither the name" not in two and "2. Redistributions" in two and "AS IS" in two
    texts |= {"BSD-2-Clause": two, "MIT": licenses._MIT, "ISC": licenses._ISC}
    names = sorted(texts)
    frame = spark.createDataFrame(
        [(k, texts[n].replace(" ", "  "), "l", 1, 2) for k, n in enumerate(names)], SCHEMA
    )
    known = licenses.known_digests(spark)
    got = licenses.matches(frame, known).filter("line = 0").collect()
    assert sorted((names[r["doc_id"]], r["license_id"]) for r in got) == [(n, n) for n in names]
    table = spark.createDataFrame([("Own-1", "one own text")], "license_id string, text string")
    own = licenses.matches(spark.createDataFrame([(1, "One own TEXT", "", 0, 0)], SCHEMA),
                           licenses.known_digests(spark, table))
    assert [r["license_id"] for r in own.collect()] == ["Own-1"]


def test_line_breaks_and_list_items_lose_no_words(spark):
    own = "Terms. (a) one thing; (b) the other thing, and (c) you must keep this list of conditions."
    texts = {"MIT": licenses._MIT, "ISC": licenses._ISC, "Own": own}
    heads = ["", "Copyright (c) 2020 Some Body\n(C) 1999-2001 by X\n\n", "Copyright Some, Inc.\n\n",
             "(c) Acme Corp\n\n", "Copyright [yyyy] [name]\n© Y\n"]
    cases = []
    for name, text in texts.items():
        for width in range(40, 101):
            wrapped = "\n".join(textwrap.wrap(text, width))
            cases.append((name, heads[width % len(heads)] + wrapped))
            cases.append((name, textwrap.indent(wrapped, "# ")))
    cases.append(("Own", own.replace("(c)", "\n(c)").replace("must", "must\n")))
    frame = spark.createDataFrame([(k, t, "", 0, 0) for k, (_, t) in enumerate(cases)], SCHEMA)
    known = licenses.known_digests(spark, {n: [t] for n, t in texts.items()})
    got = licenses.matches(frame, known).filter("line = 0").collect()
    have = {(r["doc_id"], r["license_id"]) for r in got}
    assert have == {(k, n) for k, (n, _) in enumerate(cases)}
