"""Licence scans by canonical digests.

A text is brought to a canonical form: lower case, copyright statements taken
out (not lines of a licence that happen to begin with the word or with "(c)"), every run of other than letters and digits one blank, equivalent spellings made
one. The SHA-256 digests of the whole canonical text and of each of its lines
are hash-joined with those of known licence texts and notices.

Defined results: a NULL text is an empty one; empty texts and lines, and lines
that are only a copyright statement, match nothing; a text of one line is
looked up as a whole only; if several known texts have one digest, each is a
match; repeated rows each get their matches; extra columns are ignored. Matches
are exact: a text with other words around a licence matches by its lines or not at all.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundflow.llm.common import plain

# Spellings that licence texts use for one another.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("favour", "favor"),
    ("fulfil", "fulfill"),
    ("initialise", "initialize"),
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("organisation", "organization"),
    ("recognised", "recognized"),
    ("sub license", "sublicense"),
    ("utilise", "utilize"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("http", "https"),
)

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice
and this permission notice shall be included in all copies or substantial portions of the
Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice
appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT
SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""

# The notices that name a licence.
NOTICES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License.",
    ),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.",),
    "ISC": (_ISC, f"ISC License {_ISC}", f"The ISC License {_ISC}"),
    "MIT": (
        _MIT,
        f"MIT License {_MIT}",
        f"The MIT License {_MIT}",
        f"The MIT License (MIT) {_MIT}",
        "Released under the MIT License.",
    ),
}
_GNU = """This program is free software{sep} you can redistribute it and/or modify it under the terms
of the GNU {kind}General Public License as published by the Free Software Foundation{either} version
{version} of the License, or (at your option) any later version. This program is distributed in the
hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public License for more
details. You should have received a copy of the GNU {kind}General Public License along with this
program. If not, see <https://www.gnu.org/licenses/>."""
_BSD_NAMES = (
    ("the University nor the names of its", "the copyright holder nor the names of its"),
    ("THE REGENTS OR CONTRIBUTORS", "THE COPYRIGHT HOLDER OR CONTRIBUTORS"),
    ("THE REGENTS AND CONTRIBUTORS", "THE COPYRIGHT HOLDERS AND CONTRIBUTORS"),
)


def _variants(name: str, text: str) -> list[str]:
    """A licence file and the other forms in which it is given out whole."""
    out = [text]
    end = re.search(r"END OF TERMS AND CONDITIONS", text)
    if end:  # without the appendix on how to apply it
        out += [text[: end.start()], text[: end.end()]]
    if name == "Apache-2.0":
        out.append(text[text.index("Licensed under the Apache License") :])
    elif name == "MPL-2.0":
        header = text[text.index("This Source Code Form is subject") :]
        out.append(header[: header.index("If it is not possible")])
    elif name == "BSD-3-Clause":
        for old, new in _BSD_NAMES:
            text = text.replace(old, new)
        holders = text.replace("HOLDER OR CONTRIBUTORS", "HOLDERS OR CONTRIBUTORS")
        owner = text.replace("HOLDER OR CONTRIBUTORS", "OWNER OR CONTRIBUTORS")
        out += [text, holders, owner]
        out += [re.sub(r"(?m)^[123][.]", "*", t) for t in out]
        out += [f"{title} {t}" for t in out for title in ("BSD 3-Clause License",)]
    return out


def _known() -> dict[str, tuple[str, ...]]:
    """The licence files beside this module (read by the driver), headers, notices and SPDX tags."""
    found = {name: list(texts) for name, texts in NOTICES.items()}
    for file in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        text = file.read_text(encoding="utf-8")
        found.setdefault(file.stem, []).extend(_variants(file.stem, text))
    for text in list(found.get("BSD-3-Clause", [])):
        two = re.sub(r"(?ms)^([3*][.]?) +Neither the name.*?permission[.]\s*", "", text)
        two = two.replace("BSD 3-Clause", "BSD 2-Clause")
        found.setdefault("BSD-2-Clause", []).append(two)
    for name in [n for n in found if n.startswith(("GPL-", "LGPL-"))] + ["AGPL-3.0"]:
        kind = {"L": "Lesser ", "A": "Affero ", "G": ""}[name[0]]
        kind = "Library " if name == "LGPL-2.0" else kind
        version = name.partition("-")[2].removesuffix(".0")
        for sep, either in ((";", "; either"), (":", ", either")):
            header = _GNU.format(kind=kind, version=version, sep=sep, either=either)
            texts = found.setdefault(name, [])
            texts += [header, header.replace("This program", "This library")
                      .replace("this program", "this library")]
        texts += [f"SPDX-License-Identifier: {name}-{suffix}" for suffix in ("only", "or-later")]
    return {
        name: tuple(dict.fromkeys([*texts, f"SPDX-License-Identifier: {name}"]))
        for name, texts in sorted(found.items())
    }


KNOWN: dict[str, tuple[str, ...]] = _known()

_YEAR = r"([0-9]{4}|y{4}|year\b)"
#: A line that begins with copyright, (c) or the sign, and a year, "by" or another sign.
COPYRIGHT_LINE = (
    r"(?i)(^|\n)[^\p{L}\p{N}\n]*(©|(\(c\)[^\p{L}\p{N}\n]*)?copyright[^\p{L}\p{N}\n]*"
    rf"(©|\(c\)|by\b|{_YEAR})|\(c\)[^\p{{L}}\p{{N}}\n]*(©|{_YEAR}))[^\n]*"
)
#: A paragraph that is one short line of copyright or (c) and a name.
COPYRIGHT_NAME = (
    r"(^|\n[^\p{L}\p{N}\n]*\n)[^\p{L}\p{N}\n]*([Cc]opyright|COPYRIGHT|\([Cc]\))[ \t]+([Tt]he[ \t]+)?"
    r"\p{Lu}[^\n]{0,60}(?=\n[^\p{L}\p{N}\n]*(\n|$)|$)"
)


def canonical_lines(text: Column) -> Column:
    """The canonical form of each line of a text."""
    flat = F.regexp_replace(F.coalesce(text, F.lit("")), COPYRIGHT_LINE, "$1")
    flat = F.regexp_replace(flat, COPYRIGHT_NAME, "$1")
    flat = F.regexp_replace(F.lower(flat), r"[^\p{L}\p{N}\n]+", " ")
    flat = F.concat(F.lit(" "), F.replace(flat, F.lit("\n"), F.lit(" \n ")), F.lit(" "))
    for other, one in SPELLINGS:
        flat = F.replace(flat, F.lit(f" {other} "), F.lit(f" {one} "))
    return F.transform(F.split(flat, "\n"), lambda x: F.trim(x))


def canonical_text(lines: Column) -> Column:
    return F.array_join(F.filter(lines, lambda x: x != ""), " ")


def known_digests(
    spark: SparkSession, known: Mapping[str, Sequence[str]] | DataFrame = KNOWN
) -> DataFrame:
    """``license_id``, ``digest`` of the known texts.

    ``known`` may be a table of any size with ``license_id`` and ``text``.
    """
    if isinstance(known, DataFrame):
        texts = known.select("license_id", "text")
    else:
        rows = [(name, text) for name, texts in known.items() for text in texts]
        texts = spark.createDataFrame(rows, "license_id string, text string")
    whole = canonical_text(canonical_lines(F.col("text")))
    return texts.select("license_id", F.sha2(whole, 256).alias("digest")).distinct()


def matches(
    docs: DataFrame,
    known: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per match: id, ``line`` (0: the whole text), ``license_id``, ``digest``.

    Whether the known side is broadcast is left to its measured size.
    """
    key, body = plain(docs, [ident, text])
    lines = docs.select(key.alias(ident), canonical_lines(body).alias("lines"))
    units = lines.select(
        ident,
        F.posexplode(
            F.when(F.size("lines") > 1,
                   F.concat(F.array(canonical_text(F.col("lines"))), F.col("lines")))
            .otherwise(F.col("lines"))
        ).alias("line", "unit"),
    ).filter("unit <> ''")
    digests = units.select(ident, "line", F.sha2("unit", 256).alias("digest"))
    return digests.join(known, "digest").select(ident, "line", "license_id", "digest")
