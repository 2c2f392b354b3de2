"""Licence scans by canonical digest.

Texts are brought to a canonical form - lower case, no copyright lines, one spelling of equivalent words,
punctuation and white space as single blanks - and the SHA-256 of the whole canonical text is joined
with the digests of known licences. The same lookup runs over whole lines, which finds notices inside
longer texts. No similarity is guessed: a text is a known licence or it isn't.

Null, empty and wordless texts match nothing. Repeated rows get a row each. If known licences agree after
normalising, the smallest name counts. Extra columns don't matter.
"""

from __future__ import annotations

import re
from itertools import count
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabveil.llm.common import content, let, small_side

# Spellings that count as equal, from the public guidelines on matching licences.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"),
    ("artefact", "artifact"), ("authorisation", "authorization"), ("authorised", "authorized"),
    ("calibre", "caliber"), ("cancelled", "canceled"), ("capitalisations", "capitalizations"),
    ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"),
    ("copyright owner", "copyright holder"), ("emphasised", "emphasized"), ("favour", "favor"),
    ("favourite", "favorite"), ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"),
    ("labelling", "labeling"), ("labour", "labor"), ("licence", "license"), ("licences", "licenses"),
    ("licenced", "licensed"), ("maximise", "maximize"), ("modelled", "modeled"), ("modelling", "modeling"),
    ("noncommercial", "non commercial"), ("offence", "offense"), ("optimise", "optimize"),
    ("organisation", "organization"), ("organise", "organize"),
    ("practise", "practice"), ("programme", "program"), ("realise", "realize"),
    ("recognise", "recognize"), ("signalling", "signaling"), ("sublicence", "sublicense"),
    ("sub license", "sublicense"), ("utilisation", "utilization"), ("whilst", "while"),
    ("wilful", "willful"), ("wilfull", "willful"), ("per cent", "percent"), ("https", "http"),
)

# Known licences and notices, by SPDX name.
KNOWN = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
and associated documentation files (the "Software"), to deal in the Software without restriction, including
without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies
of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following
conditions: The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
)

# Published texts, a file each: SPDX name, then whose wording it is if there are several.
TEXTS = Path(__file__).parent / "licences"
# How many of a text's first lines that are not blank are its title.
TITLE_LINES = {
    "Apache-2.0": 3, "Artistic-1.0-Perl": 1, "CC0-1.0": 2, "MPL-1.1": 3, "MPL-2.0": 2,
    **{n: 2 for n in (
        "GFDL-1.2-only", "GFDL-1.3-only", "GPL-1.0-only", "GPL-2.0-only", "GPL-3.0-only",
        "LGPL-2.0-only", "LGPL-2.1-only", "LGPL-3.0-only",
    )},
}
# Titles of texts that are published with and without one.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License"),
}
RESERVED = "All rights reserved."
BULLET = re.compile(r"(?m)^[ \t]*(?:\*|[0-9]\.)(?= )")
END = "END OF TERMS AND CONDITIONS"


def forms(name: str, text: str) -> list[str]:
    """A whole text with and without its title, and with and without what follows its end; list items numbered or not."""
    if name in TITLES:
        at = count(1)
        bodies = {text, BULLET.sub("*", text), BULLET.sub(lambda _: f"{next(at)}.", text)}
        return [f"{t}\n{r}\n{b}" for b in sorted(bodies) for t in ("", *TITLES[name]) for r in ("", RESERVED)]
    lines = [x for x in text.split("\n") if x.strip()]
    whole = ["\n".join(lines), "\n".join(lines[TITLE_LINES[name]:])]
    return whole + [x[:x.index(END) + len(END)] for x in whole if END in x]


def published_texts() -> tuple:
    """(name, text) of all forms of the published texts, read on the driver."""
    found = [(f.name.removesuffix(".txt").removesuffix(".regents"), f.read_text("utf-8")) for f in sorted(TEXTS.glob("*.txt"))]
    found += [(n, t) for n, t in KNOWN if n in TITLES and "\n" in t]
    return tuple((n, form) for n, t in found for form in forms(n, t))


def canonical(text: Column) -> Column:
    """The canonical form; each spelling is replaced only where it occurs at all."""
    pairs = F.array(*[F.struct(F.lit(one).alias("one"), F.lit(other).alias("other")) for one, other in SPELLINGS])

    def without_owner(lower: Column) -> Column:
        return F.when(
            F.contains(lower, F.lit("copyright")) | F.contains(lower, F.lit("(c)")) | F.contains(lower, F.lit("©")),
            F.regexp_replace(
                lower, r"(?m)^[ \t]*(?:copyright[ \t]+(?:\(c\)|©|[0-9])|\(c\)|©)[^\n]*$", " "
            ),
        ).otherwise(lower)

    made = F.trim(F.regexp_replace(let(F.lower(text), without_owner), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", " "))
    return F.aggregate(
        pairs, made,
        lambda a, x: F.when(
            F.contains(a, x["one"]), F.regexp_replace(a, F.concat(F.lit("\\b"), x["one"], F.lit("\\b")), x["other"])
        ).otherwise(a),
    )


def digest(text: Column) -> Column:
    """Null if nothing is left of the text."""
    return let(canonical(text), lambda made: F.when(made != "", F.sha2(made, 256)))


def known_licences(spark: SparkSession, known: tuple | None = None) -> DataFrame:
    """(license, license_text): ``known``, or else the notices above and all published texts."""
    return spark.createDataFrame(list(KNOWN + published_texts() if known is None else known), "license string, license_text string")


def digests_of(known: DataFrame) -> DataFrame:
    """(known_digest, license): one row for each canonical text."""
    made = known.select("license", digest(content("license_text")).alias("known_digest"))
    return made.where("known_digest is not null").groupBy("known_digest").agg(F.min("license").alias("license"))


def license_matches(docs: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``digest`` of the whole text, ``text_license`` (null: unknown), ``notices``: licences of its
    lines, sorted, and ``n_notice_lines``; a row for each input row."""
    names = small_side(digests_of(known), "licences")
    rows = docs.select(
        F.col(key).alias("key"), F.xxhash64(content(text)).alias("mark"), content(text).alias("body")
    )
    by_line = (
        rows.select("key", "mark", F.posexplode(F.split("body", "\n")).alias("at", "line"))
        .select("key", "mark", "at", digest(F.col("line")).alias("known_digest"))
        .join(names, "known_digest").groupBy("key", "mark")
        .agg(
            F.sort_array(F.collect_set("license")).alias("notices"),
            F.countDistinct("at").alias("n_notice_lines"),
        )
        .withColumnsRenamed({"key": "line_key", "mark": "line_mark"})
    )
    whole = rows.select("key", "mark", digest(F.col("body")).alias("digest")).join(
        names, F.col("digest") == F.col("known_digest"), "left"
    )
    return whole.join(
        by_line, F.col("key").eqNullSafe(F.col("line_key")) & (F.col("mark") == F.col("line_mark")), "left"
    ).select(
        F.col("key").alias(key), "digest", F.col("license").alias("text_license"),
        F.coalesce("notices", F.array().cast("array<string>")).alias("notices"),
        F.coalesce("n_notice_lines", F.lit(0).cast("long")).alias("n_notice_lines"),
    )
