"""Fill-in-middle texts: prefix, middle and suffix of a text in another order, with markers.

A text is a row of n units (lines with their line ends); ``regexp_count`` gives n. Four numbers drawn from the key and a
seed choose whether the text is changed, two cuts a <= b among the n + 1 places, and the order. One match of a pattern made for the row
- possessive groups of exactly a and b - a units, then the rest - captures the three parts, and its replacement
writes them in their new order. Possessive groups give nothing back, so a match is one walk over the text and needs
no stack for its units.

The markers tell the parts apart, so a text that holds one stays plain, and so does an empty one. Null text is empty; a null key is drawn as if it
were an empty string. Rows are independent: repeated rows and rows with one key get the same cuts (of their own units). Empty
tables give no rows; the row's own columns are kept in ``row``, so no name clashes.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabveil.llm.common import content

LINES = "[^\\n]*+\\n|[^\\n]++"
MARKERS = ("<P>", "<S>", "<M>")
SEED = 7


def checked(markers: tuple[str, str, str]) -> tuple[str, str, str]:
    """The markers, if none can arise where a text and another marker meet."""
    for one in markers:
        for other in markers:
            if not one or (one != other and one in other) or any(other.endswith(one[:k]) for k in range(1, len(one))):
                raise ValueError("a marker must not begin as another one ends, nor lie within it")
    return markers


def written(marker: str) -> str:
    """As a part of a replacement."""
    return re.sub(r"([\\$])", r"\\\1", marker)


def draws(key: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32 from the seed and the key."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digits, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text before, from the output and its form."""
    p, s, m = map(re.escape, markers)
    from_psm = F.regexp_replace(output, F.lit(f"(?s)\\A{p}(.*?){s}(.*?){m}(.*)\\z"), F.lit("$1$3$2"))
    from_spm = F.regexp_replace(output, F.lit(f"(?s)\\A{s}(.*?){p}(.*?){m}(.*)\\z"), F.lit("$2$3$1"))
    return F.when(form == "psm", from_psm).when(form == "spm", from_spm).otherwise(output)


def fill_in_middle(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, percent: int = 100, spm_percent: int = 50,
    unit: str = LINES, markers: tuple[str, str, str] = MARKERS,
) -> DataFrame:
    """``row``, ``n`` units, ``form`` (plain, psm or spm), ``output``, and the lengths ``prefix_chars`` and ``middle_chars``.

    ``percent`` of the texts are changed, ``spm_percent`` of these begin with their suffix. ``unit`` is a pattern of possessive
    parts whose matches cover any text.
    """
    p, s, m = checked(markers)
    held = docs.select(F.struct("*").alias("row"), content(text).alias("body"))
    held = held.select("row", "body", F.regexp_count("body", F.lit(unit)).cast("long").alias("n"))
    first, second, third, fourth = draws(F.col("row")[key], seed)
    spread = F.col("n") + 1
    cuts = F.struct(F.least(first % spread, second % spread).alias("a"), F.greatest(first % spread, second % spread).alias("b"))
    has_marker = F.contains("body", F.lit(p)) | F.contains("body", F.lit(s)) | F.contains("body", F.lit(m))
    form = F.when((F.col("n") == 0) | has_marker | (third % 100 >= percent), "plain").when(fourth % 100 < spm_percent, "spm").otherwise("psm")
    cut = held.select("row", "body", "n", cuts.alias("cut"), form.alias("form"))

    def group(count: Column) -> Column:
        return F.concat(F.lit(f"((?:{unit}){{"), count.cast("string"), F.lit("}+)"))

    pattern = F.concat(F.lit("\\A"), group(F.col("cut.a")), group(F.col("cut.b") - F.col("cut.a")), F.lit("([\\s\\S]*+)\\z"))
    wp, ws, wm = map(written, markers)
    order = F.when(F.col("form") == "psm", f"{wp}$1{ws}$3{wm}$2").otherwise(f"{ws}$3{wp}$1{wm}$2")
    output = F.when(F.col("form") == "plain", F.col("body")).otherwise(F.regexp_replace("body", pattern, order))
    made = cut.select("row", "n", "form", output.alias("output"))

    # The markers are in no text, so their places tell the lengths.
    at_p, at_s, at_m = (F.locate(x, F.col("output")) for x in markers)
    prefix = F.when(F.col("form") == "psm", at_s - 1 - len(p)).when(F.col("form") == "spm", at_m - at_p - len(p))
    middle = F.when(F.col("form") != "plain", F.length("output") - at_m + 1 - len(m))
    return made.select("row", "n", "form", "output", prefix.cast("long").alias("prefix_chars"), middle.cast("long").alias("middle_chars"))
