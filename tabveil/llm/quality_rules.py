"""Quality rules whose cutoffs carry a guarantee on labelled good documents.

A rule rejects a document if a share measured on it exceeds a cutoff. For every stratum, rule and
cutoff of a grid, the labelled good documents of the stratum are a holdout: with ``r`` of ``n``
rejected, the cutoff is admitted if a rejection rate of ``risk / number of rules`` would give ``r`` or
fewer with a probability of at most ``error / number of tests`` (exact binomial tail, Bonferroni over
strata, rules and cutoffs). The strictest admitted cutoff is used; without one the rule is off in that
stratum. With probability ``1 - error``, in all strata at once, at most ``risk`` of the good documents
are rejected by the rules.

Null text: no words. A null stratum is a stratum of its own. Labels that are null count as missing,
repeated labels count once, and a document labelled both good and bad counts as bad. Repeated
documents with one label count as often as they occur. Without labels or documents no rule is on.
Other columns pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabveil.llm.common import SPACES, content, let, pieces, small_side, stage, total
from tabveil.session import BROADCAST_ROWS

SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50

#: Production parameters: rule -> cutoffs, strictest first.
CUTOFFS = {
    "symbols": (0.05, 0.1, 0.2, 0.3, 0.5, 1.0),
    "copied_lines": (0.1, 0.2, 0.3, 0.4, 0.5, 0.7),
    "repeated_words": (0.1, 0.2, 0.3, 0.4),
    "word_length": (7.0, 8.0, 10.0, 12.0, 15.0, 20.0),
}
RISK = 0.02
ERROR = 0.05


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the array.

    Windows are sorted as whole numbers first, the upper bits of a window's hash before its place, which is far cheaper than sorting
    structs; whole hashes are compared only among neighbours whose upper bits agree.
    """

    def hashed(i: Column) -> Column:
        return F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))

    def window(i: Column) -> Column:
        return F.struct(hashed(i).alias("h"), i.alias("i"))

    def candidates(bits: Column) -> Column:
        """Windows whose upper bits are those of another one, as structs in order."""

        def packed(i: Column) -> Column:
            return F.call_function("shiftleft", hashed(i), bits).bitwiseOR(i.cast("long"))

        def near(x: Column, y: Column) -> Column:
            return F.call_function("shiftrightunsigned", x.bitwiseXOR(y), bits) == 0

        def alike(ordered: Column) -> Column:
            kept = F.filter(ordered, lambda x, k: near(x, F.get(ordered, k + 1)) | near(x, F.get(ordered, k - 1)))
            number = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
            found = F.transform(kept, lambda x: window(x.bitwiseAND(number).cast("int")))
            return F.sort_array(found)

        return let(F.sort_array(F.transform(starts, packed)), alike)

    def spots(ordered: Column) -> Column:
        same = F.filter(
            ordered,
            lambda x, k: F.coalesce(F.get(ordered, k - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(ordered, k + 1)["h"] == x["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(same, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        reach = F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3))))
        return total(reach.cast("array<bigint>"))

    starts = F.sequence(F.lit(0), F.size(words) - 3)
    counted = let(let(let(F.length(F.bin(F.size(words))), candidates), spots), covered)
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(counted)


def measures(body: Column) -> Column:
    """struct of what the rules need, from one text."""
    # A text in which the symbols stand between parts has one part more than symbols.
    symbols = F.size(F.split(body, f"[{SYMBOLS}]")) - 1
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    by_word = let(pieces(body, SPACES), lambda w: F.struct(
        F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("chars"), repeated_words(w).alias("repeated")
    ))
    by_line = let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct")))

    def named(m: Column) -> Column:
        return F.struct(
            m["word"]["n"].cast("long").alias("n_words"),
            m["word"]["chars"].cast("long").alias("word_chars"),
            symbols.cast("long").alias("n_symbols"),
            m["line"]["n"].cast("long").alias("n_lines"),
            (m["line"]["n"] - m["line"]["distinct"]).cast("long").alias("n_dup_lines"),
            m["word"]["repeated"].alias("n_repeat_words"),
        )

    return let(F.struct(by_word.alias("word"), by_line.alias("line")), named)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of the documents in ``row``, and what the rules need.

    The measures leave a generator, so that a later filter on them isn't moved below and evaluated twice.
    """
    rows = docs.select(F.struct("*").alias("row"))
    return rows.select("row", F.inline(F.array(measures(content(F.col("row")[text])))))


def rule_values() -> dict[str, Column]:
    """What each rule compares with its cutoff."""
    words, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "symbols": F.col("n_symbols") / words,
        "copied_lines": F.col("n_dup_lines") / lines,
        "repeated_words": F.col("n_repeat_words") / words,
        "word_length": F.col("word_chars") / words,
    }


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def stratum_of(column: str) -> Column:
    return F.coalesce(F.col("row")[column].cast("string"), F.lit("\x00null"))


def binomial_tail(r: Column, n: Column, rate: float) -> Column:
    """P(at most r of n) when each has probability ``rate``; exact up to rounding, for r below n * rate.

    The largest term is summed in logarithms; the others follow from it as a falling series.
    """
    odds = math.log(rate / (1 - rate))
    log_top = F.aggregate(
        F.when(r > 0, F.sequence(F.lit(1).cast("long"), r)).otherwise(F.array().cast("array<bigint>")),
        n * F.lit(math.log1p(-rate)),
        lambda a, j: a + F.log((n - j + 1) / j) + F.lit(odds),
    )
    series = F.aggregate(
        F.sequence(r, F.lit(0).cast("long")),
        F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("term")),
        lambda a, j: F.struct(
            (a["sum"] + a["term"]).alias("sum"),
            (a["term"] * j / (n - j + 1) * F.lit((1 - rate) / rate)).alias("term"),
        ),
    )["sum"]
    return F.exp(log_top) * series


def calibrate(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang",
    cutoffs: dict = CUTOFFS, risk: float = RISK, error: float = ERROR,
) -> DataFrame:
    """(stratum, rule, cutoff): the strictest admitted cutoff of each rule that is on."""
    good = (
        labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col(key).alias("labelled")).agg(F.min("quality").alias("quality"))
        .where("quality = 1").select("labelled")
    )
    good = stage(good, "good")
    kept = docs.select(key, text, stratum)
    if good.count() <= BROADCAST_ROWS:
        # Few labels: only labelled documents are measured.
        kept = kept.join(F.broadcast(good), F.col(key) == F.col("labelled"), "left_semi")
        holdout = measured(kept, text)
    else:
        # Many: all are measured, and the small rows meet their labels; texts aren't shuffled.
        holdout = measured(kept, text).withColumn("known", F.col("row")[key]).withColumn(
            "row", F.struct(F.col("row")[stratum].alias(stratum))
        ).join(good, F.col("known") == F.col("labelled"), "left_semi")
    # One narrow aggregate: a column of counts for each rule and cutoff.
    values, counted = rule_values(), ~base_failed()
    grid = [(rule, c) for rule, cuts in cutoffs.items() for c in cuts]
    counts = holdout.groupBy(stratum_of(stratum).alias("stratum")).agg(
        F.count_if(counted).alias("n"),
        *[F.count_if(counted & (values[rule] > c)).alias(f"r{i}") for i, (rule, c) in enumerate(grid)],
    )
    counts = stage(counts, "holdout").where("n > 0")
    tests = max(counts.count(), 1) * len(grid)
    rate = risk / len(cutoffs)
    rows = counts.select("stratum", "n", F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(float(c)).alias("cutoff"), F.col(f"r{i}").alias("r"))
        for i, (rule, c) in enumerate(grid)
    ])).alias("test")).select("stratum", "n", "test.*")
    admitted = rows.where(
        (F.col("r") < F.col("n") * F.lit(rate))
        & (binomial_tail(F.col("r"), F.col("n"), rate) <= F.lit(error / tests))
    )
    return admitted.groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))


def judge(
    docs: DataFrame, chosen: DataFrame, text: str = "text", stratum: str = "lang",
    cutoffs: dict = CUTOFFS,
) -> DataFrame:
    """``row``, the measures, ``base_failed`` and ``kept`` of every document."""
    limits = chosen.groupBy("stratum").agg(*[
        F.min(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(f"most_{rule}") for rule in cutoffs
    ])
    limits = small_side(limits, "limits").withColumnRenamed("stratum", "limit_of")
    held = measured(docs, text).join(limits, stratum_of(stratum) == F.col("limit_of"), "left")
    values, over = rule_values(), F.lit(False)
    for rule in cutoffs:
        over = over | F.coalesce(values[rule] > F.col(f"most_{rule}"), F.lit(False))
    return held.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & ~over
    ).drop("limit_of", *[f"most_{rule}" for rule in cutoffs])


def quality_filter(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                   stratum: str = "lang") -> DataFrame:
    """The documents that pass, with their columns as they were."""
    chosen = calibrate(docs, labels, key, text, stratum)
    return judge(docs, chosen, text, stratum).where("kept").select("row.*")
