"""Benchmark decontamination by winnowing.

Texts are words after lower-casing A-Z. Of each run of ``window`` words, the smallest of its k-gram
hashes (the leftmost of equals) is a fingerprint, so any two texts that share ``window`` words in
a row share a fingerprint at the same place of that run. Fingerprints of documents and items are joined;
each hit gives a document, an item and an offset between them, along which words are compared over the
whole item. Only runs of equal words as long as a window (an item shorter than that: the whole item)
count, so hash collisions do no harm.

Items of fewer than ``window`` words are looked up by the hash of all their words, among the
documents' grams of that length; other lengths are not made.

Null or wordless texts have no windows. Equal rows get equal results, one each. An item without an id
marks words but is not listed. Empty tables give no hits. Extra columns pass through in ``row``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabveil.llm.common import content, let, lower_ascii, pieces, small_side, stage

BREAKS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
WINDOW = 10
GRAM = 6


def words_of(text: Column) -> Column:
    return pieces(lower_ascii(content(text)), BREAKS)


def gram_hashes(words: Column, gram: int) -> Column:
    """Hashes of all grams, by the place of their first word."""

    def of(h: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(h) - gram),
            lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(gram)]),
        )

    made = let(F.transform(words, lambda w: F.xxhash64(w)), of)
    return F.when(F.size(words) >= gram, made).otherwise(F.array().cast("array<bigint>"))


def fingerprints(words: Column, window: int, gram: int) -> Column:
    """array<struct<p int, f long>>: places and hashes of the fingerprints."""
    span = window - gram + 1

    def chosen(g: Column) -> Column:
        least = F.transform(
            F.sequence(F.lit(1), F.size(g) - span + 1),
            lambda i: let(
                F.slice(g, i, span),
                lambda s: (i + F.array_position(s, F.array_min(s)) - 2).cast("int"),
            ),
        )
        return F.transform(
            F.array_distinct(least), lambda p: F.struct(p.alias("p"), F.get(g, p).alias("f"))
        )

    empty = F.array().cast("array<struct<p:int,f:bigint>>")
    return F.when(F.size(words) >= window, let(gram_hashes(words, gram), chosen)).otherwise(empty)


def short_grams(words: Column, lengths: list[int]) -> Column:
    """array<struct<p int, f long>>: hashes of all runs of the given lengths, which they are seeded with."""
    def of(n: int) -> Column:
        def gram(i: Column) -> Column:
            made = F.xxhash64(F.lit(n), *[F.get(words, i + j) for j in range(n)])
            return F.struct(i.alias("p"), made.alias("f"))

        made = F.transform(F.sequence(F.lit(0), F.size(words) - n), gram)
        return F.when(F.size(words) >= n, made).otherwise(F.array().cast("array<struct<p:int,f:bigint>>"))

    parts = [of(n) for n in lengths]
    return F.concat(*parts)


def hits_along(words: Column, item: Column, offset: Column, window: int) -> Column:
    """Places in ``words`` that lie in a window of ``item`` laid over it at ``offset``."""
    run = F.least(F.size(item), F.lit(window))

    def inside(equal: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(item) - run),
            lambda j: F.forall(F.slice(equal, j + 1, run), lambda x: x),
        )
        return F.array_distinct(F.flatten(F.transform(
            starts, lambda j: F.transform(F.sequence(F.lit(0), run - 1), lambda d: j + d + offset)
        )))

    equal = F.transform(
        item, lambda w, j: F.coalesce((j + offset >= 0) & (F.get(words, j + offset) == w), F.lit(False))
    )
    return let(equal, inside)


def contamination(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", window: int = WINDOW, gram: int = GRAM,
) -> tuple[DataFrame, DataFrame]:
    """(per document, hits).

    Per document, a row for each input row: ``key``, ``mark`` (hash of the text), ``n_words``.
    Hits: ``key``, ``mark``, ``item``, ``place`` of a word hit (repeated if several offsets hit it).
    """
    if not 1 <= gram <= window:
        raise ValueError("a gram has 1 to window words")
    bench = items.select(F.col(item_key).cast("string").alias("item"), words_of(F.col(item_text)).alias("v"))
    bench = stage(
        bench.where(F.size("v") > 0).distinct().withColumn("bid", F.monotonically_increasing_id()), "items"
    )
    lengths = sorted(
        r["n"] for r in bench.select(F.size("v").alias("n")).where(F.col("n") < window).distinct().collect()
    )  # at most window - 1 numbers
    marks = fingerprints(F.col("v"), window, gram)
    for n in lengths:
        marks = F.when(F.size("v") == n, short_grams(F.col("v"), [n])).otherwise(marks)
    prints = stage(
        bench.select("bid", F.explode(marks).alias("m")).select(
            "bid", F.col("m.f").alias("f"), F.col("m.p").alias("q")
        ),
        "item-prints",
    )
    known = small_side(prints.select(F.col("f").alias("known")).distinct(), "known-prints")

    keyed = docs.select(
        F.col(key).alias("key"), F.xxhash64(content(text)).alias("mark"), F.col(text).alias("body")
    )

    def printed(w: Column) -> Column:
        made = fingerprints(w, window, gram)
        made = F.concat(made, short_grams(w, lengths)) if lengths else made
        return F.struct(F.size(w).alias("n_words"), made.alias("prints"))

    spread = keyed.select("key", "mark", let(words_of(F.col("body")), printed).alias("made")).select(
        "key", "mark", F.col("made.n_words").alias("n_words"), F.posexplode_outer("made.prints").alias("at", "print")
    ).select("key", "mark", "n_words", F.coalesce("at", F.lit(0)).alias("at"), "print.p", "print.f")
    # One pass over the texts: the first row of each document stays for its counts, others only if they hit.
    found = stage(
        spread.join(known, F.col("f") == F.col("known"), "left")
        .where((F.col("at") == 0) | F.col("known").isNotNull()),
        "found-prints",
    )
    per_document = found.where("at = 0").select(F.col("key").alias(key), "mark", "n_words")
    pairs = found.where("known is not null").join(prints, "f").select(
        "key", "mark", "bid", (F.col("p") - F.col("q")).alias("offset")
    ).distinct()
    sought = stage(pairs, "sought")
    marked = sought.select(F.col("key").alias("key1"), F.col("mark").alias("mark1")).distinct()
    same = F.col("key").eqNullSafe(F.col("key1")) & (F.col("mark") == F.col("mark1"))
    texts = keyed.join(marked, same, "left_semi").dropDuplicates(["key", "mark"]).select(
        "key", "mark", words_of(F.col("body")).alias("w")
    )
    hits = sought.join(small_side(bench, "item-words"), "bid").withColumnsRenamed(
        {"key": "key1", "mark": "mark1"}
    ).join(texts, same).select(
        F.col("key").alias(key), "mark", "item",
        F.explode(hits_along(F.col("w"), F.col("v"), F.col("offset"), window)).alias("place"),
    )
    return per_document, hits


def contaminated_documents(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
) -> DataFrame:
    """``key``, ``mark``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated`` per row."""
    per_document, hits = contamination(docs, items, key, text, item_key)
    hits = stage(hits, "hits").withColumnsRenamed({key: "hit_key", "mark": "hit_mark"})
    n_hit = hits.select("hit_key", "hit_mark", "place").distinct().groupBy(
        "hit_key", "hit_mark"
    ).agg(F.count(F.lit(1)).alias("n_hit"))
    listed = hits.select("hit_key", "hit_mark", "item").distinct().groupBy("hit_key", "hit_mark").agg(
        F.count("item").alias("n_items"), F.concat_ws(",", F.sort_array(F.collect_list("item"))).alias("items")
    )
    both = n_hit.join(
        listed.withColumnsRenamed({"hit_key": "k", "hit_mark": "m"}),
        F.col("hit_key").eqNullSafe(F.col("k")) & (F.col("hit_mark") == F.col("m")),
    ).drop("k", "m")
    zero = F.lit(0).cast("long")
    return per_document.join(
        both, F.col(key).eqNullSafe(F.col("hit_key")) & (F.col("mark") == F.col("hit_mark")), "left"
    ).select(
        key, "mark", F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", zero) > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                    item_key: str = "item_id") -> DataFrame:
    """The documents in which no benchmark window occurs, with their columns as they were."""
    _, hits = contamination(docs, items, key, text, item_key)
    dirty = small_side(
        hits.select(F.col(key).alias("dirty_key"), F.col("mark").alias("dirty_mark")).distinct(), "dirty"
    )
    rows = docs.select(F.struct("*").alias("row"))
    return rows.join(
        dirty,
        F.col("row")[key].eqNullSafe(F.col("dirty_key"))
        & (F.xxhash64(content(F.col("row")[text])) == F.col("dirty_mark")),
        "left_anti",
    ).select("row.*")
