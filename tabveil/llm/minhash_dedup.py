"""Near copies by bottom-k sketches of one hash function.

A document's set is its distinct shingles of ``size`` words (ASCII lower case, ASCII white space); with fewer words,
the whole sequence. Documents with equal sets form a class, found by a 128-bit digest of the set. A class keeps the
``k`` smallest shingle hashes. Classes that share retained values are candidates: sketches are read rarest value
first, and only as many values go to the inverted lists as a pair above the threshold cannot miss (a set that
fits its sketch: exactly; a larger one: unless fewer than ``least_overlap`` of k values agree, six and a
half deviations below the mean). The smallest k values of two sketches' union estimate the similarity; pairs that
may reach the threshold are verified on their full sets. A parity signature rules out pairs before that: each shingle
flips one of 256 bits, so two signatures differ in no more bits than the sets differ in shingles.

Links are found in two passes, as a group of n near copies has n * n pairs. Each list names two hubs: its member
whose values are the most frequent ones (the original of a group, if there is one) and its first. First each class meets
the hub that it shares most lists with; linked classes become one component. Then, in lists that still hold several
components, everything outside the most frequent one meets the members of other components. Pairs within a component
need no test, so no link between components is lost.

Null text and texts without words have an empty set and no links. Rows with equal keys are separate documents that
share the key; a null key is no component id unless no other is there. Repeated rows get equal results. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabveil.llm.common import content, drop, small_side, stage
from tabveil.llm.components import components

K = 64
LEAST_OVERLAP = 30
PERCENT = 80
BUCKETS = 1 << 16
PARITY = ["p0", "p1", "p2", "p3"]


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes."""
    import xxhash

    words = text.lower().split()  # bytes: only ASCII letters and blanks
    if not words:
        return np.zeros(0, "u8")
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), "u8", len(words))
    size = min(size, len(h))
    n = len(h) - size + 1
    made = np.full(n, size, "u8")
    for j in range(size):
        made = (made ^ h[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
        made ^= made >> np.uint64(29)
    made *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(made ^ (made >> np.uint64(32)))


def signed(values: np.ndarray) -> np.ndarray:
    """As 64-bit integers of the same order."""
    return (values ^ np.uint64(1 << 63)).view("i8")


def digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def parities(sets: list[np.ndarray]) -> list[pa.Array]:
    """64 bits of each set's signature in every column of ``PARITY``: whether an odd number of hashes fell on a bit."""
    width = 64 * len(PARITY)
    odd = [np.bincount((s & np.uint64(width - 1)).view("i8"), minlength=width) & 1 for s in sets]
    bits = np.packbits(np.array(odd, "u1").reshape(-1, width), axis=1).view("i8")
    return [pa.array(np.ascontiguousarray(bits[:, j])) for j in range(len(PARITY))]


def listed(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*arrays, np.zeros(0, "i8")]), pa.int64()))


def sketches(docs: DataFrame, key: str, text: str, size: int, k: int) -> DataFrame:
    """(key, mark, n, digest, sketch, signature) of each row; digest null for an empty set."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(content(text)).alias("mark"), content(text).alias("body"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                counts, digests, kept, sets = [], [], [], []
                for t in part.column(2).cast(pa.binary()).to_pylist():
                    values = shingle_set(t, size)
                    counts.append(len(values))
                    digests.append(digest(values) if len(values) else None)
                    kept.append(signed(values[:k]))
                    sets.append(values)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), listed(kept), *parities(sets)],
                    ["key", "mark", "n", "digest", "sketch", *PARITY],
                )

    schema = "key long, mark long, n long, digest binary, sketch array<long>"
    return rows.mapInArrow(make, schema + "".join(f", {p} long" for p in PARITY))


def prefix_rows(classes: DataFrame, k: int, least_overlap: int, percent: int) -> DataFrame:
    """(value, node, n, weight): the retained values by which a class is looked up; the weight says how frequent all its values are."""
    bucket = F.col("value").bitwiseAND(BUCKETS - 1)
    counts = classes.select(F.explode("sketch").alias("value")).groupBy(bucket.alias("bucket")).count()
    # A fixed number of counters, whatever the input: rarity by hash bucket.
    frequency = np.zeros(BUCKETS, "i8")
    for bucket_number, n in counts.toPandas().itertuples(index=False):
        frequency[bucket_number] = n

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            values = batch.column(2).flatten().to_numpy()
            lengths = np.minimum(sizes, k)
            owner = np.repeat(np.arange(len(nodes)), lengths)
            often = frequency[values & (BUCKETS - 1)]
            weight = np.bincount(owner, np.log(np.maximum(often, 1)), len(nodes)) / np.maximum(lengths, 1)
            order = np.lexsort((values, often, owner))
            rank = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            # Sets up to this size only meet sets that fit their sketch as well.
            exact = sizes * 100 <= k * percent
            agree = np.where(exact, -(-sizes * percent // 100), np.minimum(least_overlap, lengths))
            keep = rank < np.repeat(lengths - agree + 1, lengths)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[keep]) for a in (values[order], nodes[owner], sizes[owner], weight[owner])],
                ["value", "node", "n", "weight"],
            )

    return classes.select("node", "n", "sketch").mapInArrow(make, "value long, node long, n long, weight double")


def sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def alike(a: str, b: str, percent: int) -> Column:
    """Whether two classes' signatures let them reach the threshold; columns end in ``a`` and ``b``.

    No more than this share of both sets is in one only.
    """
    apart = sum((F.bit_count(F.col(p + a).bitwiseXOR(F.col(p + b))) for p in PARITY), F.lit(0))
    return apart * (100 + percent) <= (F.col("n" + a) + F.col("n" + b)) * (100 - percent)


def signatures(suffix: str) -> list[Column]:
    return [F.col(p).alias(p + suffix) for p in PARITY]


def estimated(pairs: DataFrame, classes: DataFrame, k: int, least_overlap: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose union sketch lets them reach the threshold."""
    one = classes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"), *signatures("a"))
    two = classes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"), *signatures("b"))
    both = F.array_intersect("sa", "sb")
    union = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, k)
    agree = F.size(F.array_intersect(both, union))
    whole = F.size(both)
    fits = F.when(
        (F.col("na") <= k) & (F.col("nb") <= k), whole * 100 >= (F.col("na") + F.col("nb") - whole) * percent
    ).otherwise(agree >= least_overlap)
    return pairs.join(one, "a").join(two, "b").where(alike("a", "b", percent)).where(fits).select("a", "b")


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, key: str, text: str, size: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold, written."""
    pairs = stage(pairs, "estimated")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = small_side(
        nodes.join(classes, "node").select(F.col("node"), F.col("digest").alias("want"), F.col("key").alias("want_key")), "wanted"
    )
    rows = docs.select(F.col(key).cast("long").alias("key"), content(text).alias("body")).join(
        wanted, F.col("key").eqNullSafe(F.col("want_key"))
    ).select("node", "want", "body")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                kept = []
                bodies = part.column(2).cast(pa.binary()).to_pylist()
                for node, want, body in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), bodies):
                    values = shingle_set(body, size)
                    if digest(values) == want:  # else another document with the same key
                        kept.append((node, signed(values)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n for n, _ in kept], pa.int64()), listed([v for _, v in kept])], ["node", "values"]
                )

    sets = stage(rows.mapInArrow(make, "node long, values array<long>").dropDuplicates(["node"]), "sets")
    inter = F.size(F.array_intersect("va", "vb"))
    links = stage(pairs.join(sets.toDF("a", "va"), "a").join(sets.toDF("b", "vb"), "b").where(
        inter * 100 >= (F.size("va") + F.size("vb") - inter) * percent
    ).select("a", "b"), "links")
    drop(pairs, wanted, sets)
    return links


def near_copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = PERCENT, k: int = K,
    least_overlap: int = LEAST_OVERLAP,
) -> DataFrame:
    """(key, mark, n_shingles, component_id, kept, group) of each row; groups that share a key share a component id."""
    made = stage(sketches(docs, key, text, size, k), "sketches")
    rows = stage(made.select("key", "mark", "n", "digest"), "rows")
    classes = stage(
        made.where("digest is not null").groupBy("digest").agg(
            F.min("key").alias("key"), F.first("n").alias("n"), F.first("sketch").alias("sketch"),
            *[F.first(p).alias(p) for p in PARITY],
        ).withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    drop(made)
    prefixes = stage(prefix_rows(classes, k, least_overlap, percent), "prefixes")
    lists = prefixes.groupBy("value").agg(
        F.count(F.lit(1)).alias("members"), F.min(F.struct("node", "n")).alias("low"),
        F.max_by(F.struct("node", "n"), F.struct("weight", "node")).alias("high"),
    ).where("members > 1").drop("members")
    members = stage(prefixes.drop("weight").join(lists, "value"), "members")
    drop(prefixes)

    # First pass: each class and the hub of most of its lists.
    hubs = F.array_distinct(F.array("low", "high"))
    to_hubs = members.select("node", "n", F.explode(hubs).alias("hub")).where(
        (F.col("node") != F.col("hub.node")) & sizes_fit(F.col("n"), F.col("hub.n"), percent)
    )
    often = to_hubs.groupBy("node", F.col("hub.node").alias("hub")).agg(F.count(F.lit(1)).alias("c"))
    best = often.groupBy("node").agg(F.max(F.struct("c", "hub")).getField("hub").alias("hub"))
    pairs = stage(best.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct(), "pairs")
    links = verified(estimated(pairs, classes, k, least_overlap, percent), docs, classes, key, text, size, percent)
    roots = components(links)

    # Second pass: what is still apart in a list.
    placed = members.select("value", "node", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    counted = placed.groupBy("value", "root").agg(F.count(F.lit(1)).alias("c"))
    main = counted.groupBy("value").agg(F.max(F.struct("c", "root")).alias("m"), F.count(F.lit(1)).alias("roots"))
    open_lists = main.where("roots > 1").select("value", F.col("m.root").alias("main"))
    placed = stage(placed.join(open_lists, "value").join(classes.select("node", *PARITY), "node"), "placed")
    drop(members)
    one = placed.where("root <> main").select(
        "value", F.col("node").alias("a"), F.col("n").alias("na"), F.col("root").alias("ra"), *signatures("a")
    )
    two = placed.select("value", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("root").alias("rb"), "main", *signatures("b"))
    apart = (F.col("ra") != F.col("rb")) & ((F.col("rb") == F.col("main")) | (F.col("a") < F.col("b")))
    more = one.join(two, "value").where(apart & sizes_fit(F.col("na"), F.col("nb"), percent) & alike("a", "b", percent)).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct()
    more = stage(more, "apart")
    drop(placed)
    met = more.join(pairs, ["a", "b"], "left_anti")
    late = verified(estimated(met, classes, k, least_overlap, percent), docs, classes, key, text, size, percent)
    drop(more, pairs)
    if not late.isEmpty():
        roots = components(links.union(late))

    whole = classes.select("digest", "node", "key").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = whole.groupBy("root").agg(F.min("key").alias("component_id"))
    named = whole.join(ids, "root").select(F.col("digest").alias("of"), "component_id", F.col("root").alias("group"))
    joined = rows.select("key", "mark", "n", "digest").join(named, F.col("digest") == F.col("of"), "left")
    component = F.when(F.col("digest").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return joined.select(
        F.col("key").alias(key), "mark", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("key").eqNullSafe(component).alias("kept"), "group",
    )


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = PERCENT) -> DataFrame:
    """One document of each group, with its columns as they were; all documents with an empty set stay."""
    made = stage(near_copies(docs, key, text, size, percent), "near-copies")
    gone = small_side(made.where("not kept").select(F.col(key).alias("gone"), F.col("mark").alias("gone_mark")).distinct(), "gone")
    rows = docs.select(F.struct("*").alias("row"), F.col(key).cast("long").alias("key"), F.xxhash64(content(text)).alias("mark"))
    rows = rows.join(gone, F.col("key").eqNullSafe(F.col("gone")) & (F.col("mark") == F.col("gone_mark")), "left_anti")
    # Rows that share the key of their group: one of them stays.
    again = made.where("kept and n_shingles > 0").groupBy("group").count().where("count > 1").select("group")
    shared = stage(
        made.where("kept and n_shingles > 0").join(again, "group", "left_semi")
        .select(F.col(key).alias("k"), F.col("mark").alias("m"), "group").distinct(),
        "shared",
    )
    if shared.isEmpty():
        return rows.select("row.*")
    same = F.col("key").eqNullSafe(F.col("k")) & (F.col("mark") == F.col("m"))
    single = rows.join(shared, same, "left_anti").select("row.*")
    return single.unionByName(rows.join(shared, same).dropDuplicates(["group"]).select("row.*"))
