"""Similarity join of documents by T-occurrence search (DivideSkip), exact.

A document's set is its distinct shingles of ``size`` words (ASCII lower case, ASCII white space); with fewer words, the
whole sequence. Two sets with a Jaccard similarity of ``percent`` share T = ceil(percent * (n1 + n2) / (100 + percent))
shingles, so a search for a set's partners asks for all sets that occur T times in its inverted lists.

Lists are divided by length. Shingles are ordered by the frequency of their hash bucket (a fixed number of counters,
counted over all documents), then by hash. Of n shingles the most frequent ceil(percent * n / 100) - c have the long lists, which are never built:
they are probed. The others' lists are built, and merged: a partner occurs in T less the number of long ones at least. The merge is a
heap of list fronts; where it needs r occurrences it takes the r - 1 least fronts off and skips their lists forward, by binary
search, to the next one. What it retains is confirmed by probing the full sets, by binary search too.

Documents with equal sets are one node. As a group of n similar sets has n * n pairs, each node first meets one hub: the
member of its lists whose shingles are the most frequent. Linked nodes become components, and the search looks only for partners in other
components: each node for those in larger ones (then greater roots), so a pair is searched for once and no link
between components is lost. Searches run in blocks of nodes that have a hub in common, with the lists that they share sent once to
a block; a block whose lists hold many members is divided by members, which are searched apart.

Null text and texts without words have an empty set and no links. Rows with equal keys are separate documents that share
the key; a null key is no component id unless no other is there. Repeated rows get equal results. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabveil.llm.common import content, small_side, stage
from tabveil.llm.components import components
from tabveil.llm.minhash_dedup import digest, listed, shingle_set, signed, sizes_fit

PERCENT = 80
BUCKET_BITS = 16
SLICES = 16
# Short lists per set beyond the least number: one more for every so many shingles.
SHINGLES_AN_OCCURRENCE = 32
BLOCK_NODES = 512
GROUP_MEMBERS = 2_000_000
# Stands for a null key where rows are named; a text of its own keeps rows of one key apart, and equal texts are one set.
LOW = -(1 << 63)


def placed_texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(content(text)).alias("mark"), content(text).alias("body"))


def described(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(key, mark, n, digest, slice, counts): each row's set, and per task the counts of hash buckets in ``SLICES`` rows without a digest."""
    rows = placed_texts(docs, key, text)
    width = (1 << BUCKET_BITS) // SLICES

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "mark", "n", "digest", "slice", "counts"]
        seen = np.zeros(1 << BUCKET_BITS, "i8")
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingle_set(t, size) for t in part.column(2).cast(pa.binary()).to_pylist()]
                seen += np.bincount((np.concatenate([*sets, np.zeros(0, "u8")]) >> np.uint64(64 - BUCKET_BITS)).view("i8"), minlength=len(seen))
                none = pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())
                digests = pa.array([digest(s) if len(s) else None for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(list(map(len, sets)), pa.int64()), digests, *none], names)
        blobs = [seen[i * width : (i + 1) * width].tobytes() for i in range(SLICES)] if seen.any() else []
        none = [pa.nulls(len(blobs), pa.int64()) for _ in range(3)]
        yield pa.RecordBatch.from_arrays(
            [*none, pa.nulls(len(blobs), pa.binary()), pa.array(range(len(blobs)), pa.int32()), pa.array(blobs, pa.binary())], names
        )

    return rows.mapInArrow(make, "key long, mark long, n long, digest binary, slice int, counts binary")


def rarity(found: DataFrame) -> np.ndarray:
    """The rank of each hash bucket, rarest first: a fixed number of counters comes to the driver."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for batch in batches:
            for at, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[at] = sums.get(at, 0) + np.frombuffer(blob, "i8")
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["slice", "counts"]
        )

    parts = found.where("counts is not null").select("slice", "counts").repartition(SLICES, "slice").mapInArrow(add, "slice int, counts binary")
    counts = np.zeros(1 << BUCKET_BITS, "i8")
    width = len(counts) // SLICES
    for row in parts.collect():
        counts[row["slice"] * width :][:width] += np.frombuffer(row["counts"], "i8")
    ranks = np.empty(len(counts), "u2")
    ranks[np.lexsort((np.arange(len(counts)), counts))] = np.arange(len(counts))
    return ranks


def ordered(values: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The hashes with their bucket's rank in the upper bits: sorted, the ones with the shortest lists come first."""
    rest = np.uint64(64 - BUCKET_BITS)
    return np.sort((ranks[(values >> rest).view("i8")].astype("u8") << rest) | (values & ((np.uint64(1) << rest) - np.uint64(1))))


def long_lists(n, percent: int):
    """How many of a set's lists are long: all but the least number that has to be merged, and some for more occurrences."""
    return np.maximum(-(-n * percent // 100) - 1 - n // SHINGLES_AN_OCCURRENCE, 0)


def short_lists(docs: DataFrame, nodes: DataFrame, ranks: np.ndarray, key: str, text: str, size: int, percent: int) -> DataFrame:
    """(node, n, weight, tokens): the shingles of each node with short lists; the weight says how frequent all are."""
    rows = placed_texts(docs, key, text).withColumn("key", F.coalesce("key", F.lit(LOW)))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [ordered(shingle_set(t, size), ranks) for t in part.column(2).cast(pa.binary()).to_pylist()]
                n = [len(s) for s in sets]
                weight = [float((s >> np.uint64(64 - BUCKET_BITS)).mean()) if len(s) else 0.0 for s in sets]
                kept = [signed(s[: len(s) - int(long_lists(len(s), percent))]) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(weight), listed(kept)], ["place", "mark", "n", "weight", "tokens"]
                )

    found = rows.mapInArrow(make, "place long, mark long, n long, weight double, tokens array<long>").where("n > 0")
    # One row of each node: of equal rows any, as they are alike.
    return found.dropDuplicates(["place", "mark"]).join(nodes.select("node", "place", "mark"), ["place", "mark"]).select(
        "node", "n", "weight", "tokens"
    )


def merged(lists: list[np.ndarray], least: int) -> Iterator[tuple[int, int]]:
    """(member, occurrences) of all members in ``least`` of the sorted lists, in order."""
    places = [0] * len(lists)
    heap = [(int(x[0]), i) for i, x in enumerate(lists) if len(x)]
    heapq.heapify(heap)
    while len(heap) >= least:
        member, same = heap[0][0], []
        while heap and heap[0][0] == member:
            same.append(heapq.heappop(heap)[1])
        if len(same) >= least:
            yield member, len(same)
            target = member + 1
        else:
            # No member before the next front can occur often enough.
            while heap and len(same) < least - 1:
                same.append(heapq.heappop(heap)[1])
            if not heap:
                return
            target = heap[0][0]
        for i in same:
            x, at = lists[i], places[i]
            at = at + 1 if x[at] < target and (at + 1 == len(x) or x[at + 1] >= target) else int(np.searchsorted(x, target))
            places[i] = at
            if at < len(x):
                heapq.heappush(heap, (int(x[at]), i))


def occurrences(n1, n2, percent: int):
    """T: how many shingles two similar sets of these sizes share at least."""
    return -(-percent * (n1 + n2) // (100 + percent))


def least_occurrences(n: int, percent: int) -> int:
    """In how many merged lists a partner of any size is.

    Both sets' short lists are the first ones in the order, so of what they share only the longer one's rest is not counted.
    """
    sizes = np.arange(-(-n * percent // 100), n * 100 // percent + 1)
    return int((occurrences(n, sizes, percent) - np.maximum(long_lists(n, percent), long_lists(sizes, percent))).min())


def searched(groups: DataFrame, percent: int) -> DataFrame:
    """(a, b, shared): pairs that occur often enough in the merged lists, by groups of queries and lists.

    A group's rows: queries (node, n, order, token) and list members (member of a token, n, order); a member is looked for
    if its order is greater.
    """
    def search(table: pa.Table) -> pa.Table:
        query = table.column("query").to_numpy()
        node, n = table.column("node").to_numpy(), table.column("n").to_numpy()
        # Order: size of the component, then its root.
        size, root, token = (table.column(c).to_numpy() for c in ("weight", "root", "token"))
        at = np.flatnonzero(~query)
        at = at[np.lexsort((node[at], token[at]))]
        tokens, starts = np.unique(token[at], return_index=True)
        lists = dict(zip(tokens.tolist(), np.split(node[at], starts[1:])))
        names, first = np.unique(node[at], return_index=True)
        about = dict(zip(names.tolist(), zip(n[at][first].tolist(), size[at][first].tolist(), root[at][first].tolist())))
        asked: dict = {}
        for i in np.flatnonzero(query):
            asked.setdefault(int(node[i]), (int(n[i]), int(size[i]), int(root[i]), []))[3].append(int(token[i]))
        out: list[tuple[int, int]] = []
        for x, (nx, sx, rx, own) in asked.items():
            short = [lists[t] for t in own if t in lists]
            lx = int(long_lists(nx, percent))
            for y, c in merged(short, least_occurrences(nx, percent)):
                ny, sy, ry = about[y]
                if (sy, ry) <= (sx, rx) or min(nx, ny) * 100 < max(nx, ny) * percent:
                    continue
                if c >= occurrences(nx, ny, percent) - max(lx, int(long_lists(ny, percent))):
                    out.append((min(x, y), max(x, y)))
        return pa.table([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], ["a", "b"])

    return groups.groupBy("block", "part").applyInArrow(search, "a long, b long")


def confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, key: str, text: str, size: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough: the smaller one's shingles are probed in the other by binary search."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = small_side(
        ends.join(nodes, "node").select("node", "place", "mark"), "wanted"
    )
    rows = placed_texts(docs, key, text).select(F.coalesce("key", F.lit(LOW)).alias("place"), "mark", "body")
    rows = rows.join(wanted, ["place", "mark"]).select("node", "body")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingle_set(t, size).tobytes() for t in part.column(1).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["node", "shingles"])

    sets = stage(rows.mapInArrow(make, "node long, shingles binary").dropDuplicates(["node"]), "sets")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for i in range(batch.num_rows):
                one, two = sorted((np.frombuffer(batch.column(c)[i].as_buffer(), "u8") for c in (2, 3)), key=len)
                at = np.searchsorted(two, one)
                shared = int(np.count_nonzero(two[np.minimum(at, len(two) - 1)] == one))
                kept.append(100 * shared >= percent * (len(one) + len(two) - shared))
            yield batch.select([0, 1]).filter(pa.array(kept, pa.bool_()))

    both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b").select("a", "b", "sa", "sb")
    return both.mapInArrow(probe, "a long, b long")


def similar_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = PERCENT,
) -> DataFrame:
    """(key, mark, n_shingles, component_id, group) of each row; ``mark`` is the text's hash, ``group`` null for sets without links."""
    found = stage(described(docs, key, text, size), "described")
    rows = found.where("counts is null")
    nodes = stage(
        rows.where("digest is not null").groupBy("digest").agg(
            F.min(F.struct(F.coalesce("key", F.lit(LOW)).alias("place"), "mark")).alias("first"), F.min("key").alias("least")
        ).select("digest", "first.place", "first.mark", "least").withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    ranks = rarity(found)
    short = stage(short_lists(docs, nodes, ranks, key, text, size, percent), "short-lists")
    about = short.select("node", "n", "weight")
    postings = short.select("node", F.explode("tokens").alias("token"))
    listed_tokens = postings.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("token")
    postings = stage(postings.join(listed_tokens, "token").join(about, "node"), "postings")

    # Each node and the hub that it shares most lists with.
    hubs = postings.groupBy("token").agg(F.max_by(F.struct("node", "n"), F.struct("weight", "node")).alias("hub"))
    met = postings.join(hubs, "token").where((F.col("node") != F.col("hub.node")) & sizes_fit(F.col("n"), F.col("hub.n"), percent))
    votes = met.groupBy("node", F.col("hub.node").alias("hub")).agg(F.count(F.lit(1)).alias("c"))
    best = stage(votes.groupBy("node").agg(F.max(F.struct("c", "hub")).getField("hub").alias("hub")), "hubs")
    pairs = stage(best.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct(), "pairs")
    links = stage(confirmed(pairs, nodes, docs, key, text, size, percent), "links")
    roots = components(links)

    # Partners in other components, for the nodes of the smaller one.
    late = stage(confirmed(apart(postings, best, roots, percent).join(pairs, ["a", "b"], "left_anti"), nodes, docs, key, text, size, percent), "links")
    if not late.isEmpty():
        roots = components(links.union(late))

    whole = nodes.select("digest", "node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = whole.groupBy("root").agg(F.min("least").alias("component_id"))
    named = whole.join(ids, "root").select(F.col("digest").alias("of"), "component_id", F.col("root").alias("group"))
    joined = rows.select("key", "mark", "n", "digest").join(named, F.col("digest") == F.col("of"), "left")
    component = F.when(F.col("digest").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return joined.select(F.col("key").alias(key), "mark", F.col("n").alias("n_shingles"), component.alias("component_id"), "group")


def apart(postings: DataFrame, hubs: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of nodes of different components that the search retains."""
    placed = postings.select("token", "node", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = roots.groupBy("root").agg(F.count(F.lit(1)).alias("weight"))
    placed = placed.join(sizes, "root", "left").withColumn("weight", F.coalesce("weight", F.lit(1).cast("long")))
    placed = stage(placed.select("token", "node", "n", "weight", "root"), "placed")
    order = F.struct("weight", "root")
    tops = placed.groupBy("token").agg(F.max(order).alias("top"), F.min(order).alias("low")).where("top > low").select("token", "top")
    queries = placed.join(tops, "token").where(F.struct("weight", "root") < F.col("top")).drop("top")
    # Nodes with one hub share lists; a hub with many nodes has several blocks.
    asked = queries.join(hubs, "node", "left").withColumn("hub", F.coalesce("hub", "node"))
    counted = asked.groupBy("hub", "node").agg(F.count(F.lit(1)).alias("c")).groupBy("hub").agg(F.count(F.lit(1)).alias("nodes"))
    counted = counted.select("hub", F.ceil(F.col("nodes") / BLOCK_NODES).cast("long").alias("blocks"))
    block = F.struct("hub", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("i"))
    asked = stage(asked.join(counted, "hub").select(block.alias("block"), "token", "node", "n", "weight", "root"), "queries")
    # The lists that a block asks for, without members below all who ask.
    wants = asked.groupBy("block", "token").agg(F.min(order).alias("low"))
    members = wants.join(placed, "token").where(F.struct("weight", "root") > F.col("low")).drop("low")
    members = stage(members.select("block", "token", "node", "n", "weight", "root"), "members")
    parts = members.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / GROUP_MEMBERS).cast("long").alias("parts"))
    held = members.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts"))).withColumn("query", F.lit(False))
    sent = asked.join(parts, "block").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).withColumn("query", F.lit(True))
    columns = ["block", "part", "query", "token", "node", "n", "weight", "root"]
    groups = held.select(*columns).unionByName(sent.select(*columns))
    return stage(searched(groups, percent).distinct(), "retained")
