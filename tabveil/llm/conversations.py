"""Cheapest repair of conversations whose turns break the grammar of roles.

    C -> empty | B        B -> H u a | B u a        H -> s | empty

A repaired conversation is empty, or pairs of a user's (u) and an assistant's (a) turn, perhaps after a system's (s); a
role counts by its first letter. Each row is kept (cost 0), given the role user or assistant (1) or deleted (2); an empty turn of a
user or an assistant can be inserted anywhere (5). Blank rows and rows whose role and text came earlier in the
conversation have to go; a row cut short costs 5 more if it stays. The cheapest row of edits wins, of equal ones the
one whose initials (D, I, K, R) are least.

A generalised LR parser runs all edits at once: its tops of stack share what lies below them, and paths
that end in equal tops are merged, which keeps the least (cost, initials). Turns are inserted just before a row that stays, or at
the end: before a deletion they would only make greater initials. So paths over the same rows never begin with one another, and
the least stays the least whatever follows.

A conversation is cut into blocks of its rows in their order; each block is parsed from every top that it can be entered with,
and then one pass over a conversation's blocks - their costs and initials, not the texts - chooses among them. So a conversation of any
length is many tasks' work until its blocks are chained. Equal rows of one turn are one row with a number. Texts are moved once
by row, to join what was decided, wherever they are; only the digest of a repaired conversation, a chain by its nature, reads a
conversation's texts one after the other, as a stream.

Null texts and roles are one space; a row whose role has no letter can't be kept as it is. A null turn is first. Rows of one turn are in
the order of a hash of role and text. A null key is a conversation like any other. Conversations with no rows left have
zeros and an empty result. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabveil.llm.common import small_side, stage

BLANK = " \t\n\x0b\x0c\r"
BLOCK_BITS = 10
RELABEL, DELETE, INSERT, CUT_SHORT = 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}

# The parser's tables. Each state is a set of positions in the rules above; the first is empty.
#   0: C -> . | . B     1: C -> B . | B -> B . u a     2: B -> H . u a     3: B -> H u . a     5: B -> B u . a
# and, left at once by a reduction, 4: H -> s .     6: B -> H u a .     7: B -> B u a .
SHIFT = {(0, "s"): 4, (2, "u"): 3, (1, "u"): 5, (3, "a"): 6, (5, "a"): 7}
REDUCE = {4: (1, "H"), 6: (3, "B"), 7: (3, "B")}
BEFORE_SHIFT = {(0, "u"): (0, "H")}
GOTO = {(0, "H"): 2, (0, "B"): 1}
ACCEPTS = (0, 1)

# A stack is its top state and the stack below, which stacks share.
START = (0, None)
STACKS = [START, (1, START), (2, START), (3, (2, START)), (5, (1, START))]
NUMBER = {stack: i for i, stack in enumerate(STACKS)}


def reduced(stack: tuple, rule: tuple[int, str]) -> tuple:
    length, symbol = rule
    for _ in range(length):
        stack = stack[1]
    return GOTO[stack[0], symbol], stack


def shifted(stack: tuple, letter: str) -> tuple | None:
    """The stack after a turn of this role, with the reductions that follow; None if the grammar has no such turn here."""
    if (stack[0], letter) in BEFORE_SHIFT:
        stack = reduced(stack, BEFORE_SHIFT[stack[0], letter])
    to = SHIFT.get((stack[0], letter))
    if to is None:
        return None
    stack = (to, stack)
    return reduced(stack, REDUCE[to]) if to in REDUCE else stack


NEXT = {(a, x): NUMBER[b] for a, stack in enumerate(STACKS) for x in "sua" if (b := shifted(stack, x)) is not None}
ENDS = [i for i, stack in enumerate(STACKS) if stack[0] in ACCEPTS]


def merge(tops: dict, top: int, cost: int, audit: str) -> bool:
    """Keep the least (cost, audit) of a top; whether this one is it."""
    if top in tops and tops[top] <= (cost, audit):
        return False
    tops[top] = (cost, audit)
    return True


def with_inserts(tops: dict) -> dict:
    """The tops with all turns that may be inserted after them."""
    out, last = dict(tops), dict(tops)
    while last:
        more: dict = {}
        for top, (cost, audit) in last.items():
            for letter in ROLES:
                to = NEXT.get((top, letter))
                if to is not None and merge(out, to, cost + INSERT, audit + "I"):
                    more[to] = out[to]
        last = more
    return out


def parsed(rows: list[tuple[str, str, int]], entry: int) -> dict:
    """top -> (cost, audit) after the rows (role's initial, fault, how often), from one top."""
    tops = {entry: (0, "")}
    for initial, fault, times in rows:
        after: dict = {}
        for top, (cost, audit) in tops.items():
            merge(after, top, cost + DELETE, audit + "D")
        if fault not in ("blank", "duplicate"):
            extra = CUT_SHORT if fault == "truncated" else 0
            for top, (cost, audit) in with_inserts(tops).items():
                kept = NEXT.get((top, initial))
                if kept is not None:
                    merge(after, kept, cost + extra, audit + "K")
                for letter in ROLES:
                    to = NEXT.get((top, letter))
                    if to is not None:
                        merge(after, to, cost + RELABEL + extra, audit + "R")
        # Further equal rows are duplicates.
        more = times - 1
        tops = {t: (c + DELETE * more, a + "D" * more) for t, (c, a) in after.items()} if more else after
    return tops


TAILS = [min((with_inserts({i: (0, "")})[e] for e in ENDS if e in with_inserts({i: (0, "")}))) for i in range(len(STACKS))]


def damaged(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The rows with planted faults, chosen by a checksum of conversation and turn: (conv, turn, role, text, times).

    ``times`` is 0 for a row that is dropped and 2 for one that is repeated.
    """
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn, role, text)]
    held = rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), spaced[2].alias("role"), spaced[3].alias("text"),
        (F.crc32(F.concat(spaced[0], F.lit(":"), spaced[1])) % 20).alias("fault"),
    )
    changed = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return held.select(
        "conv", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), changed.alias("text"),
        F.when(F.col("fault") == 0, 0).when(F.col("fault") == 3, 2).otherwise(1).alias("times"),
    )


def turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, times) as ``repair`` takes it, of rows as they are."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c2) for c, c2 in ((role, "role"), (text, "text"))]
    return rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), *spaced, F.lit(1).alias("times"))


def hashes() -> list[Column]:
    return [F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), "role", "text").alias("h2")]


def judged(rows: DataFrame) -> DataFrame:
    """(conv, turn, h1, h2, initial, fault, times, again): each distinct row without its text.

    ``fault`` is what the row alone shows; ``again`` says that role and text came in an earlier turn.
    """
    last = F.right(F.rtrim("text", F.lit(BLANK)), F.lit(1))
    fault = F.when(last == "", "blank").when(~last.isin(".", "!", "?"), "truncated").otherwise("")
    light = rows.select("conv", "turn", *hashes(), F.substring("role", 1, 1).alias("initial"), fault.alias("fault"), "times")
    light = stage(light.groupBy("conv", "turn", "h1", "h2", "initial", "fault").agg(F.sum("times").alias("times")), "turns")
    # Only what occurs in several turns is looked up, so frequent texts meet in partial aggregates.
    seen = light.where("times > 0 and fault <> 'blank'").groupBy("conv", "h1", "h2").agg(
        F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("c")
    )
    seen = small_side(seen.where("c > 1").select(*[F.col(c).alias("f_" + c) for c in ("conv", "h1", "h2", "first")]), "seen")
    same = F.col("conv").eqNullSafe(F.col("f_conv")) & (F.col("h1") == F.col("f_h1")) & (F.col("h2") == F.col("f_h2"))
    again = F.col("f_first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("f_first.turn"))
    return light.join(seen, same, "left").select(*light.columns, again.alias("again"))


def statistics(light: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated) of each conversation, those without rows too."""
    here = F.when(F.col("times") > 0, F.col("turn"))
    blank = F.col("fault") == "blank"

    def added(n: Column) -> Column:
        return F.sum(n).cast("long")

    return light.groupBy("conv").agg(
        F.coalesce(F.max(here) - F.min(here) + 1 - F.count_distinct(here), F.lit(0)).cast("long").alias("gaps"),
        added(F.when(blank, F.col("times")).otherwise(0)).alias("blank"),
        added(F.when(blank | (F.col("times") == 0), 0).when(F.col("again"), F.col("times")).otherwise(F.col("times") - 1)).alias("duplicate"),
        added(F.when((F.col("fault") == "truncated") & ~F.col("again") & (F.col("times") > 0), 1).otherwise(0)).alias("truncated"),
    )


def blocks(light: DataFrame) -> DataFrame:
    """(conv, block, rows): each conversation's rows in order, at most 2^BLOCK_BITS in a block; blocks are numbered in order."""
    order = ["conv", "turn", "h1", "h2"]
    fault = F.when(F.col("fault") == "blank", "blank").when(F.col("again"), "duplicate").otherwise(F.col("fault"))
    numbered = light.where("times > 0").select(*order, "initial", fault.alias("fault"), "times")
    numbered = numbered.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    row = F.struct("at", "initial", "fault", "times", "turn", "h1", "h2")
    return numbered.groupBy("conv", F.shiftright("at", BLOCK_BITS).alias("block")).agg(F.sort_array(F.collect_list(row)).alias("rows"))


def block_ways(held: DataFrame) -> DataFrame:
    """The blocks with ``ways``: (entry, exit, cost, audit) for each top they can be entered and left with."""
    way = pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    mask = (1 << BLOCK_BITS) - 1

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ways, illegal, first, last = [], [], [], []
            for rows in batch.column("rows").to_pylist():
                plain = [(r["initial"], r["fault"], r["times"]) for r in rows]
                # A conversation that doesn't begin where a block may begin starts with its first row.
                entries = range(len(STACKS)) if rows[0]["at"] & mask == 0 else [0]
                ways.append([
                    {"entry": e, "exit": x, "cost": c, "audit": a} for e in entries for x, (c, a) in parsed(plain, e).items()
                ])
                initials = [p[0] for p in plain]
                pairs = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
                illegal.append(pairs + sum(p[2] - 1 for p in plain))
                first.append(initials[0])
                last.append(initials[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ways, pa.list_(way)), pa.array(illegal, pa.int64()), pa.array(first, pa.string()), pa.array(last, pa.string())],
                [*batch.schema.names, "ways", "illegal", "first", "last"],
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in held.schema)
    return held.mapInArrow(
        make, schema + ", ways array<struct<entry: int, exit: int, cost: long, audit: string>>, illegal long, first string, last string"
    )


def chained(found: DataFrame) -> DataFrame:
    """(conv, block, entry, exit, tail, made, total, cost, illegal) of the blocks on each conversation's cheapest path.

    ``made`` counts the turns that earlier blocks made, ``total`` those of the conversation; cost and illegal pairs stand at its last block.
    """
    def end(key: object, path: list, tops: dict, illegal: int) -> list[dict]:
        _, at = min((cost + TAILS[t][0], (rank, TAILS[t][1])) + (t,) for t, (cost, rank) in tops.items())[1:]
        top, out = at, []
        tail, cost = TAILS[top][1], tops[top][0] + TAILS[top][0]
        for block, back in reversed(path):
            entry, kept = back[top]
            out.append({"conv": key, "block": block, "entry": entry, "exit": top, "tail": "", "made": kept, "total": 0, "cost": None, "illegal": None})
            top = entry
        made = 0
        for row in reversed(out):
            row["made"], made = made, made + row["made"]
        out[0] |= {"tail": tail, "cost": cost, "illegal": illegal}
        for row in out:
            row["total"] = made + len(tail)
        return out

    key_type = found.schema["conv"].dataType.simpleString()
    schema = f"conv {key_type}, block long, entry int, exit int, tail string, made long, total long, cost long, illegal long"

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list = []  # the open conversation: key, path, tops with (cost, rank of their audit), illegal pairs, last initial
        ready: list[dict] = []
        kind = None
        for batch in batches:
            kind = batch.schema.field("conv").type
            for row in batch.to_pylist():
                if not now or now[0] != row["conv"]:
                    if now:
                        ready += end(*now[:4])
                    now = [row["conv"], [], {0: (0, 0)}, 0, ""]
                _, path, tops, _, before = now
                best: dict = {}
                for w in row["ways"]:
                    if w["entry"] in tops:
                        cost, rank = tops[w["entry"]]
                        way = (cost + w["cost"], (rank, w["audit"]), w["entry"], len(w["audit"]) - w["audit"].count("D"))
                        best[w["exit"]] = min(best.get(w["exit"], way), way)
                ranks = {a: i for i, a in enumerate(sorted({way[1] for way in best.values()}))}
                path.append((row["block"], {x: way[2:] for x, way in best.items()}))
                now[2] = {x: (way[0], ranks[way[1]]) for x, way in best.items()}
                now[3] += row["illegal"] + (bool(path[:-1]) and before + row["first"] not in ("su", "ua", "au"))
                now[4] = row["last"]
            if len(ready) > 10_000:
                yield table(ready, kind)
                ready = []
        if now:
            ready += end(*now[:4])
        if ready:
            yield table(ready, kind)

    def table(rows: list[dict], kind: pa.DataType) -> pa.RecordBatch:
        types = [("conv", kind), ("block", pa.int64()), ("entry", pa.int32()), ("exit", pa.int32()), ("tail", pa.string()), ("made", pa.int64()), ("total", pa.int64()), ("cost", pa.int64()), ("illegal", pa.int64())]
        return pa.RecordBatch.from_pylist(rows, schema=pa.schema(types))

    light = found.select("conv", "block", "ways", "illegal", "first", "last")
    return light.repartition("conv").sortWithinPartitions("conv", "block").mapInArrow(make, schema)


def decided(found: DataFrame, chosen: DataFrame) -> DataFrame:
    """The blocks on the chosen paths: conv, block, rows, audit (of the block, with the conversation's end), made, total."""
    side = chosen.select(*[F.col(c).alias("c_" + c) for c in ("conv", "block", "entry", "exit", "tail", "made", "total")])
    same = F.col("conv").eqNullSafe(F.col("c_conv")) & (F.col("block") == F.col("c_block"))
    way = F.get(F.filter("ways", lambda w: (w["entry"] == F.col("c_entry")) & (w["exit"] == F.col("c_exit"))), F.lit(0))
    return found.join(side, same).select(
        "conv", "block", "rows", F.concat(way["audit"], F.col("c_tail")).alias("audit"), F.col("c_made").alias("made"), F.col("c_total").alias("total")
    )


def actions(held: DataFrame) -> DataFrame:
    """(conv, place, action, new_role, turn, h1, h2): a row for each turn that is left; of inserted ones without turn and hashes."""
    key_type = held.schema["conv"].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict = {n: [] for n in ("at", "place", "action", "new_role", "turn", "h1", "h2")}
            for i in range(batch.num_rows):
                rows, audit, place, total = (batch.column(c)[i].as_py() for c in ("rows", "audit", "made", "total"))
                at, names = 0, ("user", "assistant") if total % 2 == 0 else ("assistant", "user")

                def put(action: str, row: dict) -> None:
                    new = names[place % 2] if action != "K" else None
                    for n, v in zip(out, (i, place, action, new, row.get("turn"), row.get("h1"), row.get("h2"))):
                        out[n].append(v)

                for row in rows:
                    while audit[at] == "I":
                        put("I", {})
                        at, place = at + 1, place + 1
                    if audit[at] != "D":
                        put(audit[at], row)
                        place += 1
                    at += row["times"]
                for _ in audit[at:]:
                    put("I", {})
                    place += 1
            conv = batch.column("conv").take(pa.array(out.pop("at"), pa.int64()))
            types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([conv, *map(pa.array, out.values(), types)], ["conv", *out])

    return held.select("conv", "rows", "audit", "made", "total").mapInArrow(
        make, f"conv {key_type}, place long, action string, new_role string, turn long, h1 long, h2 long"
    )


def digests(repaired: DataFrame) -> DataFrame:
    """(conv, sha256) of each repaired conversation's ``role:text``, joined by line ends, read as a stream in order."""
    key_type = repaired.schema["conv"].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, digest = None, None
        for batch in batches:
            keys, done = [], []
            for row in batch.to_pylist():
                part = f"{row['role']}:{row['text']}".encode()
                if digest is None or row["conv"] != open_key:
                    if digest is not None:
                        keys.append(open_key)
                        done.append(digest.hexdigest())
                    open_key, digest = row["conv"], hashlib.sha256(part)
                else:
                    digest.update(b"\n" + part)
            kind = batch.schema.field("conv").type
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(done)], ["conv", "sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([open_key], kind), pa.array([digest.hexdigest()])], ["conv", "sha256"])

    ordered = repaired.select("conv", "place", "role", "text").repartition("conv").sortWithinPartitions("conv", "place")
    return ordered.mapInArrow(make, f"conv {key_type}, sha256 string")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The repaired turns and a report, of ``turns`` or ``damaged`` rows.

    Repaired turns: (conv, place, action, role, text). Report: conv, gaps, blank, duplicate, truncated, illegal, cost, audit.
    """
    light = judged(rows)
    found = stage(block_ways(blocks(light)), "blocks")
    chosen = stage(chained(found), "paths")
    held = decided(found, chosen)

    made = stage(actions(held), "actions")
    # A row of each distinct turn; equal ones meet in partial aggregates, before and after the shuffle of the join below.
    texts = rows.where("times > 0").select("conv", "turn", "role", "text", *hashes()).groupBy("conv", "turn", "h1", "h2").agg(
        F.first("role").alias("role"), F.first("text").alias("text")
    )
    texts = texts.toDF("t_conv", "t_turn", "t_h1", "t_h2", "role", "text")
    same = (
        F.col("conv").eqNullSafe(F.col("t_conv")) & F.col("turn").eqNullSafe(F.col("t_turn"))
        & (F.col("h1") == F.col("t_h1")) & (F.col("h2") == F.col("t_h2"))
    )
    columns = ["conv", "place", "action", F.coalesce("new_role", "role").alias("role"), "text"]
    left = made.where("action <> 'I'").join(texts, same).select(*columns)
    new = made.where("action = 'I'").select("conv", "place", "action", F.col("new_role").alias("role"), F.lit("").alias("text"))

    pieces = F.sort_array(F.collect_list(F.struct("block", "audit")))
    audits = held.groupBy("conv").agg(F.array_join(F.transform(pieces, lambda p: p["audit"]), "").alias("audit"))
    costs = chosen.where("cost is not null").select(F.col("conv").alias("c_conv"), "cost", "illegal")
    audits = audits.toDF("a_conv", "audit")
    report = statistics(light).join(costs, F.col("conv").eqNullSafe(F.col("c_conv")), "left").join(
        audits, F.col("conv").eqNullSafe(F.col("a_conv")), "left"
    ).select(
        "conv", "gaps", "blank", "duplicate", "truncated", F.coalesce("illegal", F.lit(0)).alias("illegal"),
        F.coalesce("cost", F.lit(0)).alias("cost"), F.coalesce("audit", F.lit("")).alias("audit"),
    )
    return left.unionByName(new), report


def with_digests(repaired: DataFrame, report: DataFrame) -> DataFrame:
    """The report with ``repaired_sha256``."""
    made = digests(repaired).toDF("d_conv", "sha256")
    empty = hashlib.sha256(b"").hexdigest()
    return report.join(made, F.col("conv").eqNullSafe(F.col("d_conv")), "left").select(
        *report.columns, F.coalesce("sha256", F.lit(empty)).alias("repaired_sha256")
    )
