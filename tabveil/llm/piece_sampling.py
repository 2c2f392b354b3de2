"""Sampled segmentations of a SentencePiece vocabulary, and their decoding.

The probability of a segmentation is proportional to exp(sharpness * sum of its pieces' scores). Forward
filtering sums, for each place of a unit, the weights of all ways to get there; backward sampling draws pieces
from the end by these sums. Both are exact over the whole lattice. Uniform numbers are a hash of the row's key,
the unit's number in the text and the step, so a row always gets the same pieces, wherever it is computed;
rows with equal keys share their numbers. A null key counts as 0.

Forward sums are made once for each distinct unit a worker remembers, for all new units of a batch together; draws run over
whole batches at once.
Decoding joins the pieces' bytes and drops the blank put before the text: it gives back every text.

Null and empty texts have no pieces and decode to empty. Extra columns pass through.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabveil.llm.common import content, once_per_worker
from tabveil.llm.pieces import Vocabulary, bytes_of, units_of

SHARPNESS = 1 / 2000
SEED = 42
KNOWN_STATES = 300_000
DRAW_BITS = 30
BATCH_CHARS = 1 << 18
# Units up to this many characters are filtered together, this many at once, place by place; longer ones alone.
TOGETHER_CHARS, UNITS_TOGETHER = 64, 8_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64 bits (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


STEP = np.uint64(0x9E3779B97F4A7C15)


class Lattices:
    """Backward choices of all units seen. State s has the choices with s < limit <= s + 1 in ``limits``.

    Limits are integers in units of 2 ** -DRAW_BITS, so a draw does not depend on the number of its state.
    """

    def __init__(self, vocabulary: Vocabulary, sharpness: float):
        self.vocabulary, self.sharpness = vocabulary, sharpness
        # Unknown characters go by bytes; byte strings of characters are numbered beyond the vocabulary.
        self.atoms: dict[bytes, int] = {}
        self.atom_bytes: list[bytes] = []
        self.clear()

    def clear(self) -> None:
        self.tables = None
        self.final: dict[str, int] = {}
        self.limits, self.target, self.emit = array("q"), array("i"), array("i")
        self.n_states = 1  # state 0: the start

    def atom(self, raw: bytes) -> int:
        if raw not in self.atoms:
            self.atoms[raw] = len(self.vocabulary.decoded) + len(self.atom_bytes)
            self.atom_bytes.append(raw)
        return self.atoms[raw]

    def state(self, choices: list[tuple[float, int, int]]) -> int:
        """A state with (probability, next state, what is emitted)."""
        s, upto = self.n_states, 0.0
        for k, (p, target, emit) in enumerate(choices):
            upto = 1.0 if k == len(choices) - 1 else upto + p
            self.limits.append((s << DRAW_BITS) + round(min(upto, 1.0) * (1 << DRAW_BITS)))
            self.target.append(target)
            self.emit.append(emit)
        self.n_states += 1
        return s

    def add(self, unit: str) -> int:
        raw = bytes_of(unit)
        if raw is not None:
            return self.state([(1.0, 0, self.atom(raw))])
        ways: list[list] = [[] for _ in range(len(unit) + 1)]
        for end, length, i, score in self.vocabulary.matches(unit):
            ways[end].append((end - length, i, score * self.sharpness))
        total, states = [0.0], [0]
        for end in range(1, len(unit) + 1):
            weights = [total[start] + score for start, _, score in ways[end] if states[start] is not None]
            usable = [w for w in ways[end] if states[w[0]] is not None]
            top = max(weights)
            parts = [math.exp(w - top) for w in weights]
            whole = sum(parts)
            total.append(top + math.log(whole))
            states.append(self.state([
                (p / whole, states[start], self.atom(unit[start:end].encode()) if i < 0 else i)
                for p, (start, i, _) in zip(parts, usable) if p > 0
            ]))
        return states[-1]

    def add_together(self, units: list[str]) -> None:
        """``add`` for many units without bytes of their own: the sums of all units' first places, then of their second ones."""
        sizes = np.array([len(u) for u in units], "i8")
        text = "\n".join(units)
        ends, lengths, ids, scores = self.vocabulary.matches_within(text)
        # Place p of the joined text is state base + p; the place before a unit is the start.
        begins = np.cumsum(sizes + 1) - sizes - 1
        depth = np.arange(len(text) + 1) - np.repeat(begins, sizes + 1)
        base = self.n_states - 1
        # Matches by depth, then place: a depth's matches stand together, and so do those of a place.
        places, depths = ends, depth[ends].astype("u1")
        order = np.argsort(depths, kind="stable")
        ends, starts, scores = ends[order], (ends - lengths)[order], scores[order] * self.sharpness
        total = np.zeros(len(text) + 1)
        shares = np.empty(len(ends))
        cuts = np.cumsum(np.bincount(depths)).tolist()
        for a, b in zip(cuts, cuts[1:]):
            end, weights = ends[a:b], total[starts[a:b]] + scores[a:b]
            first = np.flatnonzero(np.diff(end, prepend=-1))
            counts = np.diff(first, append=b - a)
            top = np.maximum.reduceat(weights, first)
            parts = np.exp(weights - np.repeat(top, counts))
            whole = np.add.reduceat(parts, first)
            total[end[first]] = top + np.log(whole)
            shares[a:b] = parts / np.repeat(whole, counts)
        # States in the order of their places; choices without a share go.
        shares[order] = shares.copy()
        some = np.flatnonzero(shares > 0)
        ends, starts, ids, shares = places[some], (places - lengths)[some], ids[some], shares[some]
        for k in np.flatnonzero(ids < 0).tolist():
            ids[k] = self.atom(text[starts[k] : ends[k]].encode())
        first = np.flatnonzero(np.diff(ends, prepend=-1))
        counts = np.diff(first, append=len(ends))
        # Running sums within a state, added one by one from its first choice.
        upto, number = shares.copy(), np.arange(len(ends)) - np.repeat(first, counts)
        for k in range(1, int(counts.max())):
            at = np.flatnonzero(number == k)
            upto[at] += upto[at - 1]
        upto[first + counts - 1] = 1.0
        limits = ((base + ends) << DRAW_BITS) + np.rint(np.minimum(upto, 1.0) * (1 << DRAW_BITS)).astype("i8")
        self.limits.frombytes(limits.tobytes())
        self.target.frombytes(np.where(depth[starts] > 0, base + starts, 0).astype("i4").tobytes())
        self.emit.frombytes(ids.astype("i4").tobytes())
        self.n_states += len(text)
        self.final.update(zip(units, (base + begins + sizes).tolist()))

    def look_up(self, units: list[str]) -> np.ndarray:
        final = self.final
        new = [u for u in dict.fromkeys(units) if u not in final]
        if new:
            self.tables = None
            short = [u for u in new if len(u) <= TOGETHER_CHARS and bytes_of(u) is None]
            for at in range(0, len(short), UNITS_TOGETHER):
                self.add_together(short[at : at + UNITS_TOGETHER])
            for u in new:
                if u not in final:
                    final[u] = self.add(u)
        if self.tables is None:
            # Views, let go before anything is appended.
            self.tables = tuple(np.frombuffer(x, kind) for x, kind in ((self.limits, "i8"), (self.target, "i4"), (self.emit, "i4")))
        return np.fromiter(map(final.__getitem__, units), "i8", len(units))

    def sample(self, states: np.ndarray, streams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(emitted, number emitted per unit): draws from the ends of all units to their starts."""
        limits, target, emit = self.tables
        at, left, steps, counts = np.arange(len(states)), states, [], np.zeros(len(states), "i8")
        step = np.uint64(1)
        while len(at):
            u = (mixed(streams[at] + STEP * step) >> np.uint64(64 - DRAW_BITS)).astype("i8")
            # The first limit above; a state's last one is its number + 1.
            choice = np.searchsorted(limits, (left << DRAW_BITS) + u, "right")
            steps.append((at, emit[choice]))
            counts[at] += 1
            left = target[choice].astype("i8")
            more = left > 0
            at, left, step = at[more], left[more], step + np.uint64(1)
        ends = np.cumsum(counts)
        out = np.empty(int(ends[-1]) if len(ends) else 0, "i8")
        for k, (units, emitted) in enumerate(steps):
            out[ends[units] - 1 - k] = emitted
        return out, counts


class Sampler:
    def __init__(self, model: bytes, sharpness: float, seed: int):
        self.vocabulary, self.seed = Vocabulary(model), np.uint64(seed)
        self.lattices = Lattices(self.vocabulary, sharpness)

    def encode(self, keys: list[int], texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        if self.lattices.n_states > KNOWN_STATES:
            self.lattices.clear()
        split = [units_of(t) for t in texts]
        sizes = np.array([len(s) for s in split], "i8")
        states = self.lattices.look_up([u for s in split for u in s])
        owner = np.repeat(np.arange(len(texts)), sizes)
        number = np.arange(len(states)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        start = mixed(np.array([k & 0xFFFFFFFFFFFFFFFF for k in keys], "u8") * STEP + self.seed)
        streams = mixed(start[owner] + number.astype("u8") * STEP) if len(states) else np.zeros(0, "u8")
        emitted, counts = self.lattices.sample(states, streams)
        owners = np.repeat(owner, counts)
        base = len(self.vocabulary.decoded)
        atoms = self.lattices.atom_bytes
        if len(emitted) and emitted.max() >= base:
            sizes_of = np.ones(len(emitted), "i8")
            which = np.flatnonzero(emitted >= base)
            raw = [atoms[i - base] for i in emitted[which]]
            sizes_of[which] = [len(r) for r in raw]
            ids = np.repeat(emitted, sizes_of)
            owners = np.repeat(owners, sizes_of)
            table = np.array(self.vocabulary.bytes_ids, "i8")
            ids[ids >= base] = table[np.frombuffer(b"".join(raw), "u1")]
            emitted = ids
        return emitted, np.bincount(owners, minlength=len(texts)).astype("i8")

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.vocabulary.decoded.__getitem__, ids)).decode()[1:]


def sample_pieces(
    docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text", sharpness: float = SHARPNESS,
    seed: int = SEED, keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keep``, ``ids`` and ``decoded`` (from the ids) of each row."""
    # A text that is kept goes to the workers in its row, not twice.
    within = list(keep).index(text) if text in keep else None
    body = [content(text).alias("body")] if within is None else []
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("key"), F.struct(*keep).alias("row"), *body)
    schema = rows.select("row").schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", "string")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = None
        for batch in batches:
            name = f"sampler_{zlib.crc32(model)}_{sharpness}_{seed}"
            sampler = sampler or once_per_worker(name, lambda: Sampler(model, sharpness, seed))
            bodies = batch.column(2) if within is None else batch.column(1).field(within)
            at = 0
            while at < batch.num_rows:
                # Rows up to a bounded number of characters; a longer text stands alone.
                texts, size = [], 0
                for value in bodies[at : at + 2000]:
                    texts.append(value.as_py() or "")
                    size += len(texts[-1])
                    if size >= BATCH_CHARS:
                        break
                part = batch.slice(at, len(texts))
                ids, counts = sampler.encode(part.column(0).to_pylist(), texts)
                ends = np.concatenate([[0], np.cumsum(counts)])
                listed = ids.tolist()
                decoded = [sampler.decode(listed[a:b]) for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(1),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())),
                        pa.array(decoded, pa.string()),
                    ],
                    ["row", "ids", "decoded"],
                )
                at += len(texts)

    return rows.mapInArrow(encode, schema).select("row.*", "ids", "decoded")


def decode_pieces(encoded: DataFrame, model: bytes, ids: str = "ids") -> DataFrame:
    """``encoded`` with a column ``text`` made from its ids; null ids decode to empty."""
    rows = encoded.select(F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("ids"), F.struct("*").alias("row"))
    schema = rows.select("row").schema.add("decoded", "string")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = None
        for batch in batches:
            vocabulary = vocabulary or Vocabulary(model)
            texts = [
                b"".join(map(vocabulary.decoded.__getitem__, x)).decode()[1:] for x in batch.column(0).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(texts, pa.string())], ["row", "decoded"])

    made = rows.mapInArrow(decode, schema)
    others = [c for c in encoded.columns if c != "text"]
    return made.select(*[F.col("row")[c].alias(c) for c in others], F.col("decoded").alias("text"))
