"""Token counts without tokens: the best segmentation's score and number of pieces.

An Aho-Corasick automaton lists all vocabulary matches of a unit by their end. Dynamic programming
keeps, for each end, the best score and the piece count on it; nothing is traced back. Ties go to the piece
that starts first (the longest), as in the public unigram tokenizers: a later candidate has to be better, not
equal. Unknown characters count their bytes. Equal units are counted once per worker, as long as they
are remembered.

Null and empty texts have no pieces. Repeated rows get a row each. Extra columns pass through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabveil.llm.common import content, once_per_worker
from tabveil.llm.pieces import Vocabulary, bytes_of, units_of

KNOWN_UNITS = 400_000
COUNTED = "n_tokens long, score double"


class Counter:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.known = vocabulary, {}

    def unit(self, unit: str) -> tuple[int, float]:
        raw = bytes_of(unit)
        if raw is not None:
            return len(raw), len(raw) * 0.0 + self.vocabulary.unknown
        best, count = [0.0] + [None] * len(unit), [0] * (len(unit) + 1)
        for end, length, i, score in self.vocabulary.matches(unit):
            before = best[end - length]
            if before is None:
                continue
            candidate = before + score
            if best[end] is None or candidate > best[end]:
                best[end] = candidate
                count[end] = count[end - length] + (len(unit[end - 1].encode()) if i < 0 else 1)
        return count[-1], best[-1]

    def text(self, text: str) -> tuple[int, float]:
        known, n, score = self.known, 0, 0.0
        if len(known) > KNOWN_UNITS:
            known.clear()
        for unit in units_of(text):
            found = known.get(unit)
            if found is None:
                found = known[unit] = self.unit(unit)
            n += found[0]
            score += found[1]
        return n, score


def count_tokens(docs: DataFrame, model: bytes, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``n_tokens`` and ``score`` (of the best segmentation) of each row."""
    rows = docs.select(content(text).alias("body"), F.struct(*keep).alias("row"))
    schema = rows.select("row").schema.add("n_tokens", "long").add("score", "double")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            counter = counter or once_per_worker(f"counter_{zlib.crc32(model)}", lambda: Counter(Vocabulary(model)))
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                made = [counter.text(t) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), pa.array([n for n, _ in made], pa.int64()), pa.array([s for _, s in made], pa.float64())],
                    ["row", "n_tokens", "score"],
                )

    return rows.mapInArrow(count, schema).select("row.*", "n_tokens", "score")
