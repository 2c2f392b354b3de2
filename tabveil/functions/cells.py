"""Mixed-radix cell numbers: the last attribute of a marginal varies fastest."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# A packed key holds the marginal above these bits and the cell below them.
CELL_BITS = 40


def table_size(attrs: Sequence[str], sizes: Mapping[str, int]) -> int:
    return math.prod(sizes[a] for a in attrs)


def strides(attrs: Sequence[str], sizes: Mapping[str, int]) -> list[int]:
    return [table_size(attrs[i + 1:], sizes) for i in range(len(attrs))]


def cell_of(attrs: Sequence[str], sizes: Mapping[str, int]) -> Column:
    """Cell number of a coded row."""
    total = F.lit(0).cast("long")
    for attr, stride in zip(attrs, strides(attrs, sizes)):
        total = total + F.col(attr).cast("long") * F.lit(stride).cast("long")
    return total


def code_in(cell: Column, attr: str, attrs: Sequence[str], sizes: Mapping[str, int]) -> Column:
    """The code of ``attr`` in a cell number."""
    stride = strides(attrs, sizes)[list(attrs).index(attr)]
    return F.pmod(F.floor(cell / F.lit(stride)), F.lit(sizes[attr])).cast("int")


def pack(marginal_id: Column, cell: Column) -> Column:
    return F.shiftleft(marginal_id.cast("long"), CELL_BITS) + cell


def unpack(packed: Column) -> tuple[Column, Column]:
    return (
        F.shiftright(packed, CELL_BITS).cast("int"),
        packed.bitwiseAND(F.lit((1 << CELL_BITS) - 1)),
    )
