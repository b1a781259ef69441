"""A bit table of fixed size as a prefilter before an exact join.

Its size does not depend on the input, so it may be broadcast; when more keys
are set than it can tell apart it only filters less.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audix.llm.common import releasing

#: Bits of a table (2 MB).
BITS = 1 << 24


def bit_table(hashes: DataFrame, bits: int = BITS) -> np.ndarray:
    """Table of ``bits`` (a power of two) with those of a 64-bit hash column set; at most ``bits / 32`` words reach the driver."""
    (name,) = hashes.columns
    word = F.shiftright(F.col(name).bitwiseAND(F.lit(bits - 1)), 5)
    words = (hashes.select(word.alias("w"), F.expr(f"shiftleft(1L, int({name} & 31))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())
    out = np.zeros(bits >> 5, np.int64)
    out[words.column("w").to_numpy()] = words.column("b").to_numpy()
    return out


def is_set(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes.view(np.uint64) & np.uint64(32 * len(table) - 1)).astype(np.int64)
    return (table[at >> 5] >> (at & 31)) & 1 == 1


def with_bit(rows: DataFrame, bits: np.ndarray, value: bool) -> DataFrame:
    """Rows whose column ``_hash`` has its bit set (or not)."""
    table = rows.sparkSession.sparkContext.broadcast(bits)
    at = rows.columns.index("_hash")

    @releasing
    def run(batches):
        for batch in batches:
            hashes = batch.column(at).to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(is_set(table.value, hashes) == value))

    return rows.mapInArrow(run, rows.schema)
