"""A bitmap of fixed size that tells which keys are surely absent from a set.

Rows whose key is in a small part of the corpus (a repeated digest, a changed document) are told apart
from the rest where they are read, so that the rest needs no shuffle. The bitmap has 2**BITS bits,
whatever the input; a wrong hit only sends a row the longer way, so results never depend on it. Beyond
some 10^8 keys most rows take that way, which is then the plain join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamelake.llm.common import bounded_batches

#: 16 MB that are sent to each executor.
BITS = 27


def bitmap(keys: DataFrame) -> bytes:
    """The bits of the keys (the only column of keys, long; null ones are left out). What reaches the
    driver is the bitmap, in parts of 8 KB."""
    key = F.col(keys.columns[0])
    spots = keys.filter(key.isNotNull()).select(F.explode(F.array(F.shiftrightunsigned(key, 64 - BITS), F.shiftrightunsigned(F.shiftleft(key, BITS), 64 - BITS))).alias("at"))
    words = spots.distinct().select((F.shiftright("at", 16)).cast("int").alias("word"), F.col("at").bitwiseAND(F.lit(0xFFFF)).cast("int").alias("bit")).groupBy("word").agg(F.collect_list("bit").alias("bits"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = []
            for bits in batch.column("bits"):
                one = np.zeros(1 << 16, np.uint8)
                one[bits.values.to_numpy()] = 1
                maps.append(np.packbits(one, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(maps, pa.binary())], ["word", "map"])

    bounded_batches(keys.sparkSession)
    whole = np.zeros(1 << (BITS - 3), np.uint8)
    for r in words.mapInArrow(pack, "word int, map binary").collect():
        whole[r["word"] << 13 : (r["word"] + 1) << 13] = np.frombuffer(r["map"], np.uint8)
    return whole.tobytes()


def held(bits: bytes, keys: np.ndarray) -> np.ndarray:
    """False where the key is surely not among those of the bitmap."""
    own, k, out = np.frombuffer(bits, np.uint8), keys.view(np.uint64), np.ones(len(keys), bool)
    for at in (k >> np.uint64(64 - BITS), (k << np.uint64(BITS)) >> np.uint64(64 - BITS)):
        at = at.astype(np.int64)
        out &= ((own[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)
    return out


def may_hold(df: DataFrame, bits: bytes, key: Column) -> Column:
    """False where the key (long) is surely not among those of the bitmap; the key isn't null."""
    sent = df.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def told(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(held(sent.value, part.to_numpy(np.int64)))

    return told(key)
