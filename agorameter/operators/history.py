"""New links against all that were collected before."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorameter.session import shipped

#: Bits of the filter (4 MB) and places of each link in it.
BITS, HASHES = 1 << 25, 4


def false_share(links: int, bits: int = BITS, hashes: int = HASHES) -> float:
    """The share of other links that a filter of so many links lets through."""
    return (1 - math.exp(-hashes * links / bits)) ** hashes


def _places(column: str, bits: int, hashes: int) -> Column:
    return F.array(*(F.pmod(F.xxhash64(F.col(column), F.lit(i)), F.lit(bits)) for i in range(hashes)))


def bloom(links: DataFrame, column: str, bits: int = BITS, hashes: int = HASHES) -> np.ndarray:
    """A Bloom filter of the links as words of 64 bits; at most ``bits / 64`` rows come to the driver."""
    place = F.explode(_places(column, bits, hashes)).alias("place")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("place", F.lit(64)).cast("int"))
    rows = links.select(place).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    found, words = rows.toPandas(), np.zeros(bits // 64, dtype=np.int64)
    words[found["word"].to_numpy(dtype=np.int64)] = found["bits"].to_numpy(dtype=np.int64)
    return words


def possibly_in(
    df: DataFrame, column: str, words: np.ndarray, bits: int = BITS, hashes: int = HASHES
) -> DataFrame:
    """The column's values that a filter lets through: all that are in it, and few others."""
    shipped(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(1).flatten().to_numpy().reshape(-1, hashes)
            set_bits = (shared.value[places >> 6] >> (places & 63)) & 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(set_bits.all(axis=1)))], names=[column]
            )

    kind = df.schema[column].dataType.simpleString()
    return df.select(column, _places(column, bits, hashes).alias("places")).mapInArrow(
        run, f"{column} {kind}"
    )


def new_links(
    links: DataFrame, known: DataFrame, column: str = "url", bits: int = BITS, hashes: int = HASHES
) -> DataFrame:
    """Each link once that is not among the known ones; exact.

    A Bloom filter of the new links is laid over the known ones before they are shuffled, so
    of a long history only what may be met again moves: :func:`false_share` says how much more
    than that. A missing link is left out.
    """
    once = links.where(F.col(column).isNotNull()).select(column).distinct()
    met = possibly_in(known.where(F.col(column).isNotNull()), column, bloom(once, column, bits, hashes), bits, hashes)
    return once.join(met, column, "left_anti")
