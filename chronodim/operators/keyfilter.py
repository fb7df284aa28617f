"""A Bloom filter of keys as a small table: prunes a large side before a join.

The filter has at most ``WORDS`` rows (16 bytes each), whatever the number of
keys: a key sets ``PROBES`` bits of one 64-bit word.  So it may be broadcast,
and testing a row is one hash lookup.  A row whose key is held always passes;
others pass by chance, so a join must follow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, BooleanType, ByteType, DateType, DecimalType, IntegerType, LongType, ShortType, StringType,
                               TimestampNTZType, TimestampType)

WORDS = 1 << 20
PROBES = 3
WORD, BITS = "__word", "__bits"

# equal values of these types have equal hashes
HASHED = (BinaryType(), BooleanType(), ByteType(), DateType(), IntegerType(), LongType(), ShortType(), StringType(), TimestampNTZType(), TimestampType())


def can_filter(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> bool:
    """Whether the keys have the same hashable type on both sides."""
    return all(left.schema[k].dataType == right.schema[k].dataType and (left.schema[k].dataType in HASHED or isinstance(left.schema[k].dataType, DecimalType)) for k in keys)


def _word(keys: Sequence[str], words: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(words))


def _bits(keys: Sequence[str]) -> Column:
    h = F.hash(*[F.col(k) for k in keys])
    out = F.lit(0).cast("long")
    for i in range(PROBES):
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 6 * i).bitwiseAND(F.lit(63))))
    return out


def key_filter(df: DataFrame, keys: Sequence[str], words: int = WORDS) -> DataFrame:
    """(__word, __bits): the filter of the keys of ``df``, folded in its tasks."""
    return df.groupBy(_word(keys, words).alias(WORD)).agg(F.bit_or(_bits(keys)).alias(BITS))


def may_hold(df: DataFrame, held: DataFrame, keys: Sequence[str], words: int = WORDS) -> DataFrame:
    """Rows of ``df`` whose key may be one of those in the filter ``held``."""
    cols = df.columns
    own = df.withColumn("__own_word", _word(keys, words)).withColumn("__own_bits", _bits(keys))
    hit = (F.col("__own_word") == F.col(WORD)) & (F.col("__own_bits").bitwiseAND(F.col(BITS)) == F.col("__own_bits"))
    return own.join(F.broadcast(held), hit, "left_semi").select(*cols)
