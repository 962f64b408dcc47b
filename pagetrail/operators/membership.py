"""Which rows may have a key of a set: a filter of bounded size, so that only those rows are shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of 64 bits in a filter unless told otherwise: 8 MB with their numbers, whatever the number of keys.
WORDS = 1 << 19
#: A key sets one bit of its word for each of these seeds.
SEEDS = (1, 2, 3)


def _word(keys: Sequence[str], words: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), *keys), F.lit(words))


def _mask(keys: Sequence[str]) -> Column:
    mask = F.lit(0).cast("long")
    for seed in SEEDS:
        place = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(64)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask


def split_by_keys(
    rows: DataFrame, wanted: DataFrame, keys: Sequence[str], words: int = WORDS
) -> tuple[DataFrame, DataFrame]:
    """The rows whose key may be in ``wanted``, and the rows whose key is not, without a shuffle of either.

    A Bloom filter whose keys keep their bits in one word is made from ``wanted``: at most ``words`` rows, so
    that it can always be broadcast. More keys let more other rows into the first part, at worst all of them;
    a row with a wanted key is never in the second part. NULL is a key like others. Each row is in
    one of the parts, repeated rows as often as they come; an empty ``wanted`` leaves all in the second.
    """
    marked = wanted.select(_word(keys, words).alias("__word"), _mask(keys).alias("__bits"))
    kept = F.broadcast(marked.groupBy("__word").agg(F.bit_or("__bits").alias("__bits")))
    mask = _mask(keys)
    hit = (_word(keys, words) == F.col("__word")) & (F.col("__bits").bitwiseAND(mask) == mask)
    return rows.join(kept, hit, "left_semi"), rows.join(kept, hit, "left_anti")
