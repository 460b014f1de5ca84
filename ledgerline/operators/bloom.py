"""Bloom-filter reduction of a large side before its shuffle, in native expressions.

A join on one key often meets a second, selective join on another key only
afterwards (loans and repayments meet on the loan, the few late members are
known by member). ``reduce_by`` drops most rows that the later join cannot
keep, where they are scanned: the key set is folded into a filter of fixed
size, broadcast, and probed in the scan's own stage.

The filter is a table of 64-bit words, one row each: a key sets ``BITS`` bits of
the word that it hashes to, words are combined by ``bit_or`` (partial aggregation:
a task ships a word once), and a row passes if its word has all its bits. Keys in the set always
pass; others pass by chance (about 4 % at 11 bits a key). The table has at most
``words`` rows whatever the number of keys, so the broadcast has a proven bound
(2^18 words: some 10 MB); with more keys than it was laid out for more rows
pass, and the result of the later join stays the same.

Rows with a NULL key never pass (they join with nothing).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of the filter: 2^18 serve 1.5 million keys at 11 bits each.
WORDS = 1 << 18
WORDS_CONF = "spark.ledgerline.bloomWords"
BITS = 3


def filter_words(df: DataFrame) -> int:
    """Size of the filter: the session's setting, else ``WORDS``."""
    words = int(df.sparkSession.conf.get(WORDS_CONF, str(WORDS)))
    if words < 1:
        raise ValueError(f"{WORDS_CONF} must be at least 1")
    return words


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words))


def _bits(key: Column) -> Column:
    """The bits that a key sets in its word, from a hash independent of the word's."""
    # hash() and xxhash64() are unrelated functions; six bits of it for each place
    other = F.hash(key, F.lit("bits"))
    mask = F.lit(0).cast("long")
    for i in range(BITS):
        place = F.shiftrightunsigned(other, 6 * i).bitwiseAND(63)
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask


def key_filter(keys: DataFrame, key: str, words: int | None = None) -> DataFrame:
    """(_word, _bits): the filter over the non-NULL values of ``key``, at most ``words`` rows."""
    words = words or filter_words(keys)
    c = F.col(key)
    return (keys.filter(c.isNotNull()).select(_word(c, words).alias("_word"), _bits(c).alias("_key_bits"))
            .groupBy("_word").agg(F.bit_or("_key_bits").alias("_bits")))


def reduce_by(df: DataFrame, keys: DataFrame, key: str, words: int | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be among those of ``keys``: all that are, and few others."""
    words = words or filter_words(df)
    held = F.broadcast(key_filter(keys, key, words))  # at most ``words`` rows
    c = df[key]
    mask = _bits(c)
    passes = (_word(c, words) == held["_word"]) & (held["_bits"].bitwiseAND(mask) == mask)
    return df.filter(c.isNotNull()).join(held, passes, "left_semi")
