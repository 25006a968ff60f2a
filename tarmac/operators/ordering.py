"""Top-k, repeatable limits, sampling, stacking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: Sequence[Column], tie: Sequence[str], k: int) -> DataFrame:
    """First k rows by ``order``, ties broken by key so the answer is repeatable.

    Planned as a bounded heap per task and one merge of k rows each.
    """
    return df.orderBy(*order, *tie).limit(k)


def limit_only(df: DataFrame, key: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*key).limit(n)


def hash_fraction(key: Column, seed: int, portable: bool = False) -> Column:
    """A number in [0, 1) that depends on key and seed only.

    ``portable`` uses md5, which other engines can reproduce; the default hash is
    cheaper.
    """
    if portable:
        digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))
        return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(4294967296)) / F.lit(4294967296.0)


def bernoulli_sample(df: DataFrame, key: str, fraction: float, seed: int, portable: bool = False) -> DataFrame:
    """Keep each row with the given probability; unaffected by partitioning or retries."""
    return df.filter(hash_fraction(F.col(key), seed, portable) < fraction)


def random_sample(df: DataFrame, key: str, n: int, seed: int, portable: bool = False) -> DataFrame:
    """n rows in random order (a seeded, repeatable ORDER BY RANDOM() LIMIT n)."""
    return df.orderBy(hash_fraction(F.col(key), seed, portable), key).limit(n)


def union_all(tagged: Mapping[str, DataFrame], tag: str = "domain") -> DataFrame:
    """Stack compatible results, each row carrying the name of its part."""
    parts = [df.select(F.lit(name).alias(tag), "*") for name, df in tagged.items()]
    return reduce(DataFrame.unionByName, parts)
