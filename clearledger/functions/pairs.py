"""Pairs of rows that share a key, with no task that holds all rows of a common key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a key in one block: a task key pairs two blocks, so it joins BLOCK rows with BLOCK rows.
BLOCK = 500


def blocked(df: DataFrame, keys: list[str], member: str, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Both sides of the join, each with _i and _j: the pair of blocks of the key in which a row takes part.

    A key with more than `block` rows is dealt to as many blocks as hold `block` of its rows on average, by a hash of the member; others have one. A row
    of block b is on the left of (b, j) for j >= b and on the right of (i, b) for i <= b, so every two rows of a key meet in one pair of blocks.
    """
    large = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > block).select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.ceil(F.col("_n") / block).cast("int").alias("_blocks"))
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_of_{k}") for k in keys])
    blocks = F.coalesce("_blocks", F.lit(1))
    dealt = df.join(large, same, "left").select(*df.columns, blocks.alias("_blocks"), F.pmod(F.xxhash64(member), blocks).cast("int").alias("_b"))
    left = dealt.withColumn("_j", F.explode(F.sequence(F.col("_b"), F.col("_blocks") - 1))).withColumnRenamed("_b", "_i").drop("_blocks")
    right = dealt.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_b")))).withColumnRenamed("_b", "_j").drop("_blocks")
    return left, right


def pairs(df: DataFrame, keys: list[str], member: str, carry: list[str], block: int = BLOCK) -> DataFrame:
    """(keys, a, b): each two rows of a key with different members once, as structs of member and carry, the smaller member first.

    Rows with a null key pair with nothing; a member occurs once in a key.
    """
    left, right = blocked(df.select(*keys, member, *carry), keys, member, block)
    one = lambda c: F.struct(member, *carry).alias(c)
    met = left.select(*keys, "_i", "_j", one("_x")).join(right.select(*keys, "_i", "_j", one("_y")), [*keys, "_i", "_j"])
    x, y = F.col(f"_x.{member}"), F.col(f"_y.{member}")
    once = (x < y) | ((F.col("_i") < F.col("_j")) & (x > y))  # rows of two blocks meet on one side only
    first: Column = x < y
    return met.where(once).select(*keys, F.when(first, F.col("_x")).otherwise(F.col("_y")).alias("a"), F.when(first, F.col("_y")).otherwise(F.col("_x")).alias("b"))
