"""Joins of facts to dimensions.

No side is marked for broadcast by its role: Spark broadcasts a dimension only while its size is under the session's
threshold and joins by sorted partitions beyond it. There the fact side is a plain exchange, so that a partition made
large by one key (or by NULL keys) is split at run time. Checks and aggregates that only need keys reduce the fact to
key counts before they join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, columns: Sequence[str], how: str = "left"):
    """Attach columns of a dimension with a unique key. ``how`` is left (keep all facts) or inner."""
    side = dim.select(F.col(dim_key).alias("_dim_key"), *columns)
    return fact.join(side, F.col(fact_key) == F.col("_dim_key"), how).drop("_dim_key")


def distinct_keys(dim: DataFrame, key: str, name: str) -> DataFrame:
    """The keys of a table, each once, without NULL, as column ``name``.

    They are grouped along with their hash, which makes a join exchange them by the key alone: with plain exchanges on
    both sides it can split a frequent key of the other side.
    """
    keys = dim.select(F.col(key).alias(name)).filter(F.col(name).isNotNull())
    return keys.groupBy(name, F.hash(name).alias("_hash")).agg(F.count("*").alias("_copies")).select(name)


def known_or_null(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Keep every fact row once; a key the dimension does not have becomes NULL."""
    side = distinct_keys(dim, dim_key, "_dim_key")
    joined = fact.join(side, F.col(fact_key) == F.col("_dim_key"), "left")
    return joined.withColumn(fact_key, F.col("_dim_key")).drop("_dim_key")


def mark_known(fact: DataFrame, dim: DataFrame, fact_key: str | Column, dim_key: str, name: str) -> DataFrame:
    """Keep every fact row once and as it is; ``name`` says whether the dimension has its key.

    A key that is an expression travels to the join only.
    """
    side = distinct_keys(dim, dim_key, "_dim_key")
    keyed = fact if isinstance(fact_key, str) else fact.withColumn("_key", fact_key)
    key = fact_key if isinstance(fact_key, str) else "_key"
    joined = keyed.join(side, F.col(key) == F.col("_dim_key"), "left")
    return joined.select(*fact.columns, F.col("_dim_key").isNotNull().alias(name))


def orphan_rows(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact rows without a dimension row; a NULL key is an orphan too."""
    side = dim.select(F.col(dim_key).alias("_dim_key"))
    return fact.join(side, F.col(fact_key) == F.col("_dim_key"), "left_anti")


def orphan_keys(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Orphan keys (NULL among them) with their number of rows. A frequent key is one row before the join."""
    return orphan_rows(fact.groupBy(fact_key).agg(F.count("*").alias("n_rows")), dim, fact_key, dim_key)


def not_in(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """``left_key NOT IN (SELECT right_key ...)`` with its NULL rule, as a distributed anti join.

    One NULL on the right leaves no row, and then no row of the left is joined; a NULL on the left passes only if the
    right side is empty. Right keys are made distinct first, so that a frequent one is small.
    """
    facts = right.agg(
        F.count("*").alias("_n"), F.count_if(F.col(right_key).isNull()).alias("_nulls")
    )
    empty = facts.select(F.col("_n") == 0).scalar()
    no_nulls = facts.select(F.col("_nulls") == 0).scalar()
    possible = left.filter(empty | (no_nulls & F.col(left_key).isNotNull()))
    keys = distinct_keys(right, right_key, "_right_key")
    return possible.join(keys, F.col(left_key) == F.col("_right_key"), "left_anti")


def attach_to_few(few: DataFrame, dim: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Left lookup for a top-N result: the N keys go to the dimension, the dimension is not shuffled.

    ``few`` is the outcome of a LIMIT, which bounds what is broadcast.
    """
    wanted = F.broadcast(few.select(key))
    side = dim.select(key, *columns).join(wanted, key, "left_semi")
    return few.join(F.broadcast(side), key, "left")
