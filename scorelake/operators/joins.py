"""Joining a large table with a dimension."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The same bound Spark uses for the broadcasts it plans by itself.
BROADCAST_BYTES = 10 * 1024 * 1024
SALTS = 16
#: Keys that may be taken for hot, and of how many rows a hot key has one at least.
HOT_KEYS = 64
HOT_SHARE = 200


def join_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    on: str,
    spread_by: str,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Inner join on column ``on``; broadcasts ``dimension`` after measuring its size.

    A larger dimension is joined by shuffle instead. Its rows of hot keys, which a sketch of the
    facts' most frequent keys tells, are copied ``SALTS`` times and meet the facts by the hash of
    ``spread_by`` as well; other rows stay single. As the salt is no key of what follows, adaptive
    execution may split it further.
    """
    text = F.to_json(F.struct(*dimension.columns))
    size = dimension.agg(F.sum(F.octet_length(text)).alias("bytes")).first()["bytes"] or 0
    if size <= broadcast_bytes:
        return facts.join(F.broadcast(dimension), on)
    hot = hot_keys(facts, on)
    if not hot:
        return facts.join(dimension, on)
    is_hot = F.col(on).isin(*hot)
    one = F.lit(0)
    copies = F.explode(F.when(is_hot, F.sequence(one, F.lit(SALTS - 1))).otherwise(F.array(one)))
    salt = F.when(is_hot, F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int")).otherwise(one)
    return (
        facts.withColumn("salt", salt)
        .join(dimension.withColumn("salt", copies), [on, "salt"])
        .drop("salt")
    )


def hot_keys(facts: DataFrame, on: str, most: int = HOT_KEYS, share: int = HOT_SHARE) -> list:
    """Keys that at least one of ``share`` rows has, ``most`` of them at most; one scan of that column.

    The sketch tracks more keys than can be hot, so that none of these is missed.
    """
    tracked = 8 * max(most, share)
    top = F.expr(f"approx_top_k(`{on}`, {most}, {tracked})").alias("top")
    row = facts.filter(F.col(on).isNotNull()).agg(top, F.count("*").alias("rows")).first()
    return sorted(entry["item"] for entry in row["top"] or [] if entry["count"] * share >= row["rows"])
