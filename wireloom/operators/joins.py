"""Joins of a large table with a lookup table, safe for hot keys and for lookups that grow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wireloom.session import checkpointed

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
#: Pieces that one task's share of the facts is cut into where a key is spread, so that tasks come out even.
PIECES = 32

_SALT, _SALTS, _KEY = "_salt", "_salts", "_key"


def fits_broadcast(
    lookup: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> bool:
    """Measure a lookup table: True where rows and text bytes are within the bounds.

    Both are summed where the rows are; a lookup that is to be measured should be a
    scan or a stored table, not something that is costly to compute twice.
    """
    row_bytes = F.octet_length(F.to_json(F.struct(*lookup.columns)))
    rows, size = lookup.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def hot_keys(facts: DataFrame, keys: Sequence[str], pieces: int = PIECES) -> DataFrame:
    """(_key, _salts): hashes of the keys with more than half a task's share of the facts, and how often to split them.

    One aggregate with a mergeable sketch of frequent items finds them; only the keys are read.  At most two keys for
    each shuffle partition can be hot, so the result is small by definition.  The sketch's error is below a quarter of a
    task's share.
    """
    parts = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tracked = min(1_000_000, 16 * parts)
    frequent = F.call_function("approx_top_k", F.col(_KEY), F.lit(min(2 * parts, tracked)), F.lit(tracked))
    counted = facts.select(F.xxhash64(*keys).alias(_KEY)).agg(frequent.alias("items"), F.count(F.lit(1)).alias("rows"))
    counts = counted.select(F.explode("items").alias("found"), "rows").select("found.*", "rows")
    salts = F.ceil(F.col("count") * (parts * pieces) / F.col("rows")).cast("int")
    return counts.filter(F.col("count") * (2 * parts) > F.col("rows")).select(F.col("item").alias(_KEY), salts.alias(_SALTS))


def spread(
    facts: DataFrame, lookup: DataFrame, keys: Sequence[str], by: Sequence[str] | None = None, pieces: int = PIECES
) -> tuple[DataFrame, DataFrame]:
    """Facts and lookup with a column ``_salt`` that cuts hot keys into pieces; joins and groups use it next to the keys.

    Facts of a hot key get a salt from a hash of the columns ``by`` (all, if none are named; such as tell rows apart);
    its lookup rows are repeated once per salt.  All other keys have one salt.  The salt depends on row content only: a
    recomputed task gives every row the same place again.
    """
    hot = F.broadcast(checkpointed(hot_keys(facts, keys, pieces)))
    key = F.xxhash64(*keys)
    place = F.when(F.col(_SALTS).isNull(), 0).otherwise(F.pmod(F.xxhash64(*(by or facts.columns)), F.col(_SALTS)).cast("int"))
    salted = facts.join(hot, key == F.col(_KEY), "left").select(*facts.columns, place.alias(_SALT))
    salts = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1))
    return salted, lookup.join(hot, key == F.col(_KEY), "left").select(*lookup.columns, salts.alias(_SALT))


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    max_rows: int = MAX_BROADCAST_ROWS,
    by: Sequence[str] | None = None,
) -> DataFrame:
    """Join many facts with a lookup table that has one row per key.

    A lookup measured as small is broadcast, so the facts do not move at all.  With a
    larger one the keys of the facts are measured, and those that hold more than half
    a task's share are spread (``spread``); all others are joined plainly.

    ``how`` is inner, left, left_semi or left_anti; facts are the left side.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    keys = [on] if isinstance(on, str) else list(on)
    if fits_broadcast(lookup, max_rows):
        return facts.join(F.broadcast(lookup), keys, how)
    salted_facts, salted_lookup = spread(facts, lookup, keys, by)
    return salted_facts.join(salted_lookup, [*keys, _SALT], how).drop(_SALT)
