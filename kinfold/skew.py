"""Joins that stay spread out when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from kinfold.session import ensure_checkpoint_dir

HOT_ROWS = 1_000_000  # a key with this many rows is worth salting
SALTS = 64
TASK_ROWS = 250_000  # rows of a task that makes several values out of each
MAX_BROADCAST_ROWS = 200_000


def hot_row_limit(frame: DataFrame) -> int:
    return int(frame.sparkSession.conf.get("kinfold.hotRows", str(HOT_ROWS)))


def hot_keys(rows: DataFrame, keys: list[str]) -> DataFrame | None:
    """All keys above the limit, or None when there are none.

    A job of its own that reads the key columns only. With the usual limit it
    counts one row in a thousand, where a hot key still shows up about a
    thousand times; a small limit counts all rows. The count merely decides
    which keys the join spreads out: the join itself reads every row. The keys
    stay in the checkpoint folder.
    """
    limit = hot_row_limit(rows)
    fraction = min(1.0, 1_000 / limit)
    if fraction < 1:
        rows, limit = rows.sample(fraction, seed=11), int(limit * fraction / 2)
    return _top(rows.groupBy(*keys).agg(F.count("*").alias("_n")), keys, "_n", limit)


def heaviest(counts: DataFrame, keys: list[str], count: str) -> DataFrame | None:
    """``hot_keys`` on rows already counted per key."""
    return _top(counts, keys, count, hot_row_limit(counts))


def _top(counts: DataFrame, keys: list[str], count: str, limit: int) -> DataFrame | None:
    ensure_checkpoint_dir(counts.sparkSession)
    top = counts.filter(F.col(count) >= limit).select(*keys)
    return None if top.isEmpty() else top.checkpoint()


def spread(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows by key in so many tasks that each has ``kinfold.taskRows`` of them on average, whatever their number.

    For a step that makes many values out of each row: adaptive execution sizes tasks by the
    packed bytes that come in and knows nothing of what a task makes of them. The count is a job of its
    own that reads no column. Few rows stay as they are.
    """
    conf = rows.sparkSession.conf
    limit, n = int(conf.get("kinfold.taskRows", str(TASK_ROWS))), rows.count()
    if n <= limit:
        return rows
    return rows.repartition(max(-(-n // limit), int(conf.get("spark.sql.shuffle.partitions"))), *keys)


def salted_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", hot: DataFrame | None = None
) -> DataFrame:
    """Equi join whose ``hot`` left keys are dealt out over ``SALTS`` tasks; a plain join without any.

    Left rows of a hot key get a salt from a hash of their other columns, maps included; right
    rows of that key are repeated once per salt. Every left row still meets
    every right row of its key exactly once, so inner, left, left_semi and
    left_anti joins all keep their meaning. Keys below the limit take salt 0, the
    ordinary way.
    """
    if hot is None:
        return left.join(right, keys, how)
    mark = checked_broadcast(hot.select(*keys).withColumn("_hot", F.lit(True)))
    salted_left = left.join(mark, keys, "left").withColumn("_salt", _salt(left, keys)).drop("_hot")
    every_salt = F.sequence(F.lit(0), F.lit(SALTS - 1))
    salted_right = (
        right.join(mark, keys, "left")
        .withColumn("_salt", F.explode(F.when(F.col("_hot"), every_salt).otherwise(F.array(F.lit(0)))))
        .drop("_hot")
    )
    return salted_left.join(salted_right, keys + ["_salt"], how).drop("_salt")


def _salt(rows: DataFrame, keys: list[str]) -> Column:
    """The salt of a row marked ``_hot``, 0 for others: a hash of all its other columns.

    Maps have no hash of their own; theirs is that of their JSON text, made for hot
    rows only. Rows with no other column are alike, and dealt out by their place in the task.
    """
    others = [field for field in rows.schema.fields if field.name not in keys]
    hashed = [F.to_json(field.name) if isinstance(field.dataType, MapType) else F.col(field.name) for field in others]
    deal = F.xxhash64(*hashed) if hashed else F.monotonically_increasing_id()
    return F.when(F.col("_hot"), F.pmod(deal, F.lit(SALTS)).cast("int")).otherwise(F.lit(0))


def is_small(table: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether a table has few enough rows to be broadcast; a job of its own."""
    return table.limit(max_rows + 1).count() <= max_rows


def checked_broadcast(table: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, settle: bool = False) -> DataFrame:
    """Broadcast a configuration-like table once its row count is known to be small.

    The count is a job of its own. ``settle`` writes a derived table to a
    checkpoint first, so that it is worked out once. A larger table comes back
    without the hint and Spark joins it by shuffle.
    """
    if settle:
        ensure_checkpoint_dir(table.sparkSession)
        table = table.checkpoint()
    return F.broadcast(table) if is_small(table, max_rows) else table

