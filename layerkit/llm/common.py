"""Small helpers shared by the operators: words as the contracts define them,
staged tables in the shared folder, and broadcasts behind a checked size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerkit.session import scratch_path

# White space of the word contract (space, TAB..CR).
SPACES = " \t\n\x0b\x0c\r"
SPACE_RE = r"[\x20\x09-\x0D]+"
WORD_RE = r"[^\x20\x09-\x0D]"

# A side is broadcast only when it was counted and is within this many rows.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str, records_per_file: int = 0) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts lineage: what follows reads files that every executor sees, so a
    lost executor never repeats the work above.
    """
    path = scratch_path(df.sparkSession, name)
    w = df.write
    if records_per_file:
        w = w.option("maxRecordsPerFile", records_per_file)
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (already staged) with a broadcast hint when its counted rows are
    within ``max_rows``; without one otherwise, and then the join shuffles."""
    return F.broadcast(df) if df.count() <= max_rows else df


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row: a lambda that
    names a column inside another lambda would compute it per element."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text (NULL: none), in order, natively."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, SPACE_RE))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only (``lower`` would also change other letters)."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def free_name(taken: list[str], base: str) -> str:
    """A column name starting with ``base`` that clashes with none of ``taken``
    (Spark compares names without regard to case)."""
    low = {c.lower() for c in taken}
    name, n = base, 0
    while name.lower() in low:
        n += 1
        name = f"{base}_{n}"
    return name


def col(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


# A key that holds more than one row in so many counts as hot: there are fewer
# hot keys than this, whatever the rows.
HOT_SHARE = 10_000


def counted_join(rows: DataFrame, facts: DataFrame, keys: list[str], n: str, total: int, salt: Column) -> DataFrame:
    """``rows`` left-joined with ``facts`` on ``keys``, no key's rows in one task.

    ``facts`` (staged) has one row per key, and in ``n`` how many of the
    ``total`` rows hold it. The facts of hot keys, fewer than ``HOT_SHARE`` by
    counting, are broadcast; the rest meet by shuffle, where no key is left
    with more than a ``HOT_SHARE``-th of all rows. Rows already served are
    dealt out by ``salt``, a column that tells rows apart. Keys are not NULL;
    facts and rows share no other column name.
    """
    cut = F.col(n) > max(total // HOT_SHARE, 1)
    held = [c for c in facts.columns if c not in keys]
    hot = facts.where(cut).select(*keys, F.struct(*held).alias("_hot_facts"))
    first = facts.schema[keys[0]].dataType
    dealt = rows.join(F.broadcast(hot), keys, "left")
    served = F.col("_hot_facts").isNotNull()
    dealt = dealt.withColumn("_dealt", F.when(served, salt.cast(first)).otherwise(F.col(keys[0])))
    rest = facts.where(~cut).select(*[F.col(k).alias(f"_rest_{k}") for k in keys], F.struct(*held).alias("_rest_facts"))
    on = (F.col("_dealt") == F.col(f"_rest_{keys[0]}")) & ~served
    for k in keys[1:]:
        on = on & (F.col(k) == F.col(f"_rest_{k}"))
    found = F.coalesce("_hot_facts", "_rest_facts")
    return dealt.join(rest, on, "left").select(*rows.columns, *[found[c].alias(c) for c in held])


def ranked(rows: DataFrame, order: list[Column], name: str, rank: str = "rank") -> DataFrame:
    """``rows`` with their place (1, 2, 3 ...) in ``order``, staged.

    One range split, then every task numbers its own rows; the tasks' row
    counts, one each, give where a task begins. No task holds all rows.
    """
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # the task's number in the upper 31 bits, the row's in the lower 33
    placed = stage(sorted_rows.withColumn("_place", F.monotonically_increasing_id()), name)
    part, at = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    begins = parts.select("_part", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_begin"))
    found = placed.join(F.broadcast(begins), part == F.col("_part"))
    return found.select(*rows.columns, (F.col("_begin") + at + 1).alias(rank))
