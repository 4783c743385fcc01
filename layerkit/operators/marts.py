"""Per-layer marts and row counts.

Every mart is a hash aggregate with map-side partial aggregation, so a hot
company, state or year collapses to one row per task before the shuffle.
Counts are BIGINT.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerkit.functions.dates import year_text
from layerkit.layout import COMPLAINTS, Layout
from layerkit.operators.promote import valid_records


def _n() -> F.Column:
    return F.count(F.lit(1))


def mart_company(df: DataFrame, layout: Layout = COMPLAINTS) -> DataFrame:
    """Distinct companies (a NULL company is one row)."""
    return df.select(F.col(layout.company).alias("company")).distinct()


def mart_by_state(df: DataFrame, layout: Layout = COMPLAINTS) -> DataFrame:
    """Rows per state, largest first (the NULL state is a group)."""
    return (
        df.groupBy(F.col(layout.state).alias("state"))
        .agg(_n().alias("count"))
        .orderBy(F.desc("count"), F.asc_nulls_last("state"))
    )


def _year_of(df: DataFrame, layout: Layout) -> F.Column:
    # Typed layers carry the partition year; the first layer derives it.
    if layout.partition in df.columns:
        return F.col(layout.partition)
    return year_text(layout.date)


def mart_by_year(df: DataFrame, layout: Layout = COMPLAINTS) -> DataFrame:
    """Rows per year, newest first. On the first layer an undated or
    malformed date counts under a NULL year."""
    return (
        df.groupBy(_year_of(df, layout).alias("year"))
        .agg(_n().alias("count"))
        .orderBy(F.desc_nulls_last("year"))
    )


def year_profile(df: DataFrame, layout: Layout = COMPLAINTS) -> DataFrame:
    """Valid rows per partition year, oldest first: what a promotion writes."""
    src = df if layout.partition in df.columns else valid_records(df, layout)
    return (
        src.groupBy(_year_of(src, layout).alias(layout.partition))
        .agg(_n().alias("count"))
        .orderBy(F.asc_nulls_first(layout.partition))
    )


def row_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """One row per named layer with its row count."""
    parts = [
        df.agg(_n().alias("rows")).select(F.lit(name).alias("layer"), "rows")
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def mart_counts(df: DataFrame, layout: Layout = COMPLAINTS) -> DataFrame:
    """The counts of all three marts from one scan: ``mart``, ``value``, ``n``,
    by grouping sets, with partial aggregation before the shuffle."""
    keys = df.select(
        F.col(layout.company).alias("company"), F.col(layout.state).alias("state"), _year_of(df, layout).alias("year")
    )
    c, s, y = F.col("company"), F.col("state"), F.col("year")
    sets = keys.groupingSets([[c], [s], [y]], c, s, y).agg(F.grouping_id().alias("set"), _n().alias("n"))
    # grouping_id has a bit per column left out: company 4, state 2, year 1
    mart = F.when(F.col("set") == 3, "company").when(F.col("set") == 5, "summary_by_state").otherwise("summary_by_year")
    return sets.select(mart.alias("mart"), F.coalesce(c, s, y).alias("value"), "n")


def signed_counts(rows: DataFrame, n: str, layout: Layout = COMPLAINTS) -> DataFrame:
    """Like ``mart_counts``, of rows that each add their ``n``, which may be
    negative; values whose changes cancel out are left out."""
    names = {"company": layout.company, "summary_by_state": layout.state, "summary_by_year": layout.partition}
    each = F.array(*[F.struct(F.lit(m).alias("mart"), F.col(c).cast("string").alias("value")) for m, c in names.items()])
    found = rows.select(F.col(n).alias("n"), F.explode(each).alias("x")).groupBy("x.mart", "x.value").agg(F.sum("n").alias("n"))
    return found.where("n <> 0")


def apply_delta(counts: DataFrame, delta: DataFrame) -> DataFrame:
    """``mart_counts`` after ``signed_counts``: values that reach zero go."""
    both = counts.select("mart", "value", "n").unionByName(delta.select("mart", "value", "n"))
    return both.groupBy("mart", "value").agg(F.sum("n").alias("n")).where("n <> 0")


def split_marts(counts: DataFrame) -> dict[str, DataFrame]:
    """The mart tables of ``mart_counts``, by name, in their order."""
    of = lambda m: counts.where(F.col("mart") == m)
    state = of("summary_by_state").select(F.col("value").alias("state"), F.col("n").alias("count"))
    year = of("summary_by_year").select(F.col("value").alias("year"), F.col("n").alias("count"))
    return {
        "company": of("company").select(F.col("value").alias("company")),
        "summary_by_state": state.orderBy(F.desc("count"), F.asc_nulls_last("state")),
        "summary_by_year": year.orderBy(F.desc_nulls_last("year")),
    }


def build_marts(df: DataFrame, layout: Layout = COMPLAINTS) -> dict[str, DataFrame]:
    """The three marts of a layer, by mart table name."""
    return {
        "company": mart_company(df, layout),
        "summary_by_state": mart_by_state(df, layout),
        "summary_by_year": mart_by_year(df, layout),
    }
