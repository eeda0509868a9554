"""Exploration aggregates: missing values, classes, correlations, value counts.

Each profile is one pass over the table, however many columns it covers: a wide
aggregate gives one row, which is then turned into one row per column.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidemark import schema as S
from tidemark.functions import scalars as X, sqltext as sql
from tidemark.operators.ordering import exact_quantiles
from tidemark.session import written


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def dtype_counts(df: DataFrame) -> DataFrame:
    """Number of columns per type; read from the schema."""
    rows = sorted(Counter(kind for _, kind in df.dtypes).items())
    return df.sparkSession.createDataFrame(rows, "dtype string, n_columns int")


def _per_column(df: DataFrame, columns: Sequence[str], measures: dict[str, str]) -> DataFrame:
    """One aggregate over all columns, turned to one row per column.

    A measure is SQL text over ``{c}``, the column, and ``{missing}``, its test.
    """
    aggs, entries = [F.count(F.lit(1)).alias("_rows")], []
    for i, column in enumerate(columns):
        parts = {"c": sql.name(column), "missing": sql.is_missing(column, df.schema[column].dataType)}
        aggs += [F.expr(f"{measure.format(**parts)} AS _{key}_{i}") for key, measure in measures.items()]
        held = ", ".join(f"{sql.text(key)}, _{key}_{i}" for key in measures)
        entries.append(f"named_struct('column', {sql.text(column)}, {held})")
    return df.agg(*aggs).select("_rows", sql.rows_of(entries).alias("c")).select("c.*", F.col("_rows").alias("n_rows"))


N_MISSING = "count_if({missing})"


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, n_missing, missing_rate)`` of every column, in one pass."""
    profile = _per_column(df, columns or df.columns, {"n_missing": N_MISSING})
    return profile.select(
        "column", "n_missing", X.ratio(F.col("n_missing"), F.col("n_rows")).alias("missing_rate")
    )


def most_missing(df: DataFrame, top: int = 20) -> DataFrame:
    return missing_profile(df).orderBy(F.col("missing_rate").desc(), "column").limit(top)


def with_family(profile: DataFrame) -> DataFrame:
    """Adds the column family to a per-column table."""
    column = F.col("column")
    family = None
    for name, pattern in S.FAMILIES.items():
        test = column.rlike(pattern.pattern)
        family = F.when(test, name) if family is None else family.when(test, name)
    return profile.withColumn("family", family.otherwise("other"))


def column_families(df: DataFrame) -> DataFrame:
    """Columns per family, and how many values they hold."""
    profile = _per_column(df, df.columns, {"n_missing": N_MISSING})
    return with_family(profile).groupBy("family").agg(
        F.count(F.lit(1)).alias("n_columns"),
        F.sum(F.col("n_rows") - F.col("n_missing")).alias("n_values"),
    )


def missing_by_family(df: DataFrame, cut: float = 0.7) -> DataFrame:
    return with_family(missing_profile(df)).groupBy("family").agg(
        F.min("missing_rate").alias("rate_min"),
        F.max("missing_rate").alias("rate_max"),
        F.count_if(F.col("missing_rate") > cut).alias("n_above_cut"),
    )


def missing_summary(df: DataFrame, cut: float = 0.7) -> DataFrame:
    rate = F.col("missing_rate")
    return missing_profile(df).agg(
        F.count_if(rate == 0).alias("n_complete"),
        F.count_if(rate > 0).alias("n_with_missing"),
        F.count_if(rate <= cut).alias("n_surviving"),
        F.count(F.lit(1)).alias("n_columns"),
    )


def missing_bands(df: DataFrame) -> DataFrame:
    return (
        missing_profile(df)
        .select(X.missing_band(F.col("missing_rate")).alias("band"))
        .where(F.col("band").isNotNull())
        .groupBy("band").agg(F.count(F.lit(1)).alias("n_columns"))
    )


def missing_cells(df: DataFrame) -> DataFrame:
    """Missing cells over the whole table."""
    return missing_profile(df).agg(F.sum("n_missing").cast("long").alias("n_missing"))


def low_variance(df: DataFrame, columns: Sequence[str] | None = None, cut: float = 0.01) -> DataFrame:
    """Numeric columns whose sample standard deviation is below ``cut``."""
    spread = _per_column(df, columns or numeric_columns(df), {"std": "stddev_samp(CAST({c} AS DOUBLE))"})
    return spread.where(F.col("std") < cut).select("column", "std")


def class_distribution(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Count and share of each label, with the negative-to-positive ratio."""
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    # A row per label value reaches this window: two.
    everything = Window.partitionBy(F.lit(0))
    negatives = F.sum(F.when(F.col("label") == 0, F.col("n_rows"))).over(everything)
    positives = F.sum(F.when(F.col("label") == 1, F.col("n_rows"))).over(everything)
    return counts.select(
        "label", "n_rows",
        (F.col("n_rows") / F.sum("n_rows").over(everything)).alias("share"),
        (negatives / F.greatest(positives, F.lit(1))).alias("imbalance"),
    )


def category_rates(df: DataFrame, column: str, label: str = S.LABEL) -> DataFrame:
    """Count, positives and positive rate per category; the missing category is left out."""
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("category")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col(label).cast("long")).alias("n_positive"),
        F.avg(F.col(label).cast("double")).alias("rate"),
    )


def top_categories(df: DataFrame, column: str, label: str = S.LABEL, top: int = 8) -> DataFrame:
    return category_rates(df, column, label).orderBy(F.col("n_rows").desc(), "category").limit(top)


def _long_strings(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("p")).select("p.*").where(F.col("value").isNotNull())


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, n_rows)`` of several columns in one shuffle."""
    return _long_strings(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n_rows"))


def cardinality(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct values and missing share of string columns.

    The exact count goes through one row per distinct value; the approximate one is a
    single pass with a constant-size sketch per column.
    """
    columns = list(columns or string_columns(df))
    profile = missing_profile(df, columns).select("column", "missing_rate")
    if approximate:
        distinct = _per_column(df, columns, {"n_distinct": "approx_count_distinct({c})"})
        distinct = distinct.select("column", "n_distinct")
    else:
        distinct = value_counts(df, columns).groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))
    # A row per column on both sides.
    return profile.join(F.broadcast(distinct), "column", "left").select(
        "column", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"), "missing_rate"
    )


def distinct_values(df: DataFrame, columns: Sequence[str], limit: int | None = None) -> DataFrame:
    """Sorted distinct values of low-cardinality columns, one row per value."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    values = df.select(F.explode(pairs).alias("p")).select("p.*").where(F.col("value").isNotNull()).distinct()
    ordered = values.orderBy("column", "value")
    return ordered if limit is None else ordered.limit(limit)


def time_span(df: DataFrame, time: str = S.TIME) -> DataFrame:
    return df.agg(F.min(time).alias("dt_min"), F.max(time).alias("dt_max")).select(
        "dt_min", "dt_max", ((F.col("dt_max") - F.col("dt_min")) / F.lit(float(S.SECONDS_PER_DAY))).alias("span_days")
    )


def family_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and missing share of numeric columns."""
    mean = "avg(CASE WHEN NOT {missing} THEN CAST({c} AS DOUBLE) END)"
    stats = _per_column(df, columns, {"n_missing": N_MISSING, "mean": mean})
    return stats.select("column", X.ratio(F.col("n_missing"), F.col("n_rows")).alias("missing_rate"), "mean")


def correlations(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Pearson r of every column with ``target`` over rows where both are present.

    NULL where a side is constant. One pass for all columns.
    """
    y = f"CAST({sql.name(target)} AS DOUBLE)"
    present = "NOT {missing} AND " + y.replace("{", "{{").replace("}", "}}") + " IS NOT NULL"
    x, paired = f"CASE WHEN {present} THEN CAST({{c}} AS DOUBLE) END", f"CASE WHEN {present} THEN {y} END"
    # NULLIF keeps a constant column from dividing by zero in ANSI mode.
    r = f"covar_pop({x}, {paired}) / nullif(stddev_pop({x}) * stddev_pop({paired}), 0D)"
    return _per_column(df, columns, {"r": r}).select(F.col("column").alias("feature"), "r")


def top_correlations(df: DataFrame, target: str, columns: Sequence[str], top: int = 30) -> DataFrame:
    defined = correlations(df, target, columns).where(F.col("r").isNotNull())
    return defined.orderBy(F.abs("r").desc(), "feature").limit(top)


def label_correlations(df: DataFrame, label: str = S.LABEL, top: int = 30) -> DataFrame:
    """Strongest numeric features by |r| with the label."""
    skip = {S.KEY, S.TIME, label}
    return top_correlations(df, label, [c for c in numeric_columns(df) if c not in skip], top)


def describe(df: DataFrame, column: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """count, mean, sample std, min, quantiles ``p<percent>``, max, optionally per group."""
    x = F.col(column).cast("double")
    moments = df.groupBy(*by).agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"), F.max(x).alias("max"),
    ).withColumn("feature", F.lit(column))
    quantiles = exact_quantiles(df, [column], probs, by).select(
        *by, "feature", *[F.col(f"q{i}").alias(percent_name(p)) for i, p in enumerate(probs)]
    )
    # One row per group on both sides.
    return moments.join(quantiles, [*by, "feature"], "left").drop("feature")


def percent_name(prob: float) -> str:
    return "p" + f"{prob * 100:.10g}".replace(".", "_")


def weekly_rate(df: DataFrame, label: str = S.LABEL, time: str = S.TIME) -> DataFrame:
    return df.groupBy(X.week_index(F.col(time)).alias("week")).agg(
        F.avg(F.col(label).cast("double")).alias("rate"), F.count(label).alias("n_rows")
    )


# Groups of a histogram whose ranges are part of its plan; those of more are joined by group.
PLANNED_GROUPS = 200


def histogram(df: DataFrame, column: str, bins: int, by: Sequence[str] = (), span: tuple[float, float] | None = None) -> DataFrame:
    """Density over equal-width bins of each group's own range; the last bin is closed.

    Empty bins have no row. A constant group falls in a unit-wide range around its value.
    Rows whose group is NULL are a group of their own. The ranges of a handful of groups go into
    the plan as literals: rows are counted per bin before any shuffle, so that a group of nearly
    all rows is no heavier than another. The ranges of more groups are written and joined by
    group; Spark broadcasts them while they are small.
    """
    x = F.col(column).cast("double")
    rows = df.where(x.isNotNull() & ~F.isnan(x)).select(*by, x.alias("_x"))
    if span is not None:
        rows = rows.where(F.col("_x").between(*span))
    found = rows.groupBy(*by).agg(F.min("_x").alias("_a"), F.max("_x").alias("_b"), F.count("_x").alias("_n"))
    ranges = found.limit(PLANNED_GROUPS + 1).collect()
    if len(ranges) > PLANNED_GROUPS:
        return _joined_histogram(rows, found, bins, by, span)
    low = width = total = F.lit(None).cast("double")
    for row in ranges:
        a, b = (row["_a"], row["_b"]) if span is None else map(float, span)
        if a is None:
            continue
        a, b = (a - 0.5, b + 0.5) if a == b else (a, b)
        here = F.lit(True)
        for name in by:
            here = here & F.col(name).eqNullSafe(F.lit(row[name]))
        low = F.when(here, F.lit(a)).otherwise(low)
        width = F.when(here, F.lit((b - a) / bins)).otherwise(width)
        total = F.when(here, F.lit(row["_n"])).otherwise(total)
    bin_index = F.least(F.floor((F.col("_x") - low) / width), F.lit(bins - 1)).cast("int")
    counted = rows.groupBy(*by, bin_index.alias("bin")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(
        *by, "bin", "n_rows", (low + F.col("bin") * width).alias("left"), (F.col("n_rows") / (total * width)).alias("density")
    )


def _joined_histogram(rows: DataFrame, ranges: DataFrame, bins: int, by: Sequence[str], span: tuple[float, float] | None) -> DataFrame:
    """The same for any number of groups: ranges are joined to the rows, NULL groups too."""
    a, b = ("_a", "_b") if span is None else (F.lit(float(span[0])), F.lit(float(span[1])))
    a, b = (F.col(a), F.col(b)) if span is None else (a, b)
    wide = F.when(a == b, 1.0).otherwise(b - a)
    known = written(ranges.select(
        *[F.col(name).alias(f"_by{i}") for i, name in enumerate(by)], F.when(a == b, a - 0.5).otherwise(a).alias("_low"), (wide / bins).alias("_width"), "_n"
    ), "ranges")
    same = F.lit(True)
    for i, name in enumerate(by):
        same = same & F.col(name).eqNullSafe(F.col(f"_by{i}"))
    bin_index = F.least(F.floor((F.col("_x") - F.col("_low")) / F.col("_width")), F.lit(bins - 1)).cast("int")
    held = rows.join(known, same).groupBy(*by, "_low", "_width", "_n", bin_index.alias("bin")).agg(F.count(F.lit(1)).alias("n_rows"))
    return held.select(
        *by, "bin", "n_rows", (F.col("_low") + F.col("bin") * F.col("_width")).alias("left"), (F.col("n_rows") / (F.col("_n") * F.col("_width"))).alias("density")
    )


def missing_rate_histogram(df: DataFrame, bins: int = 50) -> DataFrame:
    """Columns per missing-rate bin over [0, 1], complete columns left out."""
    rates = missing_profile(df).where(F.col("missing_rate") > 0)
    return histogram(rates, "missing_rate", bins, span=(0.0, 1.0))
