"""Schema checks, key and label checks, row rules and column alignment."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark import schema as S
from tidemark.functions import sqltext as sql
from tidemark.operators.joins import merge_identity
from tidemark.operators.profile import missing_profile

logger = logging.getLogger(__name__)


def require_columns(df: DataFrame, required: Sequence[str], what: str) -> None:
    """Raise when a required column is absent; looks at the schema only."""
    absent = sorted(set(required) - set(df.columns))
    if absent:
        raise ValueError(f"{what} missing required columns: {absent}")


def duplicate_keys(df: DataFrame, key: str = S.KEY) -> DataFrame:
    """``n_duplicates``: rows beyond the first of their key."""
    # Counts combine before the shuffle, so a key held by a third of the rows is cheap.
    # NULL keys form one group, as they do in a frame library.
    return (
        df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("n_duplicates"))
    )


def label_violations(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Label values outside {0, 1} with their counts; missing labels pass."""
    return (
        df.where(F.col(label).isNotNull() & ~F.col(label).isin(0, 1))
        .groupBy(F.col(label).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    )


def rate_check(df: DataFrame, label: str = S.LABEL, bounds: tuple[float, float] = S.EXPECTED_RATE) -> DataFrame:
    """Positive rate with ``severity``: ``ok`` inside the expected range, else ``warn``."""
    rate = df.agg(F.avg(F.col(label).cast("double")).alias("rate"))
    return rate.select(
        "rate", F.when(F.col("rate").between(*bounds), F.lit("ok")).otherwise(F.lit("warn")).alias("severity")
    )


def table_diagnostics(df: DataFrame) -> DataFrame:
    """Shape, positives, rate and time range in one aggregate."""
    label = F.col(S.LABEL)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.sum(label.cast("long")).alias("n_positive"),
        F.avg(label.cast("double")).alias("rate"),
        F.min(S.TIME).alias("dt_min"),
        F.max(S.TIME).alias("dt_max"),
    )


def validate_raw(transactions: DataFrame, identity: DataFrame, key: str = S.KEY) -> None:
    """Hard checks of the raw pair, cheapest first."""
    require_columns(transactions, S.REQUIRED_TRANSACTION, "Transaction table")
    require_columns(identity, S.REQUIRED_IDENTITY, "Identity table")
    for name, frame in (("Transaction", transactions), ("Identity", identity)):
        n = duplicate_keys(frame, key).first()[0]
        if n:
            raise ValueError(f"{name} table has {n} duplicate {key}s")


def validate_merged(df: DataFrame, key: str = S.KEY, label: str = S.LABEL) -> None:
    """Hard checks of the merged table raise; an unusual positive rate only warns."""
    require_columns(df, S.REQUIRED_TRANSACTION, "Merged table")
    n = duplicate_keys(df, key).first()[0]
    if n:
        raise ValueError(f"Merged table has {n} duplicate {key}s; the identity table likely had duplicate keys")
    # One pass over the label gives both the domain and the rate.
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    bad = counts.where(F.col(label).isNotNull() & ~F.col(label).isin(0, 1))
    summary = counts.agg(
        F.sum(F.when(F.col(label).isNotNull(), F.col(label) * F.col("n"))).alias("positives"),
        F.sum(F.when(F.col(label).isNotNull(), F.col("n"))).alias("labelled"),
        F.count_if(F.col(label).isNotNull() & ~F.col(label).isin(0, 1)).alias("bad"),
    ).first()
    if summary["bad"]:
        values = [row[0] for row in bad.select(label).orderBy(label).limit(20).collect()]
        raise ValueError(f"{label} contains unexpected values: {values}")
    rate = (summary["positives"] or 0) / max(summary["labelled"] or 0, 1)
    if not S.EXPECTED_RATE[0] <= rate <= S.EXPECTED_RATE[1]:
        logger.warning("positive rate %.3f%% is outside the expected range", 100 * rate)


def load_dataset(transactions: DataFrame, identity: DataFrame) -> DataFrame:
    """Check, join and check again; the join itself stays lazy."""
    validate_raw(transactions, identity)
    merged = merge_identity(transactions, identity)
    validate_merged(merged)
    return merged


def high_missing_count(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    return missing_profile(df).agg(F.count_if(F.col("missing_rate") > threshold).alias("n_columns"))


# --------------------------------------------------------------------------- row rules


def row_errors(df: DataFrame) -> Column:
    """Names of the fields of a row that break a rule, in a fixed order, then those of a wrong type."""
    names = set(df.columns)

    def absent(name: str) -> Column:
        return F.col(name).isNull() if name in names else F.lit(True)

    checks: list[tuple[str, Column]] = [(S.TIME, absent(S.TIME))]
    if S.AMOUNT in names:
        amount = F.col(S.AMOUNT)
        checks.append(
            (S.AMOUNT, amount.isNull() | F.isnan(amount) | (amount <= 0) | (amount > S.MAX_AMOUNT))
        )
    else:
        checks.append((S.AMOUNT, F.lit(True)))
    for flag, values in [*((flag, ("T", "F")) for flag in S.BINARY_FLAGS), (S.TRI_FLAG, S.TRI_FLAG_VALUES)]:
        # A flag that came as an extra is fed to the model like any other.
        held = F.col(flag) if flag in names else F.col("extras")[flag] if "extras" in names else None
        if held is not None:
            checks.append((flag, held.isNotNull() & ~held.isin(*values)))
    broken = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in checks]))
    return F.array_union(broken, F.col("misfits")) if "misfits" in names else broken


def check_rows(df: DataFrame) -> DataFrame:
    """Adds ``errors``; a valid row has none."""
    return df.withColumn("errors", row_errors(df))


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("errors") == 0).drop("errors")


def quarantined_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("errors") > 0)


# --------------------------------------------------------------------------- alignment


def align_columns(df: DataFrame, template: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Columns of ``template`` in its order; absent ones are NULL, extra ones dropped.

    An ``extras`` map, when present, is searched for template fields the frame lacks.
    """
    names = set(df.columns)
    columns = [F.col(c) for c in keep if c in names]
    for field in template:
        if field.name in keep:
            continue
        kind, target = field.dataType.simpleString(), sql.name(field.name)
        if field.name in names:
            column = f"try_cast({target} AS {kind})"
        elif "extras" in names:
            column = f"try_cast(extras[{sql.text(field.name)}] AS {kind})"
        else:
            column = f"CAST(NULL AS {kind})"
        columns.append(F.expr(f"{column} AS {target}"))
    return df.select(*columns)


def align_features(
    df: DataFrame, features: Sequence[str], fill: dict[str, float] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Feature columns in training order; one the frame lacks gets its ``fill`` or NULL."""
    absent = [f for f in features if f not in df.columns]
    if absent:
        logger.warning("padding absent feature columns: %s", absent)
    fill = fill or {}
    padded = [
        F.col(f) if f in df.columns else F.lit(fill.get(f)).cast("double").alias(f) for f in features
    ]
    return df.select(*[c for c in keep if c in df.columns], *padded)
