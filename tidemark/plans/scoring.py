"""One lazy plan that scores raw records, used by the batch and the stream jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark import schema as S
from tidemark.functions import scalars as X, sqltext as sql
from tidemark.operators import contributions, validate
from tidemark.operators.encoders import final_encoder
from tidemark.plans.training import Bundle


def encode(df: DataFrame, bundle: Bundle, keep: Sequence[str] = (S.KEY,)) -> DataFrame:
    """Raw records to the exact feature columns the trees were fitted on."""
    aligned = validate.align_columns(df, bundle.inputs, keep)
    encoded = bundle.forest.transform(bundle.pipeline.transform(aligned))
    return validate.align_features(encoded, bundle.features, final_encoder(bundle.pipeline).fill, keep)


def score(df: DataFrame, bundle: Bundle, top: int = 3, carry: Sequence[str] = ()) -> DataFrame:
    """``(key, probability, is_flagged, threshold, top_factors, version)`` per record, and the columns to carry.

    Nothing is shuffled: encodings are keyed lookups, and the trees and the forest
    travel as broadcast arrays.
    """
    rows = encode(df, bundle, (S.KEY, *carry))
    features = sql.double_array(bundle.features)
    chance, terms = bundle.columns(df.sparkSession)
    computed = rows.select(S.KEY, *carry, features.alias("_values"), chance.alias("_p"), terms.alias("_terms"))
    return computed.select(
        S.KEY,
        *carry,
        F.round("_p", 6).alias("probability"),
        X.decide(F.col("_p"), bundle.threshold).alias("is_flagged"),
        F.lit(bundle.threshold).alias("threshold"),
        contributions.factor_column(F.col("_terms"), F.col("_values"), bundle.features, top).alias("top_factors"),
        F.lit(bundle.version).alias("version"),
    )


def score_checked(df: DataFrame, bundle: Bundle) -> tuple[DataFrame, DataFrame]:
    """Scores of the valid records, and the quarantined ones with their broken fields."""
    checked = validate.check_rows(df)
    return score(validate.valid_rows(checked), bundle), validate.quarantined_rows(checked)
