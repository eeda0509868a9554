"""Identity join, join coverage and table lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark import schema as S


def merge_identity(transactions: DataFrame, identity: DataFrame, key: str = S.KEY) -> DataFrame:
    """Left join that keeps every transaction; unmatched identity fields are NULL.

    No hint: the identity table grows with the data, so the planner broadcasts it
    only when its size allows and otherwise shuffles both sides once on the key.
    """
    return transactions.join(identity, key, "left")


def identity_coverage(transactions: DataFrame, identity: DataFrame, key: str = S.KEY) -> DataFrame:
    """How many transactions found an identity row: matched, total, percentage."""
    hits = identity.select(key, F.lit(1).alias("_hit"))
    counted = transactions.select(key).join(hits, key, "left").agg(
        F.count("_hit").alias("n_matched"), F.count(F.lit(1)).alias("n_rows")
    )
    return counted.select(
        "n_matched", "n_rows",
        (F.lit(100.0) * F.col("n_matched") / F.greatest(F.col("n_rows"), F.lit(1))).alias("pct_matched"),
    )


# A key is hot when more than one row in this many has it; its rows go to this many tasks.
HOT_SHARE, SALTS = 1_000, 64


def is_broadcast(table: DataFrame) -> bool:
    """Whether the planner will copy a stored table to every task, by its bytes."""
    spark = table.sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def hot_keys(table: DataFrame) -> dict[str, list[str]]:
    """Hot categories per column of a ``(column, category, n, …)`` table.

    At most ``HOT_SHARE`` per column, as their shares add up to one.
    """
    totals = table.groupBy("column").agg(F.sum("n").alias("all")).collect()  # a row per column
    is_hot = F.lit(False)
    for row in totals:
        is_hot = is_hot | ((F.col("column") == row["column"]) & (F.col("n") * HOT_SHARE > row["all"]))
    hot: dict[str, list[str]] = {row["column"]: [] for row in totals}
    for row in table.where(is_hot & F.col("category").isNotNull()).select("column", "category").collect():
        hot[row["column"]].append(row["category"])
    return hot


def lookup(
    df: DataFrame, table: DataFrame, column: str, value: str, default, target: str,
    hot: list[str] | None = None, key: str = S.KEY,
) -> DataFrame:
    """``table[column] -> value`` with a default for unseen and missing keys.

    ``table`` has unique keys and comes from storage, so its bytes are known and the
    planner broadcasts a small one. Otherwise ``hot`` lists its hot keys: their rows, and
    those without a key, are spread over tasks by a salt from their own row key, and only
    the hot entries are copied once per salt.
    """
    side = table.select(F.col(table.columns[0]).alias(column), F.col(value).alias("_value"))
    on = [column]
    if not is_broadcast(side):
        hot = hot or []
        own = [key] if key in df.columns else df.columns
        salt = F.pmod(F.xxhash64(*own), F.lit(SALTS)).cast("int")
        spread = F.col(column).isNull() | F.col(column).isin(hot)
        df = df.withColumn("_salt", F.when(spread, salt).otherwise(F.lit(0)))
        copies = F.when(F.col(column).isin(hot), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
        side = side.withColumn("_salt", F.explode(copies))
        on.append("_salt")
    return (
        df.join(side, on, "left")
        .withColumn(target, F.coalesce(F.col("_value"), F.lit(default)))
        .drop("_value", "_salt")
    )
