"""Order statistics and prefix sums over data of any size.

Nothing here sorts a whole table in one task. Two ideas do the work:

* *Bracketing.* One mergeable sketch pass brackets a wanted rank; an exact counting
  pass then lists only the values inside the brackets and counts everything between
  them as one row per gap. The result is exact, and what is shuffled is a small share
  of the data.
* *Range buckets.* Rows get a bucket by literal split points, so a retried task
  computes the same bucket again. Running sums are windows inside a bucket plus the
  total of the buckets before it, one row per bucket.
"""

from __future__ import annotations

import datetime
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.functions import sqltext as sql

# Values a single window task may hold in order; more of them get another sketch pass.
MAX_BRACKET_ROWS = 4_000_000
SKETCH_ACCURACY = 1_000
# Rows of a range bucket of a prefix sum to aim for; a row per bucket is gathered or broadcast.
BUCKET_ROWS = 1_000_000


# --------------------------------------------------------------------------- brackets


@dataclass
class _Target:
    """One wanted position in one group of one feature, and its current bracket."""

    feature: str
    group: tuple
    prob: float
    low: object = None
    high: object = None
    count: int = 0


def _merge(intervals: list[tuple]) -> list[tuple]:
    merged: list[list] = []
    for low, high in sorted(intervals):
        if merged and low <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], high)
        else:
            merged.append([low, high])
    return [tuple(pair) for pair in merged]


def _sketch(df: DataFrame, cells: Sequence[str], by: Sequence[str], targets_probs, accuracy: int):
    """One pass: non-null count and bracket of every wanted position."""
    wanted = []
    for prob in targets_probs:
        wanted += [max(prob - 2.0 / accuracy, 0.0), min(prob + 2.0 / accuracy, 1.0)]
    probs = f"array({', '.join(sql.number(float(p)) for p in wanted)})"
    aggs = []
    for i in range(len(cells)):
        aggs.append(F.expr(f"count(_c{i}) AS n{i}"))
        aggs.append(F.expr(f"percentile_approx(_c{i}, {probs}, {accuracy}) AS q{i}"))
    return df.groupBy(*by).agg(*aggs).collect()


def _narrow(df, cells, by, kind, targets: list[_Target], accuracy: int) -> None:
    """Two more passes that shrink every bracket by another factor of the accuracy."""
    place = {feature: i for i, feature in enumerate(cells)}

    def inside(t: _Target) -> str:
        here = " AND ".join(f"{sql.name(c)} <=> {_group_literal(v)}" for c, v in zip(by, t.group)) or "TRUE"
        return f"{here} AND _c{place[t.feature]} BETWEEN {sql.number(t.low, kind)} AND {sql.number(t.high, kind)}"

    def below(t: _Target) -> str:
        here = " AND ".join(f"{sql.name(c)} <=> {_group_literal(v)}" for c, v in zip(by, t.group)) or "TRUE"
        return f"{here} AND _c{place[t.feature]} < {sql.number(t.low, kind)}"

    counts = []
    for i, t in enumerate(targets):
        counts += [F.expr(f"count_if({below(t)}) AS b{i}"), F.expr(f"count_if({inside(t)}) AS m{i}")]
    row = df.agg(*counts).first()
    aggs = []
    for i, t in enumerate(targets):
        held = max(row[f"m{i}"], 1)
        rank = (t.count - 1) * t.prob - row[f"b{i}"]
        # A rank right at the bracket's edge (ties) is inside after clamping.
        share = min(max(rank / held, 0.0), 1.0)
        low, high = max(share - 2.0 / accuracy, 0.0), min(share + 2.0 / accuracy, 1.0)
        probs = f"array({sql.number(low)}, {sql.number(high)})"
        value = f"CASE WHEN {inside(t)} THEN _c{place[t.feature]} END"
        aggs.append(F.expr(f"percentile_approx({value}, {probs}, {accuracy}) AS q{i}"))
    row = df.agg(*aggs).first()
    for i, t in enumerate(targets):
        if row[f"q{i}"] is not None:
            t.low, t.high = row[f"q{i}"]


def _group_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (datetime.datetime, datetime.date)):
        kind = "TIMESTAMP" if isinstance(value, datetime.datetime) else "DATE"
        return f"{kind} '{value}'"
    return sql.text(value) if isinstance(value, str) else str(value)


def _folded(df, cells, by, brackets: dict[str, list[tuple]], kind: str) -> DataFrame:
    """Exact counts of bracketed values; a gap between brackets is one row.

    ``at`` orders the rows of a feature: a bracketed value itself, or the upper end
    of the bracket below a gap (``gap`` = 1 sorts the gap after that value). Gaps and
    one-value brackets, nearly all of the data, are counted by a wide aggregate; only
    values inside the other brackets become rows of their own.
    """
    aggs, counted, listed, hit = [], [], [], []

    def count(feature: str, where: str, cell: str, at, gap: int) -> None:
        i, held = len(counted), f"CASE WHEN {where} THEN {cell} END"
        aggs.extend([F.expr(f"count_if({where}) AS n{i}"), F.expr(f"min({held}) AS a{i}"), F.expr(f"max({held}) AS b{i}")])
        counted.append(
            f"named_struct('feature', {sql.text(feature)}, 'at', {sql.number(at, kind)}, 'gap', {gap}, "
            f"'n', n{i}, 'v_min', a{i}, 'v_max', b{i})"
        )

    for i, feature in enumerate(cells):
        cell, last = f"_c{i}", None
        for low, high in brackets.get(feature, ()):
            below = f"{cell} < {sql.number(low, kind)}"
            if last is not None:
                below += f" AND {cell} > {sql.number(last, kind)}"
            count(feature, below, cell, last, 1)
            if low == high:
                count(feature, f"{cell} = {sql.number(low, kind)}", cell, low, 0)
            else:
                inside = f"{cell} BETWEEN {sql.number(low, kind)} AND {sql.number(high, kind)}"
                hit.append(f"coalesce({inside}, FALSE)")
                listed.append(f"CASE WHEN {inside} THEN named_struct('feature', {sql.text(feature)}, 'at', {cell}) END")
            last = high
        if last is not None:
            count(feature, f"{cell} > {sql.number(last, kind)}", cell, last, 1)

    shape = [*by, "feature", "at", "gap", "n", "v_min", "v_max"]
    gaps = (
        df.groupBy(*by).agg(*aggs).select(*by, sql.rows_of(counted).alias("c")).select(*by, "c.*")
        .where(F.col("n") > 0).select(*shape)
    )
    if not listed:
        return gaps
    values = (
        df.where(" OR ".join(hit))
        .select(*by, F.expr(f"explode(array_compact(array({', '.join(listed)})))").alias("c"))
        .groupBy(*by, "c.feature", "c.at").agg(F.count(F.lit(1)).alias("n"))
        .select("*", F.lit(0).alias("gap"), F.col("at").alias("v_min"), F.col("at").alias("v_max"))
    )
    return gaps.unionByName(values.select(*shape))


def _positioned(folded: DataFrame, by: Sequence[str]) -> DataFrame:
    keys = [*by, "feature"]
    ordered = Window.partitionBy(*keys).orderBy(F.col("at").asc_nulls_first(), "gap")
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return folded.select(
        *keys, "gap", "n", "v_min", "v_max",
        F.sum("n").over(running).alias("upto"),
        F.sum("n").over(Window.partitionBy(*keys)).alias("total"),
    )


def _value_at(position: str) -> str:
    """Value at a 0-based position; NULL on rows that do not hold it.

    In a gap only its ends are known; the sketch bound never asks for more.
    """
    return (
        f"CASE WHEN {position} >= upto - n AND {position} < upto THEN "
        f"CASE WHEN gap = 0 OR {position} = upto - n THEN v_min WHEN {position} = upto - 1 THEN v_max END END"
    )


def _cells(df: DataFrame, cells: dict[str, Column], by: Sequence[str]) -> DataFrame:
    """The group columns and the cells as ``_c0, _c1, …``."""
    return df.select(*by, *[cell.alias(f"_c{i}") for i, cell in enumerate(cells.values())])


def _bracket(df, cells, by, kind, probs, accuracy, limit):
    targets: list[_Target] = []
    for row in _sketch(df, cells, by, probs, accuracy):
        group = tuple(row[c] for c in by)
        for i, feature in enumerate(cells):
            if not row[f"n{i}"]:
                continue
            for j, prob in enumerate(probs):
                low, high = row[f"q{i}"][2 * j], row[f"q{i}"][2 * j + 1]
                targets.append(_Target(feature, group, prob, low, high, row[f"n{i}"]))
    share = 4.0 / accuracy
    rows = max((t.count * share for t in targets), default=0)
    while rows > limit:
        _narrow(df, cells, by, kind, targets, accuracy)
        rows *= share
    brackets: dict[str, list[tuple]] = {}
    for t in targets:
        brackets.setdefault(t.feature, []).append((t.low, t.high))
    return {feature: _merge(spans) for feature, spans in brackets.items()}, targets


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str] | dict[str, Column],
    probs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = SKETCH_ACCURACY,
    limit: int = MAX_BRACKET_ROWS,
) -> DataFrame:
    """Linear-interpolated quantiles of many columns: ``(by…, feature, n, q0, q1, …)``.

    Missing values are skipped and a column without values has no row. Memory per
    task is a sketch per column, then at most about ``limit`` distinct values of one
    column, whatever the table's size. ``by`` is meant for a handful of groups.
    """
    if isinstance(columns, dict):
        cells = {name: F.nanvl(cell.cast("double"), F.lit(None)) for name, cell in columns.items()}
    else:
        cells = {c: F.expr(f"nanvl(CAST({sql.name(c)} AS DOUBLE), NULL)") for c in columns}
    table = _cells(df, cells, by)
    brackets, targets = _bracket(table, cells, by, "DOUBLE", probs, accuracy, limit) if cells else ({}, [])
    if not targets:
        fields = [df.schema[c] for c in by] + [T.StructField("feature", T.StringType()), T.StructField("n", T.LongType())]
        fields += [T.StructField(f"q{i}", T.DoubleType()) for i in range(len(probs))]
        return df.sparkSession.createDataFrame([], T.StructType(fields))
    aggs, results = ["max(total) AS n"], []
    for i, prob in enumerate(probs):
        place = f"((total - 1) * {sql.number(float(prob))})"
        below, above = f"floor{place}", f"least(floor{place} + 1, total - 1)"
        aggs += [
            f"max({_value_at(below)}) AS lo{i}", f"max({_value_at(above)}) AS hi{i}", f"max({place} - {below}) AS w{i}",
        ]
        # lo + (hi - lo) * w is exactly lo when both neighbours are equal, so a cut at
        # a tied value still includes the tie.
        results.append(F.expr(f"lo{i} + (hi{i} - lo{i}) * w{i} AS q{i}"))
    placed = _positioned(_folded(table, cells, by, brackets, "DOUBLE"), by)
    return placed.groupBy(*by, "feature").agg(*map(F.expr, aggs)).select(*by, "feature", "n", *results)


# --------------------------------------------------------------------------- cut keys


@dataclass(frozen=True)
class CutKey:
    """Where a sorted table is cut: rows ordered before the cut satisfy :meth:`before`.

    ``first`` alone cuts between values; ``second`` cuts inside a run of equal ones.
    ``None`` for ``first`` means everything is before the cut.
    """

    first: int | float | None
    second: int | None = None

    def before(self, first: str, second: str) -> Column:
        if self.first is None:
            return F.lit(True)
        smaller = F.col(first) < F.lit(self.first)
        if self.second is None:
            return smaller
        return smaller | ((F.col(first) == F.lit(self.first)) & (F.col(second) < F.lit(self.second)))

    def not_before(self, first: str, second: str) -> Column:
        if self.first is None:
            return F.lit(False)
        if self.second is None:
            return F.col(first) >= F.lit(self.first)
        return (F.col(first) > F.lit(self.first)) | (
            (F.col(first) == F.lit(self.first)) & (F.col(second) >= F.lit(self.second))
        )


def _order_statistics(df, column, fractions, positions, accuracy, limit):
    """Exact ``(value, rows below it, rows equal to it)`` at 0-based positions, and the count.

    ``fractions`` say roughly where the positions are; ``positions`` maps the exact
    row count, known after the sketch pass, to the positions themselves.
    """
    kind = df.schema[column].dataType.simpleString()
    cells = {column: F.col(column)}
    table = _cells(df, cells, ())
    brackets, targets = _bracket(table, cells, (), kind, fractions, accuracy, limit)
    count = targets[0].count if targets else 0
    inside = sorted({p for p in positions(count) if 0 <= p < count})
    if not inside:
        return {}, count
    aggs = []
    for i, p in enumerate(inside):
        value = _value_at(str(p))
        entry = f"named_struct('v', {value}, 'below', upto - n, 'n', n, 'gap', gap)"
        aggs.append(F.expr(f"max(CASE WHEN {value} IS NOT NULL THEN {entry} END) AS p{i}"))
    row = _positioned(_folded(table, cells, (), brackets, kind), ()).agg(*aggs).first()
    found = {}
    for i, p in enumerate(inside):
        hit = row[f"p{i}"]
        if hit is None:
            raise RuntimeError(f"position {p} of {column} fell outside its bracket")
        if hit["gap"]:
            # The row counts of a gap are not those of one value.
            below, equal = df.select(
                F.count_if(F.col(column) < hit["v"]), F.count_if(F.col(column) == hit["v"])
            ).first()
        else:
            below, equal = hit["below"], hit["n"]
        found[p] = (hit["v"], below, equal)
    return found, count


def cut_keys(
    df: DataFrame,
    first: str,
    second: str,
    fractions: Sequence[float],
    positions: Callable[[int], Sequence[int]],
    accuracy: int = SKETCH_ACCURACY,
    limit: int = MAX_BRACKET_ROWS,
) -> tuple[list[CutKey], int]:
    """Keys of the rows at 0-based ``positions(row count)`` in the order ``(first, second)``.

    Needs two narrow passes over one column and no sort. A run of equal ``first``
    values, however long, is cut by the same search over ``second``. Returns the keys
    and the row count. ``fractions[i]`` is where ``positions(n)[i]`` lies, as a share.
    """
    found, count = _order_statistics(df, first, fractions, positions, accuracy, limit)
    keys = []
    for p in positions(count):
        if p >= count:
            keys.append(CutKey(None))
            continue
        value, below, equal = found[max(p, 0)]
        if p <= below:
            keys.append(CutKey(value))
            continue
        run = df.where(F.col(first) == F.lit(value)).select(second)
        inner, _ = _order_statistics(
            run, second, [(p - below) / equal], lambda _, offset=p - below: [offset], accuracy, limit
        )
        keys.append(CutKey(value, inner[p - below][0]))
    return keys, count


# ----------------------------------------------------------------------- prefix sums


def _bucket_count(df: DataFrame) -> int:
    """Range buckets to aim for: some per shuffle partition, more if they would grow too large."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(8, 2 * partitions, math.ceil(df.count() / BUCKET_ROWS))


def _split_points(df: DataFrame, column: Column, buckets: int) -> list[float]:
    probs = sql.doubles([i / buckets for i in range(1, buckets)])
    row = df.select(F.percentile_approx(column.cast("double"), probs, max(4 * buckets, 100)).alias("q")).first()
    return list(row["q"] or [])


def _bucketize(df: DataFrame, source: str, target: str, points: Sequence[float]) -> DataFrame:
    """Bucket index by literal split points (binary search, JVM side)."""
    splits = [-math.inf, *sorted(set(points)), math.inf]
    return (
        Bucketizer(splits=splits, inputCol=source, outputCol=target, handleInvalid="skip")
        .transform(df)
        .withColumn(target, F.col(target).cast("int"))
    )


def score_ladder(
    df: DataFrame, score: str, label: str, by: Sequence[str] = (), buckets: int | None = None
) -> DataFrame:
    """Running counts over distinct scores, highest first.

    Columns: ``by…, score, pos, neg`` (rows at this score), ``pos_upto, neg_upto``
    (rows at this score or higher), ``pos_all, neg_all`` (group totals),
    ``pos_next, neg_next`` (rows at the next lower score, NULL at the lowest) and
    ``rung`` = whether this is the ``first`` of its group.

    Rows are pre-aggregated per score before any window, so a score shared by a third
    of the table is one row, and each window covers one bucket of distinct scores.
    """
    # The group columns travel as one struct: it is never NULL itself, so groups with
    # missing values join and partition like any other.
    group = [F.struct(*by).alias("_g")] if by else []
    keys = ["_g", "_bucket"] if by else ["_bucket"]
    rows = df.select(*group, F.col(score).cast("double").alias("score"), F.col(label).cast("int").alias("_y"))
    rows = rows.where("score IS NOT NULL AND NOT isnan(score) AND _y IS NOT NULL")
    points = _split_points(rows, F.col("score"), buckets or _bucket_count(df))
    counts = (
        _bucketize(rows, "score", "_bucket", points)
        .groupBy(*keys, "score")
        .agg(F.expr("count_if(_y = 1) AS pos"), F.expr("count_if(_y <> 1) AS neg"))
    )
    # One row per group and bucket from here: the windows below see at most that many.
    totals = counts.groupBy(*keys).agg(
        F.expr("sum(pos) AS bucket_pos"), F.expr("sum(neg) AS bucket_neg"), F.expr("max(struct(score, pos, neg)) AS head")
    )
    part = "PARTITION BY _g" if by else "PARTITION BY 0"
    higher = f"OVER ({part} ORDER BY _bucket DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    offsets = totals.selectExpr(
        *keys,
        f"coalesce(sum(bucket_pos) {higher}, 0) AS pos_before", f"coalesce(sum(bucket_neg) {higher}, 0) AS neg_before",
        f"sum(bucket_pos) OVER ({part}) AS pos_all", f"sum(bucket_neg) OVER ({part}) AS neg_all",
        f"lead(head) OVER ({part} ORDER BY _bucket DESC) AS next_head",
    )
    # Without groups the offsets have at most one row per bucket, a number fixed by the
    # settings, and are broadcast. With groups the planner decides by their size; a
    # shuffled join then has the partitioning the window needs. A left join infers no
    # filter on its left side, so both sides reuse one shuffle of the counts.
    joined = counts.join(offsets if by else F.broadcast(offsets), keys, "left")
    inside = f"PARTITION BY {', '.join(keys)} ORDER BY score DESC"
    upto = f"OVER ({inside} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return joined.select(
        *[F.col("_g")[c].alias(c) for c in by],
        *map(F.expr, (
            "score", "pos", "neg",
            f"pos_before + sum(pos) {upto} AS pos_upto", f"neg_before + sum(neg) {upto} AS neg_upto",
            "pos_all", "neg_all",
            f"coalesce(lead(pos) OVER ({inside}), next_head.pos) AS pos_next",
            f"coalesce(lead(neg) OVER ({inside}), next_head.neg) AS neg_next",
            f"pos_before + neg_before = 0 AND row_number() OVER ({inside}) = 1 AS first",
        )),
    )


def _key_place(rows: DataFrame) -> Column:
    """A number that never falls as ``key`` grows, whatever its type; equal for keys that share six bytes."""
    kind = rows.schema["key"].dataType
    if isinstance(kind, (T.NumericType, T.TimestampType)):
        return F.col("key").cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date("key").cast("double")
    head = F.rpad(F.hex(F.substring(F.col("key").cast("string").cast("binary"), 1, 6)), 12, "0")
    return F.conv(head, 16, 10).cast("double")


def ranked_rows(
    df: DataFrame, score: str, key: str, label: str, buckets: int | None = None
) -> DataFrame:
    """Every row with its rank by ``(score desc, key asc)`` and the positives so far.

    Columns: ``key, score, label, rank`` (1-based), ``pos_upto, rows_all, pos_all``.
    A score frequent enough to fill a bucket gets one of its own, divided by key
    ranges, so no window task holds more than a bucket's share of the rows.
    """
    buckets = buckets or _bucket_count(df)
    rows = df.select(
        F.col(key).alias("key"), F.col(score).cast("double").alias("score"), F.col(label).cast("int").alias("label")
    ).where(F.col("score").isNotNull() & ~F.isnan("score"))
    points = _split_points(rows, F.col("score"), buckets)
    hot = sorted({p for i, p in enumerate(points) if i and points[i - 1] == p})
    edges = set(points) | {math.nextafter(h, math.inf) for h in hot}
    bucketed = _bucketize(rows, "score", "_bucket", edges)
    if hot:
        is_hot = F.col("score").isin(hot)
        # A hot score gets as many key ranges as it fills buckets: ranges add up to the buckets.
        filled = {h: points.count(h) + 1 for h in hot}
        most = max(filled.values())
        place = _key_place(rows)
        key_points = _split_points(rows.where(is_hot), place, most)
        keyed = bucketed.withColumn("_key", F.coalesce(place, F.lit(-math.inf)))
        bucketed = _bucketize(keyed, "_key", "_range", key_points).drop("_key")
        share = df.sparkSession.createDataFrame([(h, n / most) for h, n in filled.items()], "_hot double, _share double")
        bucketed = bucketed.join(F.broadcast(share), F.col("score") == F.col("_hot"), "left").withColumn(
            "_range", F.coalesce(F.floor(F.col("_range") * F.col("_share")), F.lit(0)).cast("int")
        ).drop("_hot", "_share")
    else:
        bucketed = bucketed.withColumn("_range", F.lit(0))
    totals = bucketed.groupBy("_bucket", "_range").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("p")
    )
    everything = Window.partitionBy(F.lit(0))
    before = everything.orderBy(F.col("_bucket").desc(), "_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_bucket", "_range",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("p").over(before), F.lit(0)).alias("p_before"),
        F.sum("n").over(everything).alias("rows_all"),
        F.sum("p").over(everything).alias("pos_all"),
    )
    # At most about twice as many rows as buckets.
    joined = bucketed.join(F.broadcast(offsets), ["_bucket", "_range"])
    inside = Window.partitionBy("_bucket", "_range").orderBy(F.col("score").desc(), F.col("key").asc())
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return joined.select(
        "key", "score", "label",
        (F.col("n_before") + F.row_number().over(inside)).alias("rank"),
        (F.col("p_before") + F.sum("label").over(upto)).alias("pos_upto"),
        "rows_all", "pos_all",
    )
