"""Plain SQL that answers the registered queries on another engine.

Each statement repeats the whole computation over the base tables, fitted values
included, so it shares nothing with the Spark code but the definition.
"""

from __future__ import annotations

from tidemark.functions.scalars import portable_hash_sql

TX = """
tx AS (
  SELECT event_id AS TransactionID,
    CAST(floor(epoch(ts)) AS BIGINT) - 1704067200 AS TransactionDT,
    CAST(value AS DOUBLE) AS TransactionAmt,
    CASE WHEN (event_id * 7919 + user_id * 104729) % 1000 <
      (CASE WHEN event_type = 'error' THEN 70 WHEN value > 100 THEN 60 ELSE 20 END)
      THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS isFraud,
    event_type AS ProductCD,
    CAST(user_id AS DOUBLE) AS card1,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(user_id % 40 AS DOUBLE) END AS addr1,
    CASE WHEN event_id % 10 = 0 THEN NULL ELSE 'dom' || CAST(user_id % 12 AS VARCHAR) || '.com' END AS P_emaildomain,
    CASE WHEN event_id % 100 < 85 THEN NULL ELSE 'dom' || CAST(user_id % 5 AS VARCHAR) || '.com' END AS R_emaildomain,
    CASE WHEN event_id % 3 = 0 THEN 'T' WHEN event_id % 3 = 1 THEN 'F' END AS M1,
    CASE WHEN event_id % 4 < 3 THEN 'M' || CAST(event_id % 4 AS VARCHAR) END AS M4,
    CASE WHEN event_id % 100 >= 15 THEN NULL ELSE value END AS mostly_missing,
    CASE WHEN event_id % 100 < 15 THEN NULL ELSE value END AS rarely_missing
  FROM events
)"""

IDN = """
idn AS (
  SELECT o_orderkey * 4 AS TransactionID, o_totalprice AS id_02, o_orderpriority AS DeviceType, o_orderstatus AS DeviceInfo
  FROM orders
)"""

MERGED = TX + "," + IDN + """,
merged AS (
  SELECT tx.*, idn.id_02, idn.DeviceType, idn.DeviceInfo
  FROM tx LEFT JOIN idn ON tx.TransactionID = idn.TransactionID
)"""

SCORED = TX + """,
scored AS (
  SELECT TransactionID, TransactionDT, isFraud AS y,
    round(CAST(0.6 AS DOUBLE) * (CASE WHEN ProductCD = 'error' THEN 1 ELSE 0 END)
      + CAST(0.4 AS DOUBLE) * least(TransactionAmt, CAST(200.0 AS DOUBLE)) / CAST(200.0 AS DOUBLE), 4) AS score
  FROM tx
)"""


def split_of(table: str) -> str:
    """CTE ``sp``: rows of ``table`` with their time-ordered split."""
    one, test, val = (f"CAST({v} AS DOUBLE)" for v in ("1", "0.2", "0.15"))
    return f""",
numbered AS (
  SELECT *, row_number() OVER (ORDER BY TransactionDT, TransactionID) - 1 AS place, count(*) OVER () AS n_all FROM {table}
),
sp AS (
  SELECT * EXCLUDE (place, n_all),
    CASE WHEN place < CAST(floor(n_all * ({one} - {test} - {val})) AS BIGINT) THEN 'train'
         WHEN place < CAST(floor(n_all * ({one} - {test})) AS BIGINT) THEN 'val' ELSE 'test' END AS split
  FROM numbered
),
train AS (SELECT * FROM sp WHERE split = 'train')"""


# Running counts per distinct score, optionally per group.
def ladder(by: str = "", source: str = "scored") -> str:
    part = f"PARTITION BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f""",
per_score AS (
  SELECT {lead}score, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg
  FROM {source} GROUP BY {lead}score
),
ladder AS (
  SELECT *, sum(pos) OVER (w ROWS UNBOUNDED PRECEDING) AS pos_upto, sum(neg) OVER (w ROWS UNBOUNDED PRECEDING) AS neg_upto,
    sum(pos) OVER ({part}) AS pos_all, sum(neg) OVER ({part}) AS neg_all,
    lead(pos) OVER w AS pos_next, lead(neg) OVER w AS neg_next, row_number() OVER w AS rung
  FROM per_score WINDOW w AS ({part} ORDER BY score DESC)
)"""


RANKING = """
  sum(pos * (neg_all - neg_upto) + 0.5 * pos * neg) / max(pos_all * neg_all) AS auroc,
  sum(pos * pos_upto / (pos_upto + neg_upto)) / max(pos_all) AS ap,
  max(pos_all) / max(pos_all + neg_all) AS ap_random"""

CONFUSION = """
confusion AS (
  SELECT CAST(sum(CASE WHEN score < 0.3 AND y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
    CAST(sum(CASE WHEN score >= 0.3 AND y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
    CAST(sum(CASE WHEN score < 0.3 AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
    CAST(sum(CASE WHEN score >= 0.3 AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp
  FROM scored
)"""

PRF = """round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1"""

HOUR = "CAST(floor((((TransactionDT % 86400) + 86400) % 86400) / 3600) AS BIGINT)"
DOW = "CAST(((CAST(floor(TransactionDT / 86400) AS BIGINT) % 7) + 7) % 7 AS BIGINT)"
BAND = """CASE WHEN TransactionAmt < 0 THEN NULL WHEN TransactionAmt <= 10 THEN 0 WHEN TransactionAmt <= 50 THEN 1
  WHEN TransactionAmt <= 200 THEN 2 WHEN TransactionAmt <= 1000 THEN 3 ELSE 4 END"""
TIME_IN = "(TransactionDT - b.lo) / greatest(CAST(b.hi - b.lo AS DOUBLE), CAST(1.0 AS DOUBLE))"

MERGED_COLUMNS = (
    "TransactionID", "TransactionDT", "TransactionAmt", "isFraud", "ProductCD", "card1", "addr1", "P_emaildomain",
    "R_emaildomain", "M1", "M4", "mostly_missing", "rarely_missing", "id_02", "DeviceType", "DeviceInfo",
)
FEATURE_INPUTS = tuple(c for c in MERGED_COLUMNS if c not in ("TransactionID", "isFraud"))
FAMILY = {"card1": "card", "addr1": "addr", "M1": "M", "M4": "M", "id_02": "id"}


def _missing_rows(columns=MERGED_COLUMNS, source: str = "merged") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{FAMILY.get(c, 'other')}' AS family, "
        f"CAST(count(*) - count({c}) AS BIGINT) AS n_missing, (count(*) - count({c})) / count(*) AS missing_rate FROM {source}"
        for c in columns
    )


MISSING = MERGED + ", profile AS (" + _missing_rows() + ")"

ENCODING = """,
bounds AS (SELECT min(TransactionDT) AS lo, max(TransactionDT) AS hi, avg(isFraud) AS prior FROM train),
risk AS (
  SELECT P_emaildomain AS domain, (sum(isFraud) + 10.0 * (SELECT prior FROM bounds)) / (count(*) + 10.0) AS rate
  FROM train WHERE P_emaildomain IS NOT NULL GROUP BY 1
)"""


def code(column: str) -> str:
    return f"""(SELECT {column} AS cat, row_number() OVER (ORDER BY {column}) - 1 AS code
      FROM (SELECT DISTINCT {column} FROM train WHERE {column} IS NOT NULL))"""


FEATURES = (
    "WITH " + MERGED + split_of("merged") + ENCODING + f"""
SELECT TransactionID, isFraud, split,
  round(coalesce(TransactionAmt, (SELECT median(TransactionAmt) FROM train)), 6) AS TransactionAmt,
  CAST(coalesce(p.code, -1) AS BIGINT) AS ProductCD,
  round(coalesce(card1, (SELECT median(card1) FROM train)), 6) AS card1,
  round(coalesce(addr1, (SELECT median(addr1) FROM train)), 6) AS addr1,
  CAST(CASE M1 WHEN 'T' THEN 1 WHEN 'F' THEN 0 ELSE -1 END AS BIGINT) AS M1,
  CAST(coalesce(m.code, -1) AS BIGINT) AS M4,
  round(coalesce(rarely_missing, (SELECT median(rarely_missing) FROM train)), 6) AS rarely_missing,
  CAST({HOUR} AS DOUBLE) AS hour_of_day, CAST({DOW} AS DOUBLE) AS day_of_week,
  CAST(CASE WHEN {DOW} >= 5 THEN 1 ELSE 0 END AS DOUBLE) AS is_weekend,
  round({TIME_IN}, 6) AS time_in_dataset, round(ln(1 + TransactionAmt), 6) AS amt_log,
  CAST({BAND} AS DOUBLE) AS amt_bin, round(coalesce(risk.rate, b.prior), 6) AS P_emaildomain_risk
FROM sp CROSS JOIN bounds b LEFT JOIN risk ON sp.P_emaildomain = risk.domain
  LEFT JOIN {code("ProductCD")} p ON sp.ProductCD = p.cat LEFT JOIN {code("M4")} m ON sp.M4 = m.cat"""
)


def _quantiles(column: str, probs) -> str:
    names = {0.995: "p99_5"}
    return ", ".join(f"round(quantile_cont({column}, {p}), 6) AS {names.get(p, 'p' + format(p * 100, 'g'))}" for p in probs)


def _describe(probs, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return f"""WITH {TX} SELECT {lead}CAST(count(TransactionAmt) AS BIGINT) AS n, round(avg(TransactionAmt), 6) AS mean,
  round(stddev_samp(TransactionAmt), 6) AS std, round(min(TransactionAmt), 6) AS min, round(max(TransactionAmt), 6) AS max,
  {_quantiles("TransactionAmt", probs)} FROM tx{group}"""


def _corr(columns, target: str, source: str, top: int) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, covar_pop({c}, {target}) / nullif(stddev_pop({c}) * "
        f"stddev_pop(CASE WHEN {c} IS NOT NULL THEN {target} END), 0) AS r FROM {source}"
        for c in columns
    )
    return f"SELECT feature, round(r, 6) AS r FROM ({rows}) WHERE r IS NOT NULL ORDER BY abs(r) DESC, feature LIMIT {top}"


def _histogram(by: str = "") -> str:
    lead, part = (f"{by}, ", f"PARTITION BY {by}") if by else ("", "")
    return f"""WITH {TX},
ranged AS (
  SELECT {lead}TransactionAmt AS x, min(TransactionAmt) OVER ({part}) AS lo, max(TransactionAmt) OVER ({part}) AS hi,
    count(*) OVER ({part}) AS n FROM tx
)
SELECT {lead}bin, CAST(count(*) AS BIGINT) AS n_rows, round(lo + bin * w, 6) AS "left", round(count(*) / (n * w), 6) AS density
FROM (SELECT *, (hi - lo) / 80 AS w, CAST(least(floor((x - lo) / ((hi - lo) / 80)), 79) AS BIGINT) AS bin FROM ranged)
GROUP BY {lead}bin, lo, w, n"""


def _grid(count: int, step: float) -> str:
    """CTE ``grid`` with the doubles start + i * step."""
    return (
        f", grid AS (SELECT i, CAST(0.01 AS DOUBLE) + i * (CAST(0.01 AS DOUBLE) + CAST({step} AS DOUBLE) - CAST(0.01 AS DOUBLE)) AS t "
        f"FROM range({count}) r(i)), "
        "points AS (SELECT t, CAST(count(*) FILTER (WHERE y = 1 AND score >= t) AS BIGINT) AS tp, "
        "CAST(count(*) FILTER (WHERE y = 0 AND score >= t) AS BIGINT) AS fp, "
        "CAST(count(*) FILTER (WHERE y = 1 AND score < t) AS BIGINT) AS fn, "
        "CAST(count(*) FILTER (WHERE y = 0 AND score < t) AS BIGINT) AS tn FROM grid, scored GROUP BY t), "
        "curve AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision, "
        "CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall, "
        "CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1 FROM points)"
    )


SPOILED = TX + """,
spoiled AS (
  SELECT TransactionID,
    CASE WHEN TransactionID % 41 <> 0 THEN TransactionDT END AS dt,
    CASE WHEN TransactionID % 29 = 0 THEN -TransactionAmt WHEN TransactionID % 31 = 0 THEN TransactionAmt + 2000000
         WHEN TransactionID % 37 <> 0 THEN TransactionAmt END AS amt,
    CASE WHEN TransactionID % 43 = 0 THEN 'yes' ELSE M1 END AS f1,
    CASE WHEN TransactionID % 47 = 0 THEN 'X99' ELSE M4 END AS f4,
    CASE WHEN TransactionID % 53 = 0 THEN 'no' ELSE 'T' END AS f2, TransactionID % 59 = 0 AS misfit
  FROM tx
),
broken AS (
  SELECT TransactionID, 1 AS place, 'TransactionDT' AS field FROM spoiled WHERE dt IS NULL
  UNION ALL SELECT TransactionID, 2, 'TransactionAmt' FROM spoiled WHERE amt IS NULL OR amt <= 0 OR amt > 1000000
  UNION ALL SELECT TransactionID, 3, 'M1' FROM spoiled WHERE f1 NOT IN ('T', 'F')
  UNION ALL SELECT TransactionID, 4, 'M2' FROM spoiled WHERE f2 NOT IN ('T', 'F')
  UNION ALL SELECT TransactionID, 6, 'card1' FROM spoiled WHERE misfit
  UNION ALL SELECT TransactionID, 5, 'M4' FROM spoiled WHERE f4 NOT IN ('M0', 'M1', 'M2')
)"""

BASE = "ln(CAST(0.034 AS DOUBLE) / (1 - CAST(0.034 AS DOUBLE)))"
TERM_LIST = (
    ("TransactionAmt", "TransactionAmt", 40, 100), ("card1", "card1", 75, 90), ("hour_of_day", HOUR, 12, 30),
    ("event_minute", "floor((((TransactionDT % 3600) + 3600) % 3600) / 60)", 30, 70),
)
EXPLAINED = TX + """,
terms AS (
""" + " UNION ALL ".join(
    f"SELECT TransactionID, isFraud AS y, {i} AS idx, '{name}' AS feature, CAST({sql} AS DOUBLE) AS value, "
    f"(CAST({sql} AS DOUBLE) - {centre}) / CAST({scale} AS DOUBLE) AS contribution FROM tx"
    for i, (name, sql, centre, scale) in enumerate(TERM_LIST)
) + f"""
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY TransactionID ORDER BY abs(contribution) DESC, idx) AS rank FROM terms),
totals AS (
  SELECT TransactionID, max(y) AS y, {BASE} + sum(contribution) AS odds, sum(contribution) AS all_terms,
    sum(CASE WHEN rank <= 3 THEN contribution ELSE 0 END) AS named, sum(CASE WHEN rank <= 2 THEN contribution ELSE 0 END) AS two
  FROM ranked GROUP BY TransactionID
)"""

_TX_ALL = (
    "TransactionID, TransactionDT, round(TransactionAmt, 6) AS TransactionAmt, isFraud, ProductCD, card1, addr1, "
    "P_emaildomain, R_emaildomain, M1, M4, mostly_missing, rarely_missing"
)
_MERGED_ALL = _TX_ALL + ", id_02, DeviceType, DeviceInfo"
_PATH = {2: "1.0"}
_PATH.update({n: f"(2 * (ln({n - 1}) + 0.5772156649015329) - 2 * CAST({n - 1} AS DOUBLE) / {n})" for n in (5, 6, 8)})

ORACLES: dict[str, str] = {
    # sources and sinks
    "read_csv_na": f"WITH {TX} SELECT {_TX_ALL} FROM tx",
    "merged_roundtrip": f"WITH {MERGED} SELECT {_MERGED_ALL} FROM merged",
    "feature_table": FEATURES,
    "state_roundtrip": FEATURES,
    "read_split": f"WITH {TX}{split_of('tx')} SELECT TransactionID, TransactionDT, isFraud, split FROM sp WHERE split = 'val'",
    "column_names": f'WITH {MISSING} SELECT "column", n_missing FROM profile',
    "append_score": f"WITH {SCORED} SELECT TransactionID, y AS isFraud, round(score, 6) AS anomaly_score FROM scored",
    "read_records": f"WITH {TX} SELECT TransactionID, TransactionDT, round(TransactionAmt, 6) AS TransactionAmt, M4, addr1 FROM tx",
    # validation
    "dup_key_count": "SELECT CAST(sum(n - 1) AS BIGINT) AS n_duplicates FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)",
    "dup_after_join": "SELECT CAST(sum(n - 1) AS BIGINT) AS n_duplicates FROM (SELECT o_orderkey, count(*) AS n "
    "FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey)",
    "label_domain": "SELECT CAST(p_size AS BIGINT) AS value, CAST(count(*) AS BIGINT) AS n_rows FROM part "
    "WHERE p_size IS NOT NULL AND p_size NOT IN (0, 1) GROUP BY p_size",
    "rate_check": f"WITH {TX} SELECT round(avg(isFraud), 6) AS rate, "
    "CASE WHEN avg(isFraud) BETWEEN 0.02 AND 0.06 THEN 'ok' ELSE 'warn' END AS severity FROM tx",
    "table_diagnostics": f"WITH {MERGED} SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST({len(MERGED_COLUMNS)} AS BIGINT) AS n_columns, "
    "CAST(sum(isFraud) AS BIGINT) AS n_positive, round(avg(isFraud), 6) AS rate, min(TransactionDT) AS dt_min, "
    "max(TransactionDT) AS dt_max FROM merged",
    "high_missing_count": f"WITH {MISSING} SELECT CAST(count(*) FILTER (WHERE missing_rate > 0.5) AS BIGINT) AS n_columns FROM profile",
    "row_rules": f"WITH {SPOILED} SELECT TransactionID, field FROM broken",
    "quarantine": f"WITH {SPOILED} SELECT t.TransactionID, CASE WHEN count(b.field) = 0 THEN 'valid' ELSE 'quarantine' END AS part, "
    "coalesce(string_agg(b.field, ',' ORDER BY b.place), '') AS errors FROM spoiled t "
    "LEFT JOIN broken b ON t.TransactionID = b.TransactionID GROUP BY t.TransactionID",
    "align_columns": f"WITH {TX} SELECT TransactionID, TransactionDT, card1, CAST(NULL AS DOUBLE) AS dist1, CAST(NULL AS VARCHAR) AS M9 FROM tx",
    "align_features": f'WITH {TX} SELECT TransactionID, card1, CAST(2.5 AS DOUBLE) AS "V1", round(TransactionAmt, 6) AS amount FROM tx',
    "any_missing": f"WITH {MISSING} SELECT CAST(sum(n_missing) AS BIGINT) AS n_missing FROM profile",
    "low_variance": "SELECT \"column\", round(std, 6) AS std FROM ("
    "SELECT 'l_quantity' AS \"column\", stddev_samp(l_quantity) AS std FROM lineitem "
    "UNION ALL SELECT 'l_discount', stddev_samp(l_discount) FROM lineitem "
    "UNION ALL SELECT 'tax_tenth', stddev_samp(l_tax / 10) FROM lineitem "
    "UNION ALL SELECT 'constant', stddev_samp(CAST(3.0 AS DOUBLE)) FROM lineitem "
    "UNION ALL SELECT 'price_tiny', stddev_samp(l_extendedprice / CAST(1e9 AS DOUBLE)) FROM lineitem) WHERE std < 0.01",
    # columns and profiles
    "column_families": f"WITH {MISSING} SELECT family, CAST(count(*) AS BIGINT) AS n_columns, "
    "CAST(sum((SELECT count(*) FROM merged) - n_missing) AS BIGINT) AS n_values FROM profile GROUP BY family",
    "missing_profile": f'WITH {MISSING} SELECT "column", n_missing, round(missing_rate, 6) AS missing_rate FROM profile',
    "most_missing": f'WITH {MISSING} SELECT "column", n_missing, round(missing_rate, 6) AS missing_rate FROM profile ORDER BY missing_rate DESC, "column" LIMIT 5',
    "missing_by_family": f"WITH {MISSING} SELECT family, round(min(missing_rate), 6) AS rate_min, round(max(missing_rate), 6) AS rate_max, "
    "CAST(count(*) FILTER (WHERE missing_rate > 0.7) AS BIGINT) AS n_above_cut FROM profile GROUP BY family",
    "missing_summary": f"WITH {MISSING} SELECT CAST(count(*) FILTER (WHERE missing_rate = 0) AS BIGINT) AS n_complete, "
    "CAST(count(*) FILTER (WHERE missing_rate > 0) AS BIGINT) AS n_with_missing, "
    "CAST(count(*) FILTER (WHERE missing_rate <= 0.7) AS BIGINT) AS n_surviving, CAST(count(*) AS BIGINT) AS n_columns FROM profile",
    "missing_bands": f"WITH {MISSING} SELECT CASE WHEN missing_rate <= 0.2 THEN '0-20%' WHEN missing_rate <= 0.5 THEN '20-50%' "
    "WHEN missing_rate <= 0.7 THEN '50-70%' ELSE '70-100%' END AS band, CAST(count(*) AS BIGINT) AS n_columns "
    "FROM profile WHERE missing_rate > 0 GROUP BY 1",
    "missing_rate_histogram": f"WITH {MISSING}, b AS (SELECT CAST(least(floor(missing_rate / CAST(0.02 AS DOUBLE)), 49) AS BIGINT) AS bin "
    "FROM profile WHERE missing_rate > 0) SELECT bin, CAST(count(*) AS BIGINT) AS n_rows, round(bin * CAST(0.02 AS DOUBLE), 6) AS \"left\", "
    "round(count(*) / ((SELECT count(*) FROM b) * CAST(0.02 AS DOUBLE)), 6) AS density FROM b GROUP BY bin",
    "class_distribution": f"WITH {TX}, c AS (SELECT isFraud AS label, count(*) AS n FROM tx GROUP BY 1) SELECT label, CAST(n AS BIGINT) AS n_rows, "
    "round(n / (SELECT sum(n) FROM c), 6) AS share, round((SELECT n FROM c WHERE label = 0) / (SELECT n FROM c WHERE label = 1), 6) AS imbalance FROM c",
    "email_rates": f"WITH {TX} SELECT P_emaildomain AS category, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(isFraud) AS BIGINT) AS n_positive, "
    "round(avg(isFraud), 6) AS rate FROM tx WHERE P_emaildomain IS NOT NULL GROUP BY 1",
    "category_rate": f"WITH {TX} SELECT P_emaildomain AS category, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(isFraud) AS BIGINT) AS n_positive, "
    "round(avg(isFraud), 6) AS rate FROM tx WHERE P_emaildomain IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 8",
    "value_counts": f"WITH {MERGED} " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS value, CAST(count(*) AS BIGINT) AS n_rows FROM merged WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in ("ProductCD", "DeviceType", "DeviceInfo", "M1", "M4")
    ),
    "label_corr": f"WITH {MERGED} " + _corr(("TransactionAmt", "card1", "addr1", "mostly_missing", "rarely_missing", "id_02"), "isFraud", "merged", 30),
    "score_corr": f"WITH {SCORED}, j AS (SELECT tx.*, scored.score FROM tx JOIN scored USING (TransactionID)) "
    + _corr(("TransactionAmt", "card1", "addr1", "rarely_missing", "mostly_missing", "TransactionDT"), "score", "j", 20),
    "amount_by_class": _describe((0.25, 0.5, 0.75), "isFraud"),
    "amount_percentiles": _describe((0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 0.995)),
    "weekly_rate": f"WITH {TX} SELECT CAST(floor(TransactionDT / 604800) AS BIGINT) AS week, round(avg(isFraud), 6) AS rate, "
    "CAST(count(*) AS BIGINT) AS n_rows FROM tx GROUP BY 1",
    "cardinality": f"WITH {MERGED} " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct, round((count(*) - count({c})) / count(*), 6) AS missing_rate FROM merged"
        for c in ("ProductCD", "P_emaildomain", "R_emaildomain", "M1", "M4", "DeviceType", "DeviceInfo")
    ),
    "distinct_values": f"WITH {TX} " + " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS \"column\", {c} AS value FROM tx WHERE {c} IS NOT NULL" for c in ("M1", "M4", "ProductCD")
    ),
    "time_span": f"WITH {TX} SELECT min(TransactionDT) AS dt_min, max(TransactionDT) AS dt_max, "
    "round((max(TransactionDT) - min(TransactionDT)) / CAST(86400 AS DOUBLE), 6) AS span_days FROM tx",
    "family_stats": f"WITH {MERGED} " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round((count(*) - count({c})) / count(*), 6) AS missing_rate, round(avg({c}), 6) AS mean FROM merged"
        for c in ("card1", "addr1", "id_02", "mostly_missing", "rarely_missing")
    ),
    "histogram": _histogram("isFraud"),
    "amount_histogram": _histogram(),
    # joins
    "merge_identity": f"WITH {MERGED} SELECT {_MERGED_ALL} FROM merged",
    "identity_coverage": f"WITH {TX},{IDN} SELECT CAST(count(i.k) AS BIGINT) AS n_matched, CAST(count(*) AS BIGINT) AS n_rows, "
    "round(100.0 * count(i.k) / count(*), 6) AS pct_matched FROM tx LEFT JOIN (SELECT TransactionID AS k FROM idn) i ON tx.TransactionID = i.k",
    "label_coverage": "SELECT CAST(count(l.k) AS BIGINT) AS n_matched, CAST(count(*) AS BIGINT) AS n_rows, "
    "round(100.0 * count(l.k) / count(*), 6) AS pct_matched FROM documents d LEFT JOIN (SELECT doc_id AS k FROM labels) l ON d.doc_id = l.k",
    # scalars
    "time_features": f"WITH {TX}{split_of('tx')}{ENCODING} SELECT TransactionID, {HOUR} AS hour_of_day, {DOW} AS day_of_week, "
    f"CAST(CASE WHEN {DOW} >= 5 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend, round({TIME_IN}, 6) AS time_in_dataset FROM sp CROSS JOIN bounds b",
    "amount_features": f"WITH {TX} SELECT TransactionID, round(TransactionAmt, 6) AS TransactionAmt, round(ln(1 + TransactionAmt), 6) AS amt_log, "
    f"CAST({BAND} AS BIGINT) AS amt_bin FROM tx",
    "match_flags": f"WITH {TX} SELECT TransactionID, CAST(CASE M1 WHEN 'T' THEN 1 WHEN 'F' THEN 0 ELSE -1 END AS BIGINT) AS M1 FROM tx",
    "decide": f"WITH {SCORED} SELECT TransactionID, CAST(CASE WHEN score >= 0.3 THEN 1 ELSE 0 END AS BIGINT) AS is_flagged FROM scored",
    "logit": f"WITH {SCORED} SELECT TransactionID, round(CASE WHEN score > 0 AND score < 1 THEN ln(score / (1 - score)) ELSE {BASE} END, 6) AS log_odds FROM scored",
    "risk_band": f"WITH {SCORED} SELECT CASE WHEN score * 100 < 30 THEN 'low' WHEN score * 100 < 60 THEN 'mid' ELSE 'high' END AS band, "
    "CAST(count(*) AS BIGINT) AS n_rows FROM scored GROUP BY 1",
    "row_weights": f"WITH {TX}, w AS (SELECT sum(1 - isFraud) / greatest(sum(isFraud), 1) AS weight FROM tx) "
    "SELECT TransactionID, isFraud, round(CASE WHEN isFraud = 1 THEN w.weight ELSE CAST(1 AS DOUBLE) END, 6) AS weight FROM tx CROSS JOIN w",
    "pos_weight": f"WITH {TX} SELECT CAST(sum(isFraud) AS BIGINT) AS n_positive, CAST(sum(1 - isFraud) AS BIGINT) AS n_negative, "
    "round(sum(1 - isFraud) / greatest(sum(isFraud), 1), 6) AS weight FROM tx",
    # splits and samples
    "temporal_split": f"WITH {TX}{split_of('tx')} SELECT TransactionID, TransactionDT, split FROM sp",
    "split_summary": f"WITH {TX}{split_of('tx')} SELECT split, CAST(count(*) AS BIGINT) AS n_rows, round(count(*) / (SELECT count(*) FROM tx), 6) AS share, "
    "round(avg(isFraud), 6) AS rate, min(TransactionDT) AS dt_min, max(TransactionDT) AS dt_max FROM sp GROUP BY split",
    "split_disjoint": f"WITH {TX}{split_of('tx')} SELECT CAST(count(*) AS BIGINT) AS n_overlapping FROM "
    "(SELECT TransactionID FROM sp GROUP BY TransactionID HAVING count(DISTINCT split) > 1)",
    "stratified_sample": f"WITH {TX}, h AS (SELECT TransactionID, isFraud, row_number() OVER (PARTITION BY isFraud ORDER BY "
    f"{portable_hash_sql('TransactionID', 42)}, TransactionID) AS place, count(*) OVER (PARTITION BY isFraud) AS n FROM tx) "
    "SELECT TransactionID, isFraud FROM h WHERE place <= greatest(1, CAST(floor(n * CAST(0.3 AS DOUBLE)) AS BIGINT))",
    "explain_sample": f"WITH {TX} SELECT TransactionID, round(TransactionAmt, 6) AS TransactionAmt FROM tx "
    f"ORDER BY {portable_hash_sql('TransactionID', 42)}, TransactionID LIMIT 5000",
    # learned transforms
    "drop_missing": f"WITH {MERGED}{split_of('merged')} SELECT {', '.join(c for c in MERGED_COLUMNS if c not in ('R_emaildomain', 'mostly_missing', 'id_02', 'DeviceType', 'DeviceInfo'))}, split FROM sp",
    "email_risk": f"WITH {TX}{split_of('tx')}{ENCODING}, rrisk AS (SELECT R_emaildomain AS domain, (sum(isFraud) + 10.0 * (SELECT prior FROM bounds)) / (count(*) + 10.0) AS rate "
    "FROM train WHERE R_emaildomain IS NOT NULL GROUP BY 1) SELECT TransactionID, isFraud, round(coalesce(risk.rate, b.prior), 6) AS P_emaildomain_risk, "
    "round(coalesce(rrisk.rate, b.prior), 6) AS R_emaildomain_risk FROM sp CROSS JOIN bounds b LEFT JOIN risk ON P_emaildomain = risk.domain "
    "LEFT JOIN rrisk ON R_emaildomain = rrisk.domain",
    "ordinal_encode": f"WITH {MERGED}{split_of('merged')} SELECT TransactionID, CAST(coalesce(p.code, -1) AS BIGINT) AS ProductCD, "
    "CAST(coalesce(m.code, -1) AS BIGINT) AS M4, CAST(coalesce(d.code, -1) AS BIGINT) AS DeviceType FROM sp "
    f"LEFT JOIN {code('ProductCD')} p ON sp.ProductCD = p.cat LEFT JOIN {code('M4')} m ON sp.M4 = m.cat LEFT JOIN {code('DeviceType')} d ON sp.DeviceType = d.cat",
    "impute_median": f"WITH {TX}{split_of('tx')} SELECT TransactionID, " + ", ".join(
        f"round(coalesce({c}, (SELECT median({c}) FROM train)), 6) AS {c}" for c in ("addr1", "card1", "mostly_missing", "rarely_missing")
    ) + " FROM sp",
    "median_table": f"WITH {MERGED}{split_of('merged')} " + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST(count({c}) AS BIGINT) AS n, round(median({c}), 6) AS value FROM train"
        for c in ("TransactionAmt", "card1", "addr1", "mostly_missing", "rarely_missing", "id_02")
    ),
    "pipeline_summary": f"WITH {MERGED}{split_of('merged')}, profile AS ({_missing_rows(FEATURE_INPUTS, 'train')}) "
    "SELECT 'missing' AS step, 'columns_dropped' AS metric, CAST(count(*) AS BIGINT) AS value FROM profile WHERE missing_rate > 0.7 "
    "UNION ALL SELECT step, metric, CAST(value AS BIGINT) AS value FROM (VALUES ('time', 'columns_added', 4), "
    "('amount', 'columns_added', 2), ('rates', 'columns_encoded', 1), ('encode', 'binary_flags', 1), ('encode', 'tri_flag_present', 1), "
    "('encode', 'categorical', 1), ('encode', 'numeric_imputed', 11), ('encode', 'features_out', 14)) t(step, metric, value)",
    # curves and metrics
    "gain_curve": f"WITH {SCORED} SELECT TransactionID AS key, CAST(row_number() OVER w AS BIGINT) AS rank, "
    "round(row_number() OVER w / count(*) OVER (), 6) AS share_flagged, "
    "round(sum(y) OVER (w ROWS UNBOUNDED PRECEDING) / greatest(sum(y) OVER (), 1), 6) AS capture "
    "FROM scored WINDOW w AS (ORDER BY score DESC, TransactionID)",
    "gain_marks": f"WITH {SCORED}, g AS (SELECT row_number() OVER w AS rank, count(*) OVER () AS n, "
    "sum(y) OVER (w ROWS UNBOUNDED PRECEDING) / greatest(sum(y) OVER (), 1) AS capture FROM scored WINDOW w AS (ORDER BY score DESC, TransactionID)) "
    "SELECT CAST(pct AS BIGINT) AS pct, CAST(rank AS BIGINT) AS rank, round(rank / n, 6) AS share_flagged, round(capture, 6) AS capture "
    "FROM g JOIN (VALUES (1), (2), (5), (10)) p(pct) ON rank = greatest(CAST(floor(n * pct / 100) AS BIGINT), 1)",
    "roc_curve": f"WITH {SCORED}{ladder()} SELECT round(score, 6) AS threshold, round(neg_upto / neg_all, 6) AS fpr, round(pos_upto / pos_all, 6) AS tpr "
    "FROM ladder WHERE rung = 1 OR pos_next IS NULL OR pos_next <> pos OR neg_next <> neg UNION ALL SELECT NULL, 0, 0",
    "pr_curve": f"WITH {SCORED}{ladder()} SELECT round(score, 6) AS threshold, round(pos_upto / (pos_upto + neg_upto), 6) AS precision, "
    "round(pos_upto / pos_all, 6) AS recall FROM ladder UNION ALL SELECT NULL, 1, 0",
    "auroc": f"WITH {SCORED}{ladder()}, m AS (SELECT {RANKING} FROM ladder) SELECT round(auroc, 6) AS auroc FROM m",
    "average_precision": f"WITH {SCORED}{ladder()}, m AS (SELECT {RANKING} FROM ladder) SELECT round(ap, 6) AS ap, round(ap_random, 6) AS ap_random FROM m",
    "confusion": f"WITH {SCORED},{CONFUSION} SELECT tn, fp, fn, tp FROM confusion",
    "prf": f"WITH {SCORED},{CONFUSION} SELECT {PRF} FROM confusion",
    "confusion_rates": f"WITH {SCORED},{CONFUSION} SELECT tn, fp, fn, tp, round(tp / (tp + fn), 6) AS tpr, round(fn / (tp + fn), 6) AS fnr, "
    "round(fp / (tn + fp), 6) AS fpr, round(tn / (tn + fp), 6) AS tnr, round(fp / (tp + fp), 6) AS fdr FROM confusion",
    "review_queue": f"WITH {SCORED},{CONFUSION} SELECT tn + fp + fn + tp AS n_rows, tp + fn AS n_positive, tp + fp AS n_flagged, "
    "round(100 * (tp + fp) / (tn + fp + fn + tp), 6) AS pct_flagged, tp AS n_caught, fn AS n_missed, fp AS n_wrongly_flagged FROM confusion",
    "operating_point": f"WITH {SCORED},{CONFUSION} SELECT CAST(0.3 AS DOUBLE) AS threshold, round(fp / (tn + fp), 6) AS fpr, round(tp / (tp + fn), 6) AS tpr, {PRF} FROM confusion",
    "metrics_by_split": f"WITH {SCORED}{split_of('scored')}{ladder('split', 'sp')}, r AS (SELECT split, {RANKING}, "
    "sum(CASE WHEN score >= 0.3 THEN pos ELSE 0 END) AS tp, sum(CASE WHEN score >= 0.3 THEN neg ELSE 0 END) AS fp, "
    "sum(CASE WHEN score < 0.3 THEN pos ELSE 0 END) AS fn, sum(CASE WHEN score < 0.3 THEN neg ELSE 0 END) AS tn FROM ladder GROUP BY split) "
    f"SELECT split, round(auroc, 6) AS auroc, round(ap, 6) AS ap, {PRF}, CAST(0.3 AS DOUBLE) AS threshold, CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, "
    "CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp, CAST(0.5 AS DOUBLE) AS auroc_random, round(ap_random, 6) AS ap_random FROM r",
    "best_so_far": f"WITH {SCORED}{_grid(95, 0.01)} SELECT CAST(round(t * 100) AS BIGINT) AS trial, round(f1, 6) AS value, "
    "round(max(f1) OVER (ORDER BY t ROWS UNBOUNDED PRECEDING), 6) AS best FROM curve",
    "threshold_curve": f"WITH {SCORED}{_grid(190, 0.005)} SELECT round(t, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, "
    "round(f1, 6) AS f1, tp, fp, fn, tn FROM curve",
    "best_threshold": f"WITH {SCORED}{_grid(95, 0.01)} SELECT round(t, 2) AS threshold, round(f1, 6) AS f1 FROM curve ORDER BY curve.f1 DESC, t LIMIT 1",
    "true_positives": f"WITH {SCORED} SELECT TransactionID, round(score, 6) AS score FROM scored WHERE score >= 0.3 AND y = 1 ORDER BY score DESC, TransactionID LIMIT 5",
    "score_range": f"WITH {SCORED}{split_of('scored')} SELECT split, round(min(score), 6) AS score_min, round(max(score), 6) AS score_max FROM sp GROUP BY split",
    "score_stats": f"""WITH {SCORED}, s AS (
  SELECT y, avg(score) AS mean, stddev_pop(score) AS std, quantile_cont(score, 0.5) AS median, quantile_cont(score, 0.1) AS p10, quantile_cont(score, 0.9) AS p90
  FROM scored GROUP BY y), p AS (SELECT * FROM s WHERE y = 1), n AS (SELECT * FROM s WHERE y = 0) """
    + " UNION ALL ".join(
        f"SELECT '{c}' AS stat, round(p.{c}, 6) AS positive, round(n.{c}, 6) AS negative, round((p.{c} - n.{c}) / greatest(n.std, 1e-9), 6) AS separation FROM p, n"
        for c in ("mean", "median", "std", "p10", "p90")
    ),
    "decile_lift": f"""WITH {SCORED}, e AS (SELECT DISTINCT unnest(quantile_cont(score, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1])) AS edge FROM scored),
inner_edges AS (SELECT edge FROM e WHERE edge > (SELECT min(edge) FROM e) AND edge < (SELECT max(edge) FROM e)),
binned AS (SELECT s.TransactionID, max(s.y) AS y, count(i.edge) AS bin FROM scored s LEFT JOIN inner_edges i ON i.edge < s.score GROUP BY s.TransactionID),
base AS (SELECT avg(y) AS base FROM scored)
SELECT CAST(bin AS BIGINT) AS bin, CAST(count(*) AS BIGINT) AS n_rows, round(avg(y), 6) AS rate, round(avg(y) / max(base), 6) AS lift,
  CASE WHEN avg(y) > max(base) * 1.5 THEN 'strong' WHEN avg(y) > max(base) THEN 'above' ELSE 'below' END AS band
FROM binned, base GROUP BY bin""",
    # explanations
    "top_factors": f"WITH {EXPLAINED} SELECT TransactionID, CAST(rank AS BIGINT) AS rank, feature, round(contribution, 6) AS shap_value, round(value, 6) AS feature_value, "
    "CASE WHEN contribution > 0 THEN 'increases_risk' ELSE 'decreases_risk' END AS direction FROM ranked WHERE rank <= 3",
    "mean_abs_contrib": f"WITH {EXPLAINED} SELECT feature, round(avg(abs(contribution)), 6) AS mean_abs FROM terms GROUP BY feature",
    "contrib_long": f"WITH {EXPLAINED} SELECT TransactionID, feature, round(contribution, 6) + 0.0 AS contribution, round(value, 6) AS value FROM terms",
    "waterfall_rows": f"""WITH {EXPLAINED}
SELECT TransactionID, CAST(0 AS BIGINT) AS step, 'Base' AS name, round({BASE}, 6) AS value, 'absolute' AS measure FROM totals
UNION ALL SELECT TransactionID, CAST(rank AS BIGINT), feature, round(contribution, 6) + 0.0, 'relative' FROM ranked WHERE rank <= 3
UNION ALL SELECT TransactionID, 4, 'Other features', round(odds - {BASE} - named, 6) + 0.0, 'relative' FROM totals
UNION ALL SELECT TransactionID, 5, 'Prediction', round(odds, 6) + 0.0, 'total' FROM totals""",
    "explain_cases": f"""WITH {EXPLAINED}, cases AS (
  SELECT TransactionID, all_terms, two FROM totals WHERE y = 1 AND 1 / (1 + exp(-odds)) >= 0.02 ORDER BY odds DESC, TransactionID LIMIT 5)
SELECT r.TransactionID, CAST(r.rank AS BIGINT) AS rank, r.feature, round(r.contribution, 6) AS contribution, round(r.value, 6) AS value
FROM ranked r JOIN cases c ON r.TransactionID = c.TransactionID WHERE r.rank <= 2
UNION ALL SELECT TransactionID, 3, 'other', round(all_terms - two, 6) + 0.0, NULL FROM cases""",
    "stump_contrib": f"WITH {TX} SELECT TransactionID, "
    "CAST(CASE WHEN TransactionAmt <= 50 THEN -0.5 ELSE 0.9 END - (-0.5 * 0.7 + 0.9 * 0.3) AS DOUBLE) AS phi_amount, "
    "CAST(CASE WHEN card1 <= 75 THEN 0.2 ELSE -0.3 END - (0.2 * 0.4 - 0.3 * 0.6) AS DOUBLE) AS phi_card1, "
    "round(CAST(-0.5 * 0.7 + 0.9 * 0.3 + 0.2 * 0.4 - 0.3 * 0.6 AS DOUBLE), 6) AS base FROM tx",
    "iforest_score_fixed": f"WITH {TX} SELECT TransactionID, round(pow(2.0, -((CASE WHEN TransactionAmt <= 60 THEN 1 + {_PATH[6]} ELSE 1 + {_PATH[2]} END) + "
    f"(CASE WHEN {HOUR} > 6 THEN 1 + {_PATH[5]} WHEN TransactionAmt <= 100 THEN 2 + {_PATH[2]} ELSE 2 END)) / 2 / {_PATH[8]}), 6) AS isolation FROM tx",
    # streaming
    "stream_weekly_rate": f"WITH {TX} SELECT CAST(floor(TransactionDT / 604800) AS BIGINT) AS week, round(avg(isFraud), 6) AS rate, "
    "CAST(count(*) AS BIGINT) AS n_rows FROM tx GROUP BY 1",
    "stream_dedup": f"WITH {TX} SELECT TransactionID, TransactionDT, round(TransactionAmt, 6) AS TransactionAmt FROM tx",
    "stream_outcomes": f"WITH {TX} SELECT TransactionID, CASE WHEN bad THEN 'quarantine' ELSE 'scored' END AS outcome, "
    "CAST(NOT bad AS BIGINT) AS has_score, CASE WHEN bad THEN 'TransactionAmt' END AS broken FROM (SELECT TransactionID, "
    "TransactionID % 10 = 0 OR TransactionAmt <= 0 OR TransactionAmt > 1000000 AS bad FROM tx)",
    "stream_late_rows": f"WITH {TX}, arrivals AS (SELECT *, FALSE AS again FROM tx UNION ALL SELECT *, TRUE FROM tx WHERE TransactionID % 50 = 0), "
    "judged AS (SELECT CAST(floor(TransactionDT / 604800) AS BIGINT) AS week, isFraud, "
    "again AND (floor(TransactionDT / 604800) + 1) * 604800 <= (SELECT max(TransactionDT) FROM tx) - 86400 AS late FROM arrivals) "
    "SELECT week, round(avg(isFraud) FILTER (NOT late), 6) AS rate, CAST(count(*) FILTER (NOT late) AS BIGINT) AS n_rows, "
    "CAST(count(*) FILTER (late) AS BIGINT) AS n_late FROM judged GROUP BY week",
    "stream_copies": f"WITH {TX} SELECT TransactionID, TransactionDT, round(TransactionAmt, 6) AS TransactionAmt, "
    "CAST(CASE WHEN TransactionID % 3 = 0 THEN 2 ELSE 1 END AS BIGINT) AS n_removed FROM tx",
    # flagship
    "risk_by_split": f"WITH {MERGED}{split_of('merged')}{ENCODING} SELECT split, CAST(count(*) AS BIGINT) AS n_rows, round(avg(isFraud), 6) AS rate, "
    "round(avg(coalesce(risk.rate, b.prior)), 6) AS mean_risk, round(avg(ln(1 + TransactionAmt)), 6) AS mean_amt_log, "
    f"CAST(sum(CASE WHEN {DOW} >= 5 THEN 1 ELSE 0 END) AS BIGINT) AS n_weekend, round(max({TIME_IN}), 6) AS last_time, CAST(count(id_02) AS BIGINT) AS n_with_identity "
    "FROM sp CROSS JOIN bounds b LEFT JOIN risk ON P_emaildomain = risk.domain GROUP BY split",
}


def _flagging(by: str = "") -> str:
    source, lead = ("sp", f"{by}, ") if by else ("scored", "")
    group, using = (f"GROUP BY {by}", f"USING ({by})") if by else ("", "ON TRUE")
    rates = (
        "SELECT *, hits / greatest(p, 1) AS recall, CASE WHEN n_flagged = 0 THEN 0 ELSE hits / n_flagged END AS precision, p / n AS base FROM f"
    )
    return f""",
cuts AS (SELECT {lead}unnest([1, 2, 5, 10, 20]) AS pct, unnest(quantile_cont(score, [0.99, 0.98, 0.95, 0.9, 0.8])) AS threshold FROM {source} {group}),
f AS (
  SELECT {lead}pct, threshold, count(*) FILTER (WHERE score >= threshold) AS n_flagged, count(*) FILTER (WHERE score >= threshold AND y = 1) AS hits,
    count(*) AS n, count(*) FILTER (WHERE y = 1) AS p
  FROM {source} JOIN cuts {using} GROUP BY {lead}pct, threshold
),
rated AS ({rates}),
flagging AS (
  SELECT {lead}CAST(pct AS BIGINT) AS pct, round(threshold, 6) AS threshold, CAST(n_flagged AS BIGINT) AS n_flagged, round(recall, 6) AS recall,
    round(precision, 6) AS precision, round(CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END, 6) AS f1,
    round(precision / greatest(base, 1e-9), 6) AS lift
  FROM rated
)"""


ORACLES["topn_flagging"] = f"WITH {SCORED}{_flagging()} SELECT * FROM flagging"
ORACLES["signal_report"] = (
    f"WITH {SCORED}{split_of('scored')}{ladder('split', 'sp')}{_flagging('split')}, r AS (SELECT split, {RANKING} FROM ladder GROUP BY split) "
    "SELECT flagging.*, round(auroc, 6) AS auroc, round(ap, 6) AS ap FROM flagging JOIN r USING (split)"
)

# Fitted models: what must hold for any of them.
ORACLES.update({
    "iforest_nodes": f"WITH {TX}{split_of('tx')}, n AS (SELECT least(count(*), 256) AS n FROM train) "
    "SELECT CAST(t AS BIGINT) AS tree, CAST(n AS BIGINT) AS n_rows, CAST(n AS BIGINT) AS n_in_leaves, CAST(1 AS BIGINT) AS leaves_less_splits, "
    "CAST(0 AS BIGINT) AS too_deep FROM n, range(200) AS r(t)",
    "iforest_score": f"WITH {TX}{split_of('tx')} SELECT TransactionID, split, CAST(1 AS BIGINT) AS in_range FROM sp",
    "gbt_scores": f"WITH {TX}{split_of('tx')} SELECT TransactionID, split, isFraud, CAST(1 AS BIGINT) AS in_range FROM sp",
    "anomaly_report": "SELECT split, CAST(5 AS BIGINT) AS n_lines, CAST(0 AS BIGINT) AS n_off FROM (VALUES ('train'), ('val'), ('test')) AS s(split)",
    "contributions": "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_off FROM events",
    "model_mean_abs": "SELECT CAST(0 AS BIGINT) AS n_negative, CAST(1 AS BIGINT) AS n_score",
    "model_metrics": f"WITH {TX}{split_of('tx')} SELECT split, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(isFraud) AS BIGINT) AS n_positive, "
    "CAST(1 AS BIGINT) AS same_threshold, CAST(1 AS BIGINT) AS learned FROM sp GROUP BY split",
    "importance": "SELECT CAST(1 AS DOUBLE) AS total, CAST(0 AS BIGINT) AS n_negative",
    "score_batch": f"WITH {TX} SELECT TransactionID, CAST(1 AS BIGINT) AS flag_follows, CAST(3 AS BIGINT) AS n_factors FROM tx "
    "WHERE TransactionAmt > 0 AND TransactionAmt <= 1000000",
    "stream_score": f"WITH {TX} SELECT TransactionID, CAST(1 AS BIGINT) AS equals_batch FROM tx WHERE TransactionAmt > 0 AND TransactionAmt <= 1000000",
    "search_trials": f"WITH {TX}{split_of('tx')}, n AS (SELECT sum(greatest(1, CAST(floor(c * CAST(0.3 AS DOUBLE)) AS BIGINT))) AS n "
    "FROM (SELECT count(*) AS c FROM train GROUP BY isFraud)) SELECT CAST(rung AS BIGINT) AS rung, CAST(rounds AS BIGINT) AS rounds, "
    "CAST(1 AS BIGINT) AS in_ranges, CAST(1 AS BIGINT) AS is_auroc, CAST(n AS BIGINT) AS sample_rows, CAST(1 AS BIGINT) AS chosen, CAST(trials AS BIGINT) AS n_trials "
    "FROM n, (VALUES (0, 2, 4), (1, 6, 2)) AS r(rung, rounds, trials)",
})

# Fitted trees, fitted again: gradient sums on both sides of every cut, missing values tried on either side.
_LEAF_CUTS = """
cuts AS (
  SELECT 0 AS f, k AS bin, c FROM (VALUES (1, 20.0), (2, 40.0), (3, 60.0), (4, 80.0), (5, 100.0), (6, 130.0), (7, 160.0)) AS a(k, c)
  UNION ALL SELECT 1, k, c FROM (VALUES (1, 3.0), (2, 6.0), (3, 9.0), (4, 12.0), (5, 15.0), (6, 18.0), (7, 21.0)) AS h(k, c)
  UNION ALL SELECT 2, k, c FROM (VALUES (1, 5.0), (2, 10.0), (3, 15.0), (4, 20.0), (5, 25.0), (6, 30.0), (7, 35.0)) AS d(k, c)
)"""
_LEAF_ROWS = f"""
counted AS (SELECT count(*) FILTER (WHERE isFraud = 0)::DOUBLE / count(*) FILTER (WHERE isFraud = 1) AS w FROM tx),
r0 AS MATERIALIZED (
  SELECT TransactionID, isFraud::DOUBLE AS y, CASE WHEN isFraud = 1 THEN w ELSE 1.0::DOUBLE END AS w, TransactionAmt AS v0, {HOUR}::DOUBLE AS v1, addr1 AS v2,
    0.0::DOUBLE AS margin, '' AS path
  FROM tx, counted
)"""


def _gain_term(g: str, h: str) -> str:
    return f"pow(greatest(abs({g}) - 0.5::DOUBLE, 0), 2) / ({h} + 1.0::DOUBLE)"


def _leaf(g: str, h: str) -> str:
    return f"(-0.3::DOUBLE * sign({g}) * greatest(abs({g}) - 0.5::DOUBLE, 0) / ({h} + 1.0::DOUBLE))"


def _best_split(source: str, name: str) -> str:
    """CTE ``name``: per path of ``source`` the best split, with the sums of both sides."""
    left = "(v <= c OR (v IS NULL AND side))"
    return f""",
{name}_g AS MATERIALIZED (SELECT *, w * (1 / (1 + exp(-margin)) - y) AS g, w / (1 + exp(-margin)) * (1 - 1 / (1 + exp(-margin))) AS h FROM {source}),
{name}_long AS (
  SELECT path, 0 AS f, v0 AS v, g, h FROM {name}_g UNION ALL SELECT path, 1, v1, g, h FROM {name}_g UNION ALL SELECT path, 2, v2, g, h FROM {name}_g
),
{name}_sides AS (
  SELECT path, f, bin, c, side, sum(g) FILTER (WHERE {left}) AS gl, sum(h) FILTER (WHERE {left}) AS hl, count(*) FILTER (WHERE {left}) AS nl,
    sum(g) AS gt, sum(h) AS ht, count(*) AS nt
  FROM {name}_long JOIN cuts USING (f) CROSS JOIN (VALUES (false), (true)) AS s(side) GROUP BY ALL
),
{name} AS MATERIALIZED (
  SELECT * FROM (
    SELECT *, {_gain_term('gl', 'hl')} + {_gain_term('(gt - gl)', '(ht - hl)')} - {_gain_term('gt', 'ht')} AS gain FROM {name}_sides WHERE nl >= 20 AND nt - nl >= 20)
  QUALIFY row_number() OVER (PARTITION BY path ORDER BY round(gain, 8) DESC, f, bin, side) = 1 AND gain > 0
)"""


def _goes_left(split: str) -> str:
    value = f"CASE {split}.f WHEN 0 THEN v0 WHEN 1 THEN v1 ELSE v2 END"
    return f"({value} <= {split}.c OR ({value} IS NULL AND {split}.side))"


_NAME = "CASE f WHEN 0 THEN 'TransactionAmt' WHEN 1 THEN 'hour_of_day' ELSE 'addr1' END"
_STUMPS = "WITH " + TX + "," + _LEAF_CUTS + "," + _LEAF_ROWS
for _k in range(3):
    _STUMPS += _best_split(f"r{_k}", f"b{_k}") + f""",
r{_k + 1} AS MATERIALIZED (
  SELECT r.* REPLACE (margin + CASE WHEN {_goes_left('b')} THEN {_leaf('gl', 'hl')} ELSE {_leaf('(gt - gl)', '(ht - hl)')} END AS margin) FROM r{_k} r, b{_k} b
)"""

# Rows of every tree of the forest: all buckets are read where the first choice of them gave a tree too few rows.
_A, _B, _C, _P = 48_271, 69_621, 16_807, 2_147_483_647


def _hash_steps(source: str, key: str, seed: str, name: str) -> str:
    """CTE ``name``: ``source`` with the portable hash of a key as ``hash``."""
    return f"""
{name}_1 AS (SELECT *, ((({key}) % {_P}) * {_A} + ({seed})::BIGINT * {_C} + 1) % {_P} AS h1 FROM {source}),
{name}_2 AS (SELECT *, (((h1 * h1) % {_P}) * {_B} + h1) % {_P} AS h2 FROM {name}_1),
{name} AS MATERIALIZED (SELECT * EXCLUDE (h1, h2), (((h2 * h2) % {_P}) * {_C} + h2) % {_P} AS hash FROM {name}_2)"""


ORACLES.update({
    "leaf_splits": f"WITH {TX},{_LEAF_CUTS},{_LEAF_ROWS}{_best_split('r0', 'top')}, "
    f"c0 AS MATERIALIZED (SELECT r.* REPLACE (CASE WHEN {_goes_left('t')} THEN 'l' ELSE 'r' END AS path) FROM r0 r, top t){_best_split('c0', 'low')}, "
    f"inner_nodes AS (SELECT * FROM top UNION ALL SELECT * FROM low), ends AS ("
    "SELECT path || 'l' AS path, gl AS g, hl AS h, nl AS n FROM inner_nodes UNION ALL SELECT path || 'r', gt - gl, ht - hl, nt - nl FROM inner_nodes) "
    f"SELECT path, {_NAME} AS feature, c::DOUBLE AS threshold, side AS missing_left, round(gain, 6) AS gain, NULL::DOUBLE AS value, nt::BIGINT AS n_rows FROM inner_nodes "
    f"UNION ALL SELECT path, NULL, NULL, NULL, NULL, round({_leaf('g', 'h')}, 6), n::BIGINT FROM ends WHERE path NOT IN (SELECT path FROM inner_nodes)",
    "stump_scores": _STUMPS + " SELECT TransactionID, round(1 / (1 + exp(-margin)), 6) AS probability FROM r3",
    "stump_importance": _STUMPS + ", gains AS (SELECT f, gain FROM b0 UNION ALL SELECT f, gain FROM b1 UNION ALL SELECT f, gain FROM b2) "
    f"SELECT {_NAME} AS feature, round(coalesce(sum(gain), 0) / (SELECT sum(gain) FROM gains), 6) AS importance FROM (VALUES (0), (1), (2)) AS a(f) LEFT JOIN gains USING (f) GROUP BY f",
    "forest_sample": f"WITH {TX}{split_of('tx')}, size AS (SELECT count(*) AS n, greatest(1, count(*) // 8) AS buckets, least(256, count(*)) AS size FROM train), "
    f"ids AS (SELECT i FROM range(200 * 55) AS r(i)),{_hash_steps('ids', 'i', '2000045', 'picked')}, "
    "read AS (SELECT DISTINCT i // 55 AS tree, hash % buckets AS bucket FROM picked, size), "
    f"keys AS (SELECT TransactionID FROM train),{_hash_steps('keys', 'TransactionID', '42', 'bucketed')}, "
    "chosen AS (SELECT tree, TransactionID FROM (SELECT TransactionID, hash % buckets AS bucket FROM bucketed, size) JOIN read USING (bucket)), "
    "enough AS (SELECT count(*) = 200 AND min(c) >= max(size) AND 55 < max(buckets) AS ok FROM (SELECT tree, count(*) AS c FROM chosen GROUP BY tree), size), "
    "open AS (SELECT tree, TransactionID FROM chosen, enough WHERE ok UNION ALL "
    "SELECT t, TransactionID FROM keys, range(200) AS r(t), enough WHERE NOT ok),"
    f"{_hash_steps('open', 'TransactionID', 'tree + 1000045', 'ordered')}, "
    "drawn AS (SELECT tree, TransactionID FROM ordered, size QUALIFY row_number() OVER (PARTITION BY tree ORDER BY hash, TransactionID) <= size) "
    "SELECT tree::BIGINT AS tree, count(*)::BIGINT AS n_rows, sum(TransactionID)::BIGINT AS key_sum, min(TransactionID)::BIGINT AS first_key, max(TransactionID)::BIGINT AS last_key "
    "FROM drawn GROUP BY tree",
})
