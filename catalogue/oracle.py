"""The same results as ANSI SQL on the given tables, for DuckDB."""

from __future__ import annotations

from arrears.operators.model import SEARCH_SPACE, draw_candidates
from catalogue.fixtures import CUTOFF, MONTHS, POINT, TRAIN_DATE
from catalogue.queries import BOOSTED, STUMP_FEATURES
from catalogue.store import SEARCH_ITERATIONS

_LOAN_DAILY = """
loan_base AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS loan_id, CAST(o_custkey AS VARCHAR) AS Customer_ID,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS loan_start_date,
         10 AS tenure, CAST(r.n AS INTEGER) AS installment_num, o_totalprice AS loan_amt,
         (o_custkey * 37 + (o_orderkey * 31) % 30) % 100 AS k,
         CASE WHEN (o_custkey * 37 + (o_orderkey * 31) % 30) % 100 = 96 THEN 0.01E0
              ELSE floor(o_totalprice * 10) / 100 END AS due0
  FROM orders, (SELECT n, 0 AS again FROM range(0, 11) t(n) UNION ALL SELECT 6, 1) r
  WHERE again = 0 OR (o_custkey * 37 + (o_orderkey * 31) % 30) % 100 = 95),
loan_paying AS (
  SELECT *,
    CASE WHEN k = 97 THEN 0.0E0 WHEN k = 99 THEN NULL
         WHEN installment_num = 0 THEN 0.0E0 ELSE due0 END AS due_amt,
    CASE WHEN k = 98 THEN NULL WHEN k = 97 THEN due0
         WHEN k = 96 AND installment_num >= 6 THEN 230.0E0
         WHEN k < 8 THEN greatest(0, installment_num - 2) * due0
         WHEN k < 20 THEN greatest(0, least(installment_num - 4, 2)) * due0
         WHEN k < 30 AND installment_num = 6 THEN 0.5E0 * due0 ELSE 0.0E0 END AS overdue_amt,
    CAST(loan_start_date + to_months(installment_num) AS DATE) AS snapshot_date
  FROM loan_base),
loan_daily AS (
  SELECT loan_id, Customer_ID, loan_start_date, tenure, installment_num, loan_amt, due_amt,
         CASE WHEN overdue_amt IS NOT NULL
              THEN greatest(0.0E0, installment_num * due0 - overdue_amt) END AS paid_amt,
         overdue_amt, due0 * 10 - installment_num * due0 AS balance, snapshot_date
  FROM loan_paying)"""

_MONEY = ["loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance"]
_FLOATS = ", ".join(f"CAST(CAST({c} AS FLOAT) AS DOUBLE) AS {c}" for c in _MONEY)
_FILLED = ", ".join(f"coalesce({c}, 0) AS {c}" for c in ["tenure", "installment_num", *_MONEY])

_SILVER = _LOAN_DAILY + f""",
conformed AS (
  SELECT loan_id, Customer_ID, loan_start_date, tenure, installment_num, {_FLOATS}, snapshot_date
  FROM loan_daily),
counted AS (
  SELECT loan_id, Customer_ID, loan_start_date, {_FILLED}, snapshot_date,
         coalesce(installment_num, 0) AS mob,
         coalesce(CAST(ceil(overdue_amt / nullif(due_amt, 0)) AS INTEGER), 0) AS installments_missed
  FROM conformed),
dated AS (
  SELECT *, CASE WHEN installments_missed > 0
                 THEN CAST(snapshot_date - to_months(installments_missed) AS DATE)
            END AS first_missed_date
  FROM counted),
silver AS (
  SELECT *, CAST(CASE WHEN overdue_amt > 0
                      THEN date_diff('day', first_missed_date, snapshot_date)
                      ELSE 0 END AS INTEGER) AS dpd
  FROM dated)"""

_LABELS = _SILVER + """,
labels AS (
  SELECT loan_id, Customer_ID, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label,
         '30dpd_6mob' AS label_def, snapshot_date
  FROM silver WHERE mob = 6)"""

_FEATURES = """
features_once AS (
  SELECT CAST(o_custkey AS VARCHAR) AS Customer_ID,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date,
         CAST(count(*) AS DOUBLE) AS fe_1, sum(l_quantity) AS fe_2, max(l_extendedprice) AS fe_3,
         min(l_discount) AS fe_4,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS DOUBLE) AS fe_5,
         7.0E0 AS fe_6, CAST(max((o_custkey * 37) % 100) AS DOUBLE) AS fe_7
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY 1, 2),
features AS (
  SELECT * FROM features_once
  UNION ALL SELECT * FROM features_once WHERE CAST(Customer_ID AS BIGINT) % 50 = 0)"""

_TRAIN = f"DATE '{TRAIN_DATE}'"
_OOT_START = f"CAST({_TRAIN} - INTERVAL 2 MONTH AS DATE)"
_START = f"CAST({_TRAIN} - INTERVAL 14 MONTH AS DATE)"
_IN_WINDOW = f"snapshot_date >= {_START} AND snapshot_date < {_TRAIN}"
_FE = [f"fe_{i}" for i in range(1, 8)]
_FE_LIST = ", ".join(_FE)

_JOINED = _LABELS + "," + _FEATURES + f""",
joined AS (
  SELECT l.Customer_ID, l.snapshot_date, loan_id, label, label_def, {_FE_LIST},
         CASE WHEN l.snapshot_date >= {_OOT_START} THEN 'oot' ELSE 'train_test' END AS segment
  FROM labels l LEFT JOIN features f
    ON l.Customer_ID = f.Customer_ID AND l.snapshot_date = f.snapshot_date
  WHERE l.{_IN_WINDOW.replace('AND ', 'AND l.')})"""

_SPLIT = _JOINED + """,
class_counts AS (
  SELECT label, count(*) AS n FROM joined WHERE segment = 'train_test' GROUP BY label),
class_totals AS (
  SELECT *, sum(n) OVER () - ceil((1.0E0 - 0.8E0) * sum(n) OVER ()) AS n_train_all,
         sum(n) OVER () AS total FROM class_counts),
class_shares AS (
  SELECT label, n_train_all, CAST(n AS DOUBLE) / CAST(total AS DOUBLE) * n_train_all AS share
  FROM class_totals),
class_sizes AS (
  SELECT label, floor(share)
         + CASE WHEN row_number() OVER (ORDER BY share - floor(share) DESC, label)
                     <= n_train_all - sum(floor(share)) OVER () THEN 1 ELSE 0 END AS n_train
  FROM class_shares),
ranked AS (
  SELECT j.*, row_number() OVER (
           PARTITION BY segment, label
           ORDER BY md5(concat(loan_id, '|88')), loan_id) AS place
  FROM joined j),
split AS (
  SELECT r.*, CASE WHEN segment = 'oot' THEN 'oot'
                   WHEN place <= n_train THEN 'train' ELSE 'test' END AS split
  FROM ranked r JOIN class_sizes s ON r.label = s.label)"""

_SCALER = _SPLIT + ", scaler AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, avg({c}) AS mean,"
    f" CASE WHEN min({c}) = max({c}) THEN 1.0E0 ELSE stddev_pop({c}) END AS scale,"
    f" count({c}) AS n FROM split WHERE split = 'train'"
    for c in _FE
) + ")"

_AUC = _SPLIT + """,
scores AS (
  SELECT split, fe_7 AS score, sum(label) AS pos, sum(1 - label) AS neg
  FROM split WHERE fe_7 IS NOT NULL GROUP BY split, fe_7),
below AS (
  SELECT split, pos, neg,
         coalesce(sum(neg) OVER (PARTITION BY split ORDER BY score
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS beaten
  FROM scores),
aucs AS (
  SELECT split, CAST(sum(pos * (2 * beaten + neg)) AS DOUBLE)
         / nullif(2 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE), 0) AS auc
  FROM below GROUP BY split)"""

# One split of one tree: the cut with the greatest loss of variance of labels -1 and 1.
_STUMP = _SPLIT + """,
stump_train AS (SELECT 2 * label - 1 AS y, fe_4, fe_5 FROM split WHERE split = 'train'),
stump_mean AS (SELECT avg(fe_4) AS m4, avg(fe_5) AS m5 FROM stump_train),
stump_long AS (
  SELECT 'fe_4' AS f, coalesce(fe_4, m4) AS v, y FROM stump_train, stump_mean
  UNION ALL SELECT 'fe_5', coalesce(fe_5, m5), y FROM stump_train, stump_mean
  UNION ALL SELECT 'missing', CASE WHEN fe_4 IS NULL THEN 1.0E0 ELSE 0.0E0 END, y FROM stump_train),
stump_values AS (SELECT f, v, CAST(count(*) AS DOUBLE) AS n, CAST(sum(y) AS DOUBLE) AS s FROM stump_long GROUP BY f, v),
stump_cuts AS (
  SELECT f, v, lead(v) OVER (PARTITION BY f ORDER BY v) AS next,
         sum(n) OVER (PARTITION BY f ORDER BY v) AS nl, sum(s) OVER (PARTITION BY f ORDER BY v) AS sl,
         sum(n) OVER (PARTITION BY f) AS n, sum(s) OVER (PARTITION BY f) AS s
  FROM stump_values),
stump AS (
  SELECT f, (v + next) / 2 AS cut, sl / nl AS low, (s - sl) / (n - nl) AS high FROM stump_cuts
  WHERE next IS NOT NULL
  ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC LIMIT 1),
stump_scored AS (
  SELECT loan_id, Customer_ID, snapshot_date, split, label,
         1 / (1 + exp(-2 * CASE WHEN CASE f WHEN 'fe_4' THEN coalesce(fe_4, m4) WHEN 'fe_5' THEN coalesce(fe_5, m5)
                                           ELSE CASE WHEN fe_4 IS NULL THEN 1 ELSE 0 END END <= cut
                                THEN low ELSE high END)) AS score
  FROM split, stump, stump_mean)"""



def _boosted() -> str:
    """Two boosted trees of two levels, fitted level by level: the same sums, gains and choices as plain SQL.

    Derivatives are whole numbers of 2^-28, so that sums do not depend on their order. A node i has the
    children 2i + 1 and 2i + 2; missing values go where the split gains more, and right on a tie.
    """
    unit, (x0, x1) = "268435456.0E0", STUMP_FEATURES
    rate, alpha, lam = (f"{float(BOOSTED[k])}E0" for k in ("learning_rate", "reg_alpha", "reg_lambda"))
    gamma, least = f"{float(BOOSTED['gamma'])}E0", f"{float(BOOSTED['min_child_weight'])}E0"
    soft = lambda g: f"(sign({g}) * greatest(abs({g}) - {alpha}, 0))"
    gain = lambda g, h: f"{soft(g)} * {soft(g)} / ({h} + {lam})"
    weight = lambda g, h: f"-{soft(g)} / ({h} + {lam})"
    parts = [f""",
b_rows AS MATERIALIZED (
  SELECT loan_id, Customer_ID, snapshot_date, split, label, CAST({x0} AS DOUBLE) AS x0, CAST({x1} AS DOUBLE) AS x1 FROM split),
b_cuts AS MATERIALIZED (
  SELECT DISTINCT 0 AS f, x0 AS cut FROM b_rows WHERE split = 'train' AND x0 IS NOT NULL
  UNION ALL SELECT DISTINCT 1, x1 FROM b_rows WHERE split = 'train' AND x1 IS NOT NULL),
b_m0 AS MATERIALIZED (SELECT *, (SELECT ln(avg(label) / (1 - avg(label))) FROM b_rows WHERE split = 'train') AS margin FROM b_rows)"""]
    for t in (0, 1):
        parts.append(f""",
b_g{t} AS MATERIALIZED (
  SELECT *, CAST(round((p - label) * {unit}) AS BIGINT) AS g, CAST(round(p * (1 - p) * {unit}) AS BIGINT) AS h, 0 AS node
  FROM (SELECT *, 1 / (1 + exp(-margin)) AS p FROM b_m{t}))""")
        rows = f"b_g{t}"
        for level in (0, 1):
            n = f"{t}{level}"
            parts.append(f""",
b_tot{n} AS MATERIALIZED (
  SELECT node, sum(g) AS g, sum(h) AS h FROM {rows} WHERE split = 'train' AND node >= {(1 << level) - 1} GROUP BY node),
b_hist{n} AS MATERIALIZED (
  SELECT node, 0 AS f, x0 AS x, sum(g) AS g, sum(h) AS h FROM {rows} WHERE split = 'train' AND node >= {(1 << level) - 1} GROUP BY node, x0
  UNION ALL
  SELECT node, 1, x1, sum(g), sum(h) FROM {rows} WHERE split = 'train' AND node >= {(1 << level) - 1} GROUP BY node, x1),
b_sides{n} AS (
  SELECT t.node, c.f, c.cut, side, t.g AS tg, t.h AS th,
    coalesce(sum(s.g) FILTER (s.x <= c.cut OR s.x IS NULL AND side = 1), 0) AS lg,
    coalesce(sum(s.h) FILTER (s.x <= c.cut OR s.x IS NULL AND side = 1), 0) AS lh
  FROM b_tot{n} t CROSS JOIN b_cuts c CROSS JOIN (VALUES (0), (1)) d(side) LEFT JOIN b_hist{n} s ON s.node = t.node AND s.f = c.f GROUP BY ALL),
b_units{n} AS (
  SELECT node, f, cut, side, tg / {unit} AS tg, th / {unit} AS th, lg / {unit} AS lg, lh / {unit} AS lh,
    (tg - lg) / {unit} AS rg, (th - lh) / {unit} AS rh FROM b_sides{n}),
b_best{n} AS MATERIALIZED (
  SELECT *, {weight("tg", "th")} AS own, {weight("lg", "lh")} AS low, {weight("rg", "rh")} AS high FROM (
    SELECT *, {gain("lg", "lh")} + {gain("rg", "rh")} - {gain("tg", "th")} AS gain FROM b_units{n} WHERE lh >= {least} AND rh >= {least})
  WHERE gain > 1E-6 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, cut, side) = 1),
b_rows{n} AS MATERIALIZED (
  SELECT r.* EXCLUDE (node), CASE WHEN b.node IS NULL THEN r.node
      WHEN CASE WHEN CASE b.f WHEN 0 THEN x0 ELSE x1 END IS NULL THEN side = 1 ELSE CASE b.f WHEN 0 THEN x0 ELSE x1 END <= cut END
      THEN 2 * r.node + 1 ELSE 2 * r.node + 2 END AS node
  FROM {rows} r LEFT JOIN b_best{n} b ON b.node = r.node)""")
            rows = f"b_rows{n}"
        # Splits above two leaves must gain gamma: first the lower ones, then the root if both are gone.
        parts.append(f""",
b_low{t} AS MATERIALIZED (SELECT * FROM b_best{t}1 WHERE gain >= {gamma}),
b_root{t} AS MATERIALIZED (SELECT * FROM b_best{t}0 WHERE gain >= {gamma} OR (SELECT count(*) FROM b_low{t}) > 0),
b_m{t + 1} AS MATERIALIZED (
  SELECT r.* EXCLUDE (node, g, h, p, margin), margin + {rate} * CASE
      WHEN a.node IS NULL THEN (SELECT {weight("(g / " + unit + ")", "(h / " + unit + ")")} FROM b_tot{t}0)
      WHEN b.node IS NOT NULL THEN CASE WHEN r.node = 2 * b.node + 1 THEN b.low ELSE b.high END
      WHEN r.node IN (1, 3, 4) THEN a.low ELSE a.high END AS margin
  FROM {rows} r LEFT JOIN b_root{t} a ON true LEFT JOIN b_low{t} b ON b.node = (r.node - 1) // 2)""")
    return _SPLIT + "".join(parts) + """,
b_scored AS (SELECT loan_id, Customer_ID, snapshot_date, split, label, 1 / (1 + exp(-margin)) AS score FROM b_m2)"""


_BOOSTED = _boosted()


def _aucs(scored: str) -> str:
    """AUC by split of the scores in a table."""
    return f""",
stump_ties AS (
  SELECT split, score, sum(label) AS pos, sum(1 - label) AS neg FROM {scored} GROUP BY split, score),
stump_below AS (
  SELECT split, pos, neg,
         coalesce(sum(neg) OVER (PARTITION BY split ORDER BY score
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS beaten
  FROM stump_ties),
stump_aucs AS (
  SELECT split, CAST(sum(pos * (2 * beaten + neg)) AS DOUBLE)
         / nullif(2 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE), 0) AS auc
  FROM stump_below GROUP BY split)"""


_STUMP_AUC = _STUMP + _aucs("stump_scored")
_BOOSTED_AUC = _BOOSTED + _aucs("b_scored")

_KEYS = "loan_id, Customer_ID, snapshot_date"
_RAW_COLUMNS = (
    "loan_id, Customer_ID, loan_start_date, tenure, installment_num, loan_amt, due_amt, paid_amt,"
    " overdue_amt, balance, snapshot_date"
)
_SILVER_COLUMNS = _RAW_COLUMNS + ", mob, installments_missed, first_missed_date, dpd"
_LABEL_COLUMNS = "loan_id, Customer_ID, label, label_def, snapshot_date"
_MONTHS_IN = f"snapshot_date BETWEEN DATE '{MONTHS[0]}' AND DATE '{MONTHS[-1]}'"
_POINT = f"snapshot_date = DATE '{POINT}'"
_COMPLETED = f"loan_start_date < DATE '{CUTOFF}'"
_FLAG = "CASE WHEN dpd >= 30 THEN 1 ELSE 0 END"


def _raw(body: str) -> str:
    return f"WITH {_LOAN_DAILY} {body}"


def _silver(body: str) -> str:
    return f"WITH {_SILVER} {body}"


def _labels(body: str) -> str:
    return f"WITH {_LABELS} {body}"


def _features(body: str) -> str:
    return f"WITH {_FEATURES} {body}"


def _inputs() -> str:
    rows = ", ".join(f"('{name}')" for name in _FE)
    return f"SELECT feature, 1 AS is_share, 1.0E0 AS total FROM (VALUES {rows}) t(feature)"


def _candidates() -> str:
    """The drawn settings are fixed values: draws of the search seed."""
    drawn = [
        f"({i}, " + ", ".join(f"{float(value)}E0" for value in candidate.values()) + ")"
        for i, candidate in enumerate(draw_candidates(SEARCH_ITERATIONS))
    ]
    return (
        f"SELECT CAST(candidate AS BIGINT) AS candidate, {', '.join(SEARCH_SPACE)}, 1 AS is_scored,"
        f" CAST(1 AS BIGINT) AS n_best FROM (VALUES {', '.join(drawn)}) t(candidate, {', '.join(SEARCH_SPACE)})"
    )


def _per_split(value: str, name: str) -> str:
    return ", ".join(
        f"(SELECT {value} FROM split WHERE split = '{s}') AS {name}_{s}"
        for s in ("train", "test", "oot")
    )


ORACLE: dict[str, str] = {
    "month_spine": _raw("""
        , span AS (SELECT min(snapshot_date) AS a, max(snapshot_date) AS b FROM loan_daily),
        spine AS (SELECT CAST(unnest(generate_series(CAST(date_trunc('month', a) AS TIMESTAMP),
                         CAST(b AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS snapshot_date
                  FROM span),
        counts AS (SELECT snapshot_date, count(*) AS n FROM loan_daily GROUP BY snapshot_date)
        SELECT s.snapshot_date, coalesce(c.n, 0) AS n
        FROM spine s LEFT JOIN counts c ON s.snapshot_date = c.snapshot_date"""),
    "train_calendar": _labels("""
        , dates AS (SELECT snapshot_date AS d, count(*) AS n_labels FROM labels GROUP BY 1)
        SELECT d AS train_date, CAST(d - INTERVAL 1 DAY AS DATE) AS oot_end,
               CAST(d - INTERVAL 2 MONTH AS DATE) AS oot_start,
               CAST(d - INTERVAL 2 MONTH - INTERVAL 1 DAY AS DATE) AS train_test_end,
               CAST(d - INTERVAL 14 MONTH AS DATE) AS train_test_start, n_labels
        FROM dates"""),
    "date_keys": _raw("""
        SELECT snapshot_date, strftime(snapshot_date, '%Y_%m_%d') AS date_key,
               'credit_model_' || strftime(snapshot_date, '%Y_%m_%d') AS model_version,
               'credit_model_' || strftime(snapshot_date, '%Y_%m_%d') || '.pkl' AS model_file,
               count(*) AS n
        FROM loan_daily GROUP BY snapshot_date"""),
    "csv_scan": _raw(f"SELECT {_RAW_COLUMNS} FROM loan_daily"),
    "feature_scan": _features("SELECT * FROM features"),
    "bronze_snapshot": _raw(f"SELECT {_RAW_COLUMNS} FROM loan_daily WHERE {_POINT}"),
    "bronze_backfill": _raw(f"""
        SELECT snapshot_date, count(*) AS n,
               CAST(sum(CAST(overdue_amt AS DECIMAL(18, 3))) AS DOUBLE) AS overdue_amt
        FROM loan_daily WHERE {_MONTHS_IN} GROUP BY snapshot_date"""),
    "bronze_scan": _raw(f"SELECT {_RAW_COLUMNS} FROM loan_daily WHERE {_POINT}"),
    "silver_conform": _silver(f"SELECT {_RAW_COLUMNS} FROM conformed"),
    "silver_mob": _silver(f"SELECT {_KEYS}, mob FROM silver"),
    "silver_missed": _silver(
        f"SELECT {_KEYS}, due_amt, overdue_amt, installments_missed FROM silver"
    ),
    "silver_fill": _silver(
        f"SELECT {_KEYS}, tenure, installment_num, {', '.join(_MONEY)} FROM silver"
    ),
    "silver_first_missed": _silver(
        f"SELECT {_KEYS}, installments_missed, first_missed_date FROM silver"
    ),
    "silver_dpd": _silver(f"SELECT {_KEYS}, overdue_amt, dpd FROM silver"),
    "silver_backfill": _silver(f"SELECT {_SILVER_COLUMNS} FROM silver WHERE {_MONTHS_IN}"),
    "silver_scan": _silver(f"SELECT {_SILVER_COLUMNS} FROM silver WHERE {_POINT}"),
    "gold_label": _labels(f"SELECT {_LABEL_COLUMNS} FROM labels"),
    "gold_backfill": _labels(f"SELECT {_LABEL_COLUMNS} FROM labels WHERE {_MONTHS_IN}"),
    "label_store_scan": _labels(f"""
        SELECT snapshot_date, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives
        FROM labels WHERE {_MONTHS_IN} GROUP BY snapshot_date"""),
    "layer_counts": _labels(f"""
        SELECT 'bronze' AS layer, snapshot_date, count(*) AS n, CAST(NULL AS BIGINT) AS n_null_dpd
        FROM loan_daily WHERE {_MONTHS_IN} GROUP BY snapshot_date
        UNION ALL
        SELECT 'silver', snapshot_date, count(*), count(*) - count(dpd)
        FROM silver WHERE {_MONTHS_IN} GROUP BY snapshot_date
        UNION ALL
        SELECT 'gold', snapshot_date, count(*), CAST(NULL AS BIGINT)
        FROM labels WHERE {_MONTHS_IN} GROUP BY snapshot_date"""),
    "completed_loans": _silver(
        f"SELECT {_KEYS}, loan_start_date, mob, dpd FROM silver WHERE {_COMPLETED}"
    ),
    "dpd_flag": _silver(f"SELECT {_KEYS}, mob, dpd, {_FLAG} AS dpd_flag FROM silver"),
    "actual_bads": _silver(
        f"SELECT {_KEYS}, {_FLAG} AS dpd_flag FROM silver"
        f" WHERE {_COMPLETED} AND installment_num = 10"
    ),
    "bad_rate_by_mob": _silver(f"""
        SELECT mob, avg({_FLAG}) AS bad_rate, count(*) AS n
        FROM silver WHERE {_COMPLETED} GROUP BY mob ORDER BY mob"""),
    "label_window": _labels(f"SELECT {_LABEL_COLUMNS} FROM labels WHERE {_IN_WINDOW}"),
    "feature_window": _features(f"SELECT * FROM features WHERE {_IN_WINDOW}"),
    "training_join": f"WITH {_JOINED} SELECT * EXCLUDE (segment) FROM joined",
    "oot_split": f"WITH {_JOINED} SELECT {_KEYS}, label, segment FROM joined",
    "stratified_split": f"WITH {_SPLIT} SELECT {_KEYS}, label, split FROM split",
    "split_stats": f"""WITH {_SPLIT}
        SELECT split, count(*) AS n, round_even(avg(label), 2) AS event_rate
        FROM split GROUP BY split""",
    "feature_select": _features(f"SELECT {_FE_LIST} FROM features"),
    "training_matrix": f"""WITH {_SPLIT}
        SELECT loan_id, split, CAST(label AS DOUBLE) AS label, {_FE_LIST} FROM split""",
    "scaler_fit": f"""WITH {_SCALER}
        SELECT feature, round(mean, 6) AS mean, round(scale, 6) AS scale, n FROM scaler""",
    "scaler_apply": f"WITH {_SCALER} SELECT {_KEYS}, split, " + ", ".join(
        f"round((fe_{i} - (SELECT mean FROM scaler WHERE feature = 'fe_{i}'))"
        f" / (SELECT scale FROM scaler WHERE feature = 'fe_{i}'), 6) + 0.0E0 AS z_{i}"
        for i in range(1, 8)
    ) + " FROM split",
    "auc": f"WITH {_AUC} SELECT split, auc FROM aucs",
    "gini": f"WITH {_AUC} SELECT split, round_even(2 * auc - 1, 3) AS gini FROM aucs",
    "auc_hard": f"""WITH {_SPLIT}
        SELECT split,
          (CAST(sum(CASE WHEN label = 1 AND fe_7 >= 70 THEN 1 ELSE 0 END) AS DOUBLE)
             / nullif(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END), 0)
           + CAST(sum(CASE WHEN label = 0 AND fe_7 < 70 THEN 1 ELSE 0 END) AS DOUBLE)
             / nullif(sum(CASE WHEN label = 0 THEN 1 ELSE 0 END), 0)) / 2 AS auc
        FROM split WHERE fe_7 IS NOT NULL GROUP BY split""",
    "model_registry": f"""WITH {_SPLIT}
        SELECT 'credit_model_{TRAIN_DATE:%Y_%m_%d}' AS model_version, '{",".join(_FE)}' AS features,
               {_TRAIN} AS train_date, {_START} AS train_test_start,
               CAST({_OOT_START} - INTERVAL 1 DAY AS DATE) AS train_test_end,
               {_OOT_START} AS oot_start, CAST({_TRAIN} - INTERVAL 1 DAY AS DATE) AS oot_end,
               0.8E0 AS train_test_ratio, {_per_split("count(*)", "n")},
               {_per_split("round_even(avg(label), 2)", "event_rate")},
               9 AS n_params, 9 AS n_applied, 1 AS gini_follows_auc""",
    "gbt_train": _inputs(),
    "random_search": _candidates(),
    "eval_report": f"""WITH {_SPLIT}
        SELECT split, count(*) AS n, round_even(avg(label), 2) AS event_rate,
               1 AS is_auc, 1 AS gini_follows_auc
        FROM split GROUP BY split""",
    "stump_scores": f"""WITH {_STUMP}
        SELECT {_KEYS}, split, label, round(score, 6) AS score FROM stump_scored""",
    "stump_report": f"""WITH {_STUMP_AUC}
        SELECT split, n, event_rate, round(auc, 6) AS auc, round_even(2 * auc - 1, 3) AS gini
        FROM (SELECT split, count(*) AS n, round_even(avg(label), 2) AS event_rate FROM split GROUP BY split)
        LEFT JOIN stump_aucs USING (split)""",
    "gbt_scores": f"""WITH {_BOOSTED}
        SELECT {_KEYS}, split, label, round(score, 6) AS score FROM b_scored""",
    "gbt_report": f"""WITH {_BOOSTED_AUC}
        SELECT split, n, event_rate, round(auc, 6) AS auc, round_even(2 * auc - 1, 3) AS gini
        FROM (SELECT split, count(*) AS n, round_even(avg(label), 2) AS event_rate FROM split GROUP BY split)
        LEFT JOIN stump_aucs USING (split)""",
    "batch_score": _features(f"""
        SELECT Customer_ID, snapshot_date,
               'credit_model_{TRAIN_DATE:%Y_%m_%d}.pkl' AS model_name, 1 AS is_probability
        FROM features WHERE {_POINT}"""),
    "model_reload": f"""WITH {_SPLIT}
        SELECT split, count(*) AS n, 1 AS equal FROM split WHERE split = 'oot' GROUP BY split""",
    "prediction_store": _features(f"""
        SELECT Customer_ID, snapshot_date,
               'credit_model_{TRAIN_DATE:%Y_%m_%d}.pkl' AS model_name, 1 AS is_probability
        FROM features WHERE {_POINT}"""),
    "score_backfill": _features(f"""
        SELECT snapshot_date, count(*) AS n, count(*) AS n_probabilities
        FROM features WHERE {_MONTHS_IN} GROUP BY snapshot_date"""),
    "score_input": _features(f"SELECT * FROM features WHERE {_POINT}"),
    "audit_counts": f"""WITH {_JOINED},
        counts AS (
          SELECT 'bronze' AS job, 'feed loaded' AS step, 0 AS place, (SELECT count(*) FROM loan_daily) AS n
          UNION ALL SELECT 'bronze', 'bronze months', 1, (SELECT count(*) FROM loan_daily WHERE {_MONTHS_IN})
          UNION ALL SELECT 'silver', 'bronze loaded', 0, (SELECT count(*) FROM loan_daily WHERE {_MONTHS_IN})
          UNION ALL SELECT 'labels', 'silver loaded', 0, (SELECT count(*) FROM silver WHERE {_MONTHS_IN})
          UNION ALL SELECT 'labels', 'labels', 1, (SELECT count(*) FROM labels WHERE {_MONTHS_IN})
          UNION ALL SELECT 'training', 'features loaded', 0, (SELECT count(*) FROM features)
          UNION ALL SELECT 'training', 'features in window', 1, (SELECT count(*) FROM features WHERE {_IN_WINDOW})
          UNION ALL SELECT 'training', 'labels in window', 2, (SELECT count(*) FROM labels WHERE {_IN_WINDOW})
          UNION ALL SELECT 'training', 'labels with features', 3, (SELECT count(*) FROM labels JOIN features USING (Customer_ID, snapshot_date) WHERE {_IN_WINDOW})
          UNION ALL SELECT 'training', 'labels without features', 4,
            (SELECT count(*) FROM labels ANTI JOIN features USING (Customer_ID, snapshot_date) WHERE {_IN_WINDOW})
          UNION ALL SELECT 'scoring', 'features loaded', 0, (SELECT count(*) FROM features)
          UNION ALL SELECT 'scoring', 'features of the months', 1, (SELECT count(*) FROM features WHERE {_POINT})
          UNION ALL SELECT 'scoring', 'predictions', 2, (SELECT count(*) FROM features WHERE {_POINT}))
        SELECT job, step, CAST(place AS INTEGER) AS place, n FROM counts""",
    "incremental_backfill": _labels(f"""
        SELECT 'silver' AS layer, snapshot_date, count(*) AS n,
               CAST(CASE WHEN {_POINT} THEN 3 ELSE 0 END AS BIGINT) AS n_rebuilt
        FROM silver WHERE {_MONTHS_IN} GROUP BY snapshot_date
        UNION ALL
        SELECT 'gold', snapshot_date, count(*), CAST(CASE WHEN {_POINT} THEN 3 ELSE 0 END AS BIGINT)
        FROM labels WHERE {_MONTHS_IN} GROUP BY snapshot_date"""),
    "month_types": _raw("""
        , months AS (SELECT snapshot_date, count(due_amt) AS n_due, count(overdue_amt) AS n_overdue, count(paid_amt) AS n_paid,
            count(balance) AS n_balance, count(loan_amt) AS n_loan, year(snapshot_date) AS y FROM loan_daily GROUP BY snapshot_date),
        typed AS (
          SELECT snapshot_date, unnest([
            {'c': 'loan_id', 't': 'int'}, {'c': 'Customer_ID', 't': 'int'}, {'c': 'loan_start_date', 't': 'date'},
            {'c': 'tenure', 't': 'int'}, {'c': 'installment_num', 't': 'int'},
            {'c': 'loan_amt', 't': if(n_loan = 0, 'void', 'double')}, {'c': 'due_amt', 't': if(n_due = 0, 'void', 'double')},
            {'c': 'paid_amt', 't': if(n_paid = 0, 'void', 'double')}, {'c': 'overdue_amt', 't': if(n_overdue = 0, 'void', 'double')},
            {'c': 'balance', 't': if(n_balance = 0, 'void', 'double')},
            {'c': 'branch', 't': CASE WHEN y < 1996 THEN 'int' WHEN y < 1997 THEN 'double' WHEN y < 1998 THEN 'date'
                                      WHEN y < 1999 THEN 'void' ELSE 'string' END}]) AS x FROM months),
        merged AS (SELECT x.c AS "column", CASE WHEN x.c = 'branch' THEN 'string' ELSE max(x.t) FILTER (x.t <> 'void') END AS merged_type
                   FROM typed GROUP BY x.c)
        SELECT snapshot_date, "column", x.t AS type, merged_type, x.t NOT IN ('void', merged_type) AS drift
        FROM typed JOIN merged ON x.c = "column" """),
    "published_labels": _labels(f"""
        , stricter AS (SELECT *, CASE WHEN snapshot_date = DATE '{MONTHS[0]}' THEN 60 ELSE 30 END AS days FROM silver WHERE mob = 6)
        SELECT loan_id, Customer_ID, CASE WHEN dpd >= days THEN 1 ELSE 0 END AS label, days || 'dpd_6mob' AS label_def, snapshot_date
        FROM stricter WHERE {_MONTHS_IN} AND NOT ({_POINT})"""),
}
