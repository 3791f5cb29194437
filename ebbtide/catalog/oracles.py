"""ANSI SQL for the queries, written against the given tables for an independent engine.

Nothing here is used to compute results; the SQL restates each query directly (global windows,
cross-checks by definition) rather than in the form Spark runs.
"""

from __future__ import annotations

from ebbtide.operators.metrics import METRICS
from ebbtide.spec import CHURN

CLEAN = list(CHURN.columns)
FEATURES = list(CHURN.features)
LINE_FEATURES = [
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "status_open",
    "status_filled",
]


def join(parts, sep: str = ", ") -> str:
    return sep.join(parts)


# --- shared table expressions ----------------------------------------------------------------

RAW = """
o AS (
  SELECT o_custkey AS k, count(*) AS n,
         max(year(o_orderdate)*12+month(o_orderdate))
           - min(year(o_orderdate)*12+month(o_orderdate)) AS tenure,
         2001*12+8 - max(year(o_orderdate)*12+month(o_orderdate)) AS idle,
         sum(CASE WHEN o_orderstatus='P' THEN 1 ELSE 0 END) AS pend,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spend
  FROM orders GROUP BY o_custkey),
e AS (
  SELECT user_id AS k, sum(CASE WHEN event_type='error' THEN 1 ELSE 0 END) AS err
  FROM events GROUP BY user_id),
copies AS (
  SELECT *, 0 AS d FROM customer
  UNION ALL SELECT *, 1 AS d FROM customer WHERE c_custkey % 20 = 0),
raw AS (
  SELECT
    CAST(CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE c_custkey END AS INT) AS customer_id,
    CAST(CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE 18 + c_custkey % 60 END AS INT) AS age,
    trim(CASE c_custkey % 4 WHEN 0 THEN ' Male ' WHEN 1 THEN 'FEMALE' WHEN 2 THEN 'Female' END)
      AS gender,
    CAST(coalesce(o.tenure, 0) - d AS INT) AS tenure,
    CAST(o.n AS INT) AS usage_frequency,
    CAST(e.err AS INT) AS support_calls,
    CAST(CASE WHEN c_custkey % 53 = 0 THEN -1 ELSE o.pend END AS INT) AS payment_delay,
    trim(CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Basic ' WHEN 'BUILDING' THEN 'Standard'
      WHEN 'FURNITURE' THEN ' premium' WHEN 'MACHINERY' THEN 'Trial' END) AS subscription_type,
    CASE c_nationkey % 4 WHEN 0 THEN 'Monthly' WHEN 1 THEN 'Quarterly' WHEN 2 THEN 'annual' END
      AS contract_length,
    o.spend AS total_spend,
    CAST(o.idle AS INT) AS last_interaction,
    CAST(CASE WHEN c_custkey % 89 = 0 THEN NULL WHEN c_custkey % 101 = 0 THEN 2
              WHEN o.idle > 6 THEN 1 ELSE 0 END AS INT) AS churn,
    CASE WHEN c_nationkey < 20 THEN 'train' ELSE 'external' END AS dataset
  FROM copies LEFT JOIN o ON o.k = c_custkey LEFT JOIN e ON e.k = c_custkey)"""

_FILLED = join(
    f"coalesce({c}, '{v}') AS {c}" if isinstance(v, str) else f"coalesce({c}, {v}) AS {c}"
    for c, v in CHURN.fills.items()
)
_ORDER = join(f"{c} DESC" for c in [*CLEAN[1:], "dataset"])
_VALID = "churn IN (0, 1) AND " + join((f"{c} >= 0" for c in CHURN.numeric), " AND ")
_ONE_ROW = f"row_number() OVER (PARTITION BY customer_id ORDER BY {_ORDER}) AS place"

FILLED = f"""{RAW},
filled AS (
  SELECT customer_id, {_FILLED}, churn, dataset FROM raw
  WHERE customer_id IS NOT NULL AND churn IS NOT NULL)"""

CLEANED = f"""{FILLED},
cleaned AS (
  SELECT {join(CLEAN)}, dataset FROM (SELECT *, {_ONE_ROW} FROM filled)
  WHERE place = 1 AND {_VALID})"""

_ONE_HOT = join(
    f"CASE WHEN lower({c}) = '{v}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS {f}"
    for c, vocabulary in CHURN.categorical.items()
    for v, f in vocabulary.items()
)
_NUMERIC = join(f"CAST({c} AS DOUBLE) AS {c}" for c in CHURN.numeric)

FEATURED = f"""{CLEANED},
features AS (
  SELECT CAST(customer_id AS BIGINT) AS customer_id, {_NUMERIC}, {_ONE_HOT},
         CAST(churn AS DOUBLE) AS churn, dataset FROM cleaned)"""

LINES = """
lines AS (
  SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
         l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax,
         CASE WHEN lower(l_linestatus) = 'o' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
           AS status_open,
         CASE WHEN lower(l_linestatus) = 'f' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
           AS status_filled,
         CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS DOUBLE) AS returned,
         CAST(CASE WHEN l_quantity * (1 - l_discount) > 25 THEN 1 ELSE 0 END AS INT) AS large,
         CASE WHEN year(l_shipdate) < 1997 THEN 'train' ELSE 'external' END AS dataset
  FROM lineitem)"""

LINE_SCORES = """
scores AS (
  SELECT l_linestatus, l_linenumber,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned,
         CASE WHEN l_quantity * (1 - l_discount) > 25 THEN 1 ELSE 0 END AS large,
         (l_quantity - 25) / 10 - l_discount * 5 AS logit,
         CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS prediction
  FROM lineitem)"""


def with_(tables: str, body: str) -> str:
    return f"WITH {tables.strip()}\n{body.strip()}"


def hashed(key: str) -> str:
    """The row hash with seed 42."""
    return f"md5('42:' || {key})"


def hex_share(share: float) -> str:
    return f"{int(share * 16**12):012x}"


def sigmoid(z: str) -> str:
    return (
        f"CASE WHEN {z} >= 0 THEN 1 / (1 + exp(-abs({z}))) "
        f"ELSE exp(-abs({z})) / (1 + exp(-abs({z}))) END"
    )


def cross_entropy(z: str, y: str) -> str:
    return f"(greatest({z}, 0) - {z} * {y} + ln(1 + exp(-abs({z}))))"


def split_tables(source: str, key: str, label: str) -> str:
    """Global ranking per label by hash, largest-remainder quotas: ``assigned``."""
    return f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {label}
                               ORDER BY {hashed(f"CAST({key} AS VARCHAR)")},
                                        CAST({key} AS VARCHAR)) AS pos
  FROM {source}),
sizes AS (SELECT {label} AS y, count(*) AS n FROM {source} GROUP BY {label}),
total AS (SELECT CAST(sum(n) AS BIGINT) AS t, CAST(ceil(0.3 * sum(n)) AS BIGINT) AS h FROM sizes),
first_share AS (SELECT y, n, h, t, n * (t - h) // t AS base, n * (t - h) % t AS rest
                FROM sizes, total),
first_quota AS (
  SELECT y, n, h, t, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, y)
           <= (t - h) - sum(base) OVER () THEN 1 ELSE 0 END AS q1 FROM first_share),
second_share AS (
  SELECT y, n, q1, h - CAST(ceil(0.5 * h) AS BIGINT) AS v,
         (n - q1) * (h - CAST(ceil(0.5 * h) AS BIGINT)) // h AS base,
         (n - q1) * (h - CAST(ceil(0.5 * h) AS BIGINT)) % h AS rest FROM first_quota),
quota AS (
  SELECT y, q1, q1 + base + CASE WHEN row_number() OVER (ORDER BY rest DESC, y)
           <= v - sum(base) OVER () THEN 1 ELSE 0 END AS q2 FROM second_share),
assigned AS (
  SELECT ranked.*, CASE WHEN pos <= q1 THEN 'training' WHEN pos <= q2 THEN 'validation'
                        ELSE 'internal_test' END AS split
  FROM ranked JOIN quota ON ranked.{label} = quota.y)"""


ORDERS_LABELLED = """
labelled AS (SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INT)
               AS filled FROM orders)"""
ORDERS_SPLIT = ORDERS_LABELLED + "," + split_tables("labelled", "o_orderkey", "filled")
CUSTOMERS_SPLIT = (
    FEATURED
    + ", known AS (SELECT * FROM features WHERE dataset = 'train'),"
    + split_tables("known", "customer_id", "churn")
)


def significant(x: str) -> str:
    """Fewer decimals for larger magnitudes."""
    return (
        f"CASE WHEN abs({x}) < 1 THEN round({x}, 9) WHEN abs({x}) < 1000 THEN round({x}, 7) "
        f"ELSE round({x}, 4) END"
    )


def stack(rows, names) -> str:
    """UNION ALL of literal-named rows from a one-row relation: ``rows`` is (source, values)."""
    return "\nUNION ALL\n".join(
        f"SELECT {join(f'{v} AS {n}' for v, n in zip(values, names, strict=True))} FROM {source}"
        for source, values in rows
    )


def scaler_sql(source: str, features: list[str]) -> str:
    rows = [
        (
            source,
            (
                f"CAST({i} AS INT)",
                f"'{c}'",
                significant(f"avg({c})"),
                significant(f"(CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END)"),
            ),
        )
        for i, c in enumerate(features)
    ]
    return stack(rows, ("position", "feature", "mean", "scale"))


def correlation(x: str, y: str) -> str:
    return (
        f"CASE WHEN stddev_pop({x}) = 0 OR stddev_pop({y}) = 0 THEN NULL "
        f"ELSE covar_pop({x}, {y}) / (stddev_pop({x}) * stddev_pop({y})) END"
    )


def profile_tables(
    source: str, features: list[str], label: str, by: str = "dataset", name: str = "profile"
) -> str:
    """``profile``: one row per dataset and feature."""
    selects = "\nUNION ALL\n".join(
        f"SELECT {by}, '{c}' AS feature, count({c}) AS row_count, avg({c}) AS mean, "
        f"stddev_samp({c}) AS std, {correlation(c, label)} AS correlation "
        f"FROM {source} GROUP BY {by.split(' AS ')[0]}"
        for c in features
    )
    return f"{name} AS ({selects})"


def report_tables(label: str) -> str:
    return f"""
report AS (
  SELECT coalesce(a.feature, b.feature) AS feature, a.mean AS train_mean, b.mean AS test_mean,
         (b.mean - a.mean) / nullif(a.std, 0) AS standardized_mean_shift,
         a.correlation AS train_correlation_with_{label},
         b.correlation AS test_correlation_with_{label},
         b.correlation - a.correlation AS correlation_change,
         abs(b.correlation - a.correlation) AS absolute_correlation_change
  FROM (SELECT * FROM profile WHERE dataset = 'train') a
  FULL JOIN (SELECT * FROM profile WHERE dataset = 'external') b ON a.feature = b.feature)"""


def rounded_report(label: str) -> str:
    return f"""
SELECT feature, {significant("train_mean")} AS train_mean,
       {significant("test_mean")} AS test_mean,
       round(standardized_mean_shift, 9) AS standardized_mean_shift,
       round(train_correlation_with_{label}, 9) AS train_correlation_with_{label},
       round(test_correlation_with_{label}, 9) AS test_correlation_with_{label},
       round(correlation_change, 9) AS correlation_change,
       round(absolute_correlation_change, 9) AS absolute_correlation_change
FROM report"""


def drift_sql(by: str, label: str) -> str:
    """Rows of ``profile`` per ``by`` beside those of ``known``, flagged at 0.1."""
    return f"""
SELECT {by}, feature, row_count, {significant("train_mean")} AS train_mean,
       {significant("test_mean")} AS test_mean,
       round(shift, 9) AS standardized_mean_shift,
       round(train_correlation, 9) AS train_correlation_with_{label},
       round(test_correlation, 9) AS test_correlation_with_{label},
       round(change, 9) AS correlation_change, round(abs(change), 9) AS absolute_correlation_change,
       coalesce(abs(shift) > 0.1, FALSE) OR coalesce(abs(change) > 0.1, FALSE) AS drifted
FROM (
  SELECT p.{by}, p.feature, p.row_count, k.mean AS train_mean, p.mean AS test_mean,
         (p.mean - k.mean) / nullif(k.std, 0) AS shift, k.correlation AS train_correlation,
         p.correlation AS test_correlation, p.correlation - k.correlation AS change
  FROM profile p JOIN known k ON p.feature = k.feature)"""


CUSTOMER_REPORT = (
    FEATURED + "," + profile_tables("features", FEATURES, "churn") + "," + report_tables("churn")
)
LINE_REPORT = (
    LINES + "," + profile_tables("lines", LINE_FEATURES, "returned") + "," + report_tables("returned")
)


def network_tables(source: str, features: list[str], scaler: str, kept: list[str], label: str) -> str:
    """Forward pass of the rule model, written out: ``scored`` with logit, probability, ..."""
    widths = (len(features), 32, 16, 1)
    names = [[f"z_{c}" for c in features]] + [
        [f"h{d}_{j}" for j in range(n)] for d, n in enumerate(widths[1:-1])
    ] + [["logit"]]
    scaled = join(
        f"({c} - {scaler}.m_{c}) / CASE WHEN {scaler}.s_{c} = 0 THEN 1 ELSE {scaler}.s_{c} END AS z_{c}"
        for c in features
    )
    steps = [f"layer0 AS (SELECT {join(kept)}, {scaled} FROM {source}, {scaler})"]

    def weight(depth: int, i: int, j: int) -> str:
        return f"CAST({((i * 7 + j * 3 + depth) % 11 - 5) / 10} AS DOUBLE)"

    for depth, (inputs, outputs) in enumerate(zip(names, names[1:], strict=False)):
        units = []
        for j, out in enumerate(outputs):
            total = join(
                [f"{c} * {weight(depth, i, j)}" for i, c in enumerate(inputs)]
                + [weight(depth, len(inputs), j)],
                " + ",
            )
            units.append(f"{total} AS {out}" if out == "logit" else f"greatest({total}, 0) AS {out}")
        steps.append(f"layer{depth + 1} AS (SELECT {join(kept)}, {join(units)} FROM layer{depth})")
    steps.append(
        f"scored AS (SELECT {join(kept)}, logit, {sigmoid('logit')} AS probability, "
        f"CAST(CASE WHEN {sigmoid('logit')} >= 0.5 THEN 1 ELSE 0 END AS INT) AS prediction, "
        f"{cross_entropy('logit', label)} AS loss FROM layer3)"
    )
    return ",\n".join(steps)


def statistics_table(name: str, source: str, features: list[str], digits: int = 15) -> str:
    stats = join(
        f"round(avg({c}), {digits}) AS m_{c}, round(stddev_pop({c}), {digits}) AS s_{c}"
        for c in features
    )
    return f"{name} AS (SELECT {stats} FROM {source})"


CUSTOMER_SCORES = ",\n".join(
    [
        FEATURED,
        statistics_table("stats", "(SELECT * FROM features WHERE dataset = 'train')", FEATURES, 3),
        network_tables("features", FEATURES, "stats", ["customer_id", "churn", "dataset"], "churn"),
    ]
)
_LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "returned"]
LINE_NETWORK = ",\n".join(
    [
        LINES,
        statistics_table("stats", "lines", LINE_FEATURES, 3),
        network_tables("lines", LINE_FEATURES, "stats", _LINE_KEYS, "returned"),
    ]
)


def counts(y: str, p: str) -> str:
    return join(
        f"CAST(count(*) FILTER (WHERE {y} = {a} AND {p} = {b}) AS BIGINT) AS {name}"
        for a, b, name in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
    )


THRESHOLD = {
    "accuracy": "coalesce((tp + tn) / nullif(tn + fp + fn + tp, 0), 0)",
    "precision": "coalesce(tp / nullif(tp + fp, 0), 0)",
    "recall": "coalesce(tp / nullif(tp + fn, 0), 0)",
    "f1": "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)",
}
BALANCED = (
    "(coalesce(tp / nullif(tp + fn, 0), tn / nullif(tn + fp, 0)) "
    "+ coalesce(tn / nullif(tn + fp, 0), tp / nullif(tp + fn, 0))) / 2"
)


def ranking_tables(source: str, by: str, score: str, label: str) -> str:
    """``ranking``: AUC from mid-ranks, average precision from a global running count."""
    return f"""
by_score AS (
  SELECT {by} AS g, {score} AS s, CAST(sum({label}) AS DOUBLE) AS p,
         CAST(sum(1 - {label}) AS DOUBLE) AS n FROM {source} GROUP BY ALL),
running AS (
  SELECT *, sum(p) OVER w AS tp, sum(n) OVER w AS fp,
         sum(p) OVER (PARTITION BY g) AS pos, sum(n) OVER (PARTITION BY g) AS neg
  FROM by_score WINDOW w AS (PARTITION BY g ORDER BY s DESC)),
ranking AS (
  SELECT g, sum(n * (tp - p / 2)) / nullif(max(pos) * max(neg), 0) AS roc_auc,
         coalesce(sum(p * tp / (tp + fp)) / nullif(max(pos), 0), 0) AS average_precision
  FROM running GROUP BY g)"""


def evaluation_sql(scored: str, by: str, label: str) -> str:
    """Tables ``evaluated`` from ``scored`` rows with probability and loss."""
    return (
        ranking_tables(scored, by, "probability", label)
        + f""",
totals AS (
  SELECT {by} AS g, count(*) AS row_count,
         {counts(label, "CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END")}, avg(loss) AS loss
  FROM {scored} GROUP BY {by}),
evaluated AS (
  SELECT totals.g AS {by}, row_count, tn, fp, fn, tp, loss,
         {join(f"{v} AS {k}" for k, v in THRESHOLD.items())}, roc_auc, average_precision,
         {BALANCED} AS balanced_accuracy
  FROM totals JOIN ranking ON totals.g = ranking.g)"""
    )


def rounded_evaluation(by: str) -> str:
    values = join(f"round({m}, 9) AS {m}" for m in [*METRICS, "balanced_accuracy"])
    return f"SELECT {by}, row_count, tn, fp, fn, tp, {values} FROM evaluated"


EVENT_SCORES = """
scores AS (SELECT floor(value) / 400 AS score,
                  CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS error FROM events)"""
LINE_EVALUATION = (
    LINE_SCORES
    + f""",
scored AS (SELECT *, {sigmoid("logit")} AS probability, {cross_entropy("logit", "large")} AS loss
           FROM scores),"""
    + evaluation_sql("scored", "l_linestatus", "large")
)

# Parameter rows of the run record, as the training configuration prints them.
_PARAMETERS = {
    "batch_size": "2048",
    "epochs": "8",
    "learning_rate": "0.002",
    "prediction_threshold": "0.5",
    "input_features": "15",
    "random_seed": "42",
}


def null_audit_sql(source: str, columns: list[str]) -> str:
    rows = [(source, (f"'{c}'", f"count(*) - count({c})")) for c in columns]
    return stack(rows, ("column_name", "null_rows"))


ORACLES: dict[str, str] = {
    "clean_customers": with_(CLEANED, "SELECT * FROM cleaned"),
    "clean_customers_validate_first": with_(
        FILLED,
        f"""SELECT {join(CLEAN)}, dataset
            FROM (SELECT *, {_ONE_ROW} FROM filled WHERE {_VALID}) WHERE place = 1""",
    ),
    "csv_roundtrip": with_(CLEANED, f"SELECT {join(CLEAN)} FROM cleaned"),
    "dedupe_lineitem": """
        SELECT * EXCLUDE (place) FROM (
          SELECT *, row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
                     l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC,
                     l_shipdate DESC) AS place FROM lineitem) WHERE place = 1""",
    "label_frequency": with_(
        CLEANED,
        "SELECT dataset, churn, count(*) AS row_count FROM cleaned GROUP BY ALL ORDER BY 1, 2",
    ),
    "category_frequency": with_(
        CLEANED,
        """SELECT dataset, subscription_type, count(*) AS row_count FROM cleaned
           GROUP BY ALL ORDER BY 1, 2""",
    ),
    "null_audit_raw": with_(RAW, null_audit_sql("raw", CLEAN)),
    "null_audit_features": with_(
        FEATURED, null_audit_sql("features", ["customer_id", *FEATURES, "churn"])
    ),
    "removed_rows": with_(
        CLEANED,
        """SELECT r.dataset, r.n AS raw_rows, coalesce(c.n, 0) AS cleaned_rows,
                  r.n - coalesce(c.n, 0) AS removed_rows
           FROM (SELECT dataset, count(*) AS n FROM raw GROUP BY dataset) r
           LEFT JOIN (SELECT dataset, count(*) AS n FROM cleaned GROUP BY dataset) c
             ON r.dataset = c.dataset""",
    ),
    "sample_customers": with_(CLEANED, "SELECT * FROM cleaned ORDER BY customer_id LIMIT 5"),
    "features": with_(FEATURED, "SELECT * FROM features"),
    "float_features": with_(
        LINES,
        f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
            {join(f"CAST(CAST({c} AS FLOAT) AS DOUBLE) AS {c}" for c in [*LINE_FEATURES, "returned"])}
            FROM lines""",
    ),
    "lineitem_features": with_(
        LINES,
        f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
            {join(LINE_FEATURES)}, returned, large, dataset FROM lines""",
    ),
    "split_orders_exact": with_(ORDERS_SPLIT, "SELECT o_orderkey, filled, split FROM assigned"),
    "split_orders_hash": with_(
        ORDERS_LABELLED,
        f"""SELECT o_orderkey, filled,
              CASE WHEN h < '{hex_share(0.7)}' THEN 'training'
                   WHEN h < '{hex_share(0.85)}' THEN 'validation'
                   ELSE 'internal_test' END AS split
            FROM (SELECT *, {hashed("CAST(o_orderkey AS VARCHAR)")} AS h FROM labelled)""",
    ),
    "split_orders_sizes": with_(
        ORDERS_SPLIT, "SELECT split, filled, count(*) AS row_count FROM assigned GROUP BY ALL"
    ),
    "split_customers": with_(CUSTOMERS_SPLIT, "SELECT customer_id, churn, split FROM assigned"),
    "scaler_fit": with_(
        CUSTOMERS_SPLIT + ", train AS (SELECT * FROM assigned WHERE split = 'training')",
        scaler_sql("train", FEATURES),
    ),
    "scaler_fit_lineitem": with_(LINES, scaler_sql("lines", LINE_FEATURES)),
    "standardize": with_(
        CUSTOMERS_SPLIT
        + ","
        + statistics_table("stats", "(SELECT * FROM assigned WHERE split = 'training')", FEATURES),
        "SELECT customer_id, "
        + join(
            f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 6) AS {c}"
            for c in FEATURES
        )
        + ", churn, dataset FROM features, stats",
    ),
    "label_rates": with_(
        FEATURED,
        """SELECT dataset, count(*) AS row_count, round(avg(churn), 9) AS rate
           FROM features GROUP BY dataset""",
    ),
    "customer_profile": with_(
        FEATURED + "," + profile_tables("features", FEATURES, "churn"),
        f"""SELECT dataset, feature, row_count, {significant("mean")} AS mean,
                  {significant("std")} AS std, round(correlation, 9) AS correlation
            FROM profile""",
    ),
    "label_correlations": with_(
        FEATURED + "," + profile_tables("features", FEATURES, "churn"),
        "SELECT dataset, feature, round(correlation, 9) AS correlation FROM profile",
    ),
    "shift_customers": with_(CUSTOMER_REPORT, rounded_report("churn")),
    "shift_customers_top10": with_(
        CUSTOMER_REPORT,
        """SELECT feature, round(train_correlation_with_churn, 9) AS train_correlation_with_churn,
                  round(test_correlation_with_churn, 9) AS test_correlation_with_churn,
                  round(correlation_change, 9) AS correlation_change
           FROM report ORDER BY round(absolute_correlation_change, 12) DESC NULLS LAST, feature
           LIMIT 10""",
    ),
    "shift_lineitem": with_(LINE_REPORT, rounded_report("returned")),
    "shift_stored_profiles": with_(LINE_REPORT, rounded_report("returned")),
    "mlp_score": with_(
        CUSTOMER_SCORES,
        """SELECT customer_id, churn, dataset, round(logit, 6) AS logit,
                  round(probability, 6) AS probability, prediction, round(loss, 6) AS loss
           FROM scored""",
    ),
    "mlp_score_lineitem": with_(
        LINE_NETWORK,
        f"""SELECT {join(_LINE_KEYS)}, round(logit, 6) AS logit,
                  round(probability, 6) AS probability, prediction, round(loss, 6) AS loss
           FROM scored""",
    ),
    "prediction_rates": with_(
        CUSTOMER_SCORES,
        """SELECT dataset, round(avg(churn), 9) AS actual_rate,
                  round(avg(prediction), 9) AS predicted_rate FROM scored GROUP BY dataset""",
    ),
    "confusion_lineitem": with_(
        LINE_SCORES,
        f"""SELECT l_linestatus, {counts("returned", "prediction")}
            FROM scores GROUP BY l_linestatus""",
    ),
    "threshold_metrics_lineitem": with_(
        LINE_SCORES,
        f"""SELECT *, {join(f"round({v}, 9) AS {k}" for k, v in THRESHOLD.items())}
            FROM (SELECT l_linestatus, {counts("returned", "prediction")}
                  FROM scores GROUP BY l_linestatus)""",
    ),
    "balanced_accuracy_lineitem": with_(
        LINE_SCORES,
        f"""SELECT l_linestatus, round({BALANCED}, 9) AS balanced_accuracy
            FROM (SELECT l_linestatus, {counts("returned", "prediction")}
                  FROM scores GROUP BY l_linestatus)""",
    ),
    "roc_auc_events": with_(
        EVENT_SCORES + "," + ranking_tables("scores", "1", "score", "error"),
        "SELECT round(roc_auc, 9) AS roc_auc FROM ranking",
    ),
    "average_precision_events": with_(
        EVENT_SCORES + "," + ranking_tables("scores", "1", "score", "error"),
        "SELECT round(average_precision, 9) AS average_precision FROM ranking",
    ),
    "ranking_lineitem": with_(
        """source AS (SELECT l_linestatus, l_extendedprice,
             CASE WHEN l_quantity * (1 - l_discount) > 25 THEN 1 ELSE 0 END AS large
           FROM lineitem),"""
        + ranking_tables("source", "l_linestatus", "l_extendedprice", "large"),
        """SELECT g AS l_linestatus, round(roc_auc, 9) AS roc_auc,
                  round(average_precision, 9) AS average_precision FROM ranking""",
    ),
    "bce_loss": with_(
        LINE_SCORES,
        f"""SELECT l_linestatus, round(avg({cross_entropy("logit", "returned")}), 9) AS loss
            FROM scores GROUP BY l_linestatus""",
    ),
    "evaluation_lineitem": with_(LINE_EVALUATION, rounded_evaluation("l_linestatus")),
    "evaluation_customers": with_(
        CUSTOMER_SCORES + "," + evaluation_sql("scored", "dataset", "churn"),
        rounded_evaluation("dataset"),
    ),
    "best_epoch_lineitem": with_(
        LINE_SCORES
        + f""",
history AS (
  SELECT l_linestatus, epoch, {THRESHOLD["f1"]} AS f1
  FROM (SELECT l_linestatus, l_linenumber AS epoch, {counts("large", "prediction")}
        FROM scores GROUP BY ALL))""",
        """SELECT l_linestatus, epoch AS best_epoch, round(f1, 9) AS best_f1
           FROM (SELECT *, row_number() OVER (PARTITION BY l_linestatus
                                              ORDER BY f1 DESC, epoch) AS place FROM history)
           WHERE place = 1""",
    ),
    "metrics_flatten": with_(
        LINE_EVALUATION,
        "\nUNION ALL\n".join(
            f"SELECT 'run-1' AS run_id, l_linestatus || '_{m}' AS key, round({m}, 9) AS value "
            "FROM evaluated"
            for m in METRICS
        ),
    ),
    "run_parameters": with_(
        ORDERS_SPLIT,
        "SELECT 'run-1' AS run_id, split || '_rows' AS key, CAST(count(*) AS VARCHAR) AS value "
        "FROM assigned GROUP BY split UNION ALL VALUES "
        + join(f"('run-1', '{k}', '{v}')" for k, v in _PARAMETERS.items()),
    ),
    "run_tags_customers": with_(
        CUSTOMER_REPORT,
        """SELECT 'run-1' AS run_id, 'distribution_shift_detected' AS key,
                  CASE WHEN max(absolute_correlation_change) > 0.1 THEN 'true' ELSE 'false' END
                    AS value FROM report
           UNION ALL VALUES ('run-1', 'task', 'binary_classification'),
                            ('run-1', 'target', 'customer_churn')""",
    ),
}
MONTHLY = """
orders_monthly AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS month, o_totalprice,
         CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS urgent,
         CAST(day(o_orderdate) AS DOUBLE) AS day,
         CASE WHEN o_orderstatus = 'F' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS filled
  FROM orders),
first_year AS (SELECT * FROM orders_monthly WHERE month < '1996')"""
_MONTHLY = ["o_totalprice", "urgent", "day"]
DAILY = """
daily AS (
  SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, ts, value, CAST(hour(ts) AS DOUBLE) AS hour,
         CASE WHEN event_type = 'error' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS error
  FROM events),
week AS (
  SELECT * FROM daily
  WHERE CAST(day AS DATE) < (SELECT min(CAST(day AS DATE)) + 7 FROM daily)),
closed AS (
  SELECT * FROM daily
  WHERE CAST(day AS DATE) + INTERVAL 1 DAY <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 DAY FROM daily))"""
_DAILY = ["value", "hour"]
ORACLES["drift_profile_merged"] = ORACLES["customer_profile"]
ORACLES["drift_monitor"] = with_(
    MONTHLY
    + ","
    + profile_tables("orders_monthly", _MONTHLY, "filled", "month")
    + ","
    + profile_tables("first_year", _MONTHLY, "filled", "'x' AS x", "known"),
    drift_sql("month", "filled"),
)
ORACLES["stream_drift_daily"] = with_(
    DAILY
    + ","
    + profile_tables("closed", _DAILY, "error", "day")
    + ","
    + profile_tables("week", _DAILY, "error", "'x' AS x", "known"),
    drift_sql("day", "error"),
)


def running_counts(source: str, by: str, score: str, label: str) -> str:
    """``running``: global running counts of each distinct score, and the totals of its group."""
    return f"""
by_score AS (
  SELECT {by} AS g, {score} AS s, sum({label}) AS p, sum(1 - {label}) AS n FROM {source} GROUP BY ALL),
running AS (
  SELECT g, s, CAST(sum(p) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER w AS BIGINT) AS fp,
         CAST(sum(p) OVER (PARTITION BY g) AS BIGINT) AS pos,
         CAST(sum(n) OVER (PARTITION BY g) AS BIGINT) AS neg
  FROM by_score WINDOW w AS (PARTITION BY g ORDER BY s DESC))"""


def best_sql(source: str, by: str, score: str, label: str) -> str:
    """``best``: of each group the score with the highest F1, the higher one on ties."""
    return running_counts(source, by, score, label) + """,
best AS (
  SELECT *, neg - fp AS tn, pos - tp AS fn FROM (
    SELECT *, row_number() OVER (
      PARTITION BY g ORDER BY CAST(2 * tp AS DOUBLE) / (tp + fp + pos) DESC, s DESC) AS place
    FROM running) WHERE place = 1)"""


ORACLES["best_threshold_lineitem"] = with_(
    LINE_SCORES + "," + best_sql("scores", "l_linestatus", "logit", "large"),
    f"""SELECT g AS l_linestatus, round(s, 9) AS threshold, pos AS positives, neg AS negatives,
               tn, fp, fn, tp, {join(f"round({v}, 9) AS {k}" for k, v in THRESHOLD.items())}
        FROM best""",
)
ORACLES["mlp_score_tuned"] = with_(
    CUSTOMER_SCORES
    + """,
known AS (SELECT 1 AS one, round(probability, 6) AS probability, CAST(churn AS INT) AS churn
          FROM scored WHERE dataset = 'train'),"""
    + best_sql("known", "one", "probability", "churn"),
    """SELECT customer_id, dataset, churn,
              CAST(CASE WHEN probability >= (SELECT s FROM best) THEN 1 ELSE 0 END AS INT) AS prediction
       FROM scored""",
)
CURVE = (
    EVENT_SCORES
    + ","
    + running_counts("scores", "1", "score", "error")
    + """,
cells AS (
  SELECT *, row_number() OVER (PARTITION BY tp * 50 // pos, fp * 50 // neg ORDER BY tp + fp) AS low,
         row_number() OVER (PARTITION BY tp * 50 // pos, fp * 50 // neg ORDER BY tp + fp DESC) AS high
  FROM running),
points AS (
  SELECT s, tp, fp, pos, neg FROM cells WHERE low = 1 OR high = 1
  UNION ALL SELECT NULL, 0, 0, max(pos), max(neg) FROM running),
curve AS (
  SELECT CAST(row_number() OVER (ORDER BY tp + fp) - 1 AS INT) AS point, s AS threshold,
         neg - fp AS tn, fp, pos - tp AS fn, tp, fp / neg AS fpr, tp / pos AS tpr,
         CASE WHEN tp + fp = 0 THEN 1 ELSE tp / (tp + fp) END AS prec FROM points)"""
)
ORACLES["roc_points_events"] = with_(
    CURVE,
    """SELECT point, round(threshold, 9) AS threshold, tn, fp, fn, tp,
              round(fpr, 9) AS false_positive_rate, round(tpr, 9) AS true_positive_rate FROM curve""",
)
ORACLES["pr_points_events"] = with_(
    CURVE,
    """SELECT point, round(threshold, 9) AS threshold, round(prec, 9) AS "precision",
              round(tpr, 9) AS recall FROM curve""",
)
ORACLES["mlp_score_sql"] = ORACLES["mlp_score"]
ORACLES["mlp_score_saved"] = ORACLES["mlp_score"]
ORACLES["features_limited_files"] = ORACLES["features"]
ORACLES["shift_report_csv"] = ORACLES["shift_customers"]
ORACLES["verified_rows"] = f"""
SELECT 'clean' AS stage, count(*) AS row_count FROM ({ORACLES["clean_customers"]})
UNION ALL SELECT 'features', count(*) FROM ({ORACLES["features"]})"""
ORACLES["metrics_document_json"] = f"""
SELECT CASE WHEN l_linestatus = 'F' THEN 'validation' ELSE 'internal_test' END AS split, {join(METRICS)}
FROM ({ORACLES["evaluation_lineitem"]})
UNION ALL SELECT 'external_test', {join("CAST(NULL AS DOUBLE)" for _ in METRICS)}"""
COMPOSITE = """
labelled AS (
  SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INT) AS filled,
         CASE WHEN o_orderkey % 5 > 0 THEN 'a\\:' || o_orderpriority ELSE '\\N' END
           || ':b\\:' || o_orderkey AS name
  FROM orders)"""
ORACLES["split_composite_keys"] = with_(
    COMPOSITE + "," + split_tables("labelled", "name", "filled"),
    "SELECT o_orderkey, filled, split FROM assigned",
)


def learned(known: str, external: str, label: str) -> str:
    """Rows and positives of the evaluated splits, by quota; that the model learns is expected."""
    return f"""
SELECT split, count(*) AS row_count, CAST(sum(y) AS BIGINT) AS positives, TRUE AS learned FROM (
  SELECT split, {label} AS y FROM {known} WHERE split <> 'training'
  UNION ALL SELECT 'external_test', {label} FROM {external}) GROUP BY split"""


ORACLES["train_mlp"] = with_(
    CUSTOMERS_SPLIT,
    learned("assigned", "(SELECT * FROM features WHERE dataset = 'external')", "churn"),
)
LARGE = LINES + """,
marked AS (
  SELECT *, row_number() OVER () AS line,
         CASE WHEN l_quantity * (1 - l_discount) > 25 THEN 1 ELSE 0 END AS target FROM lines),
known_lines AS (SELECT * FROM marked WHERE dataset = 'train')"""
ORACLES["train_mlp_lineitem"] = with_(
    LARGE + "," + split_tables("known_lines", "line", "target"),
    learned("assigned", "(SELECT * FROM marked WHERE dataset = 'external')", "target"),
)
ORACLES["training_shards"] = with_(
    LARGE,
    "SELECT count(*) AS row_count, CAST(32 AS BIGINT) AS parts, CAST(sum(target) AS BIGINT) AS positives, "
    + join(f"CAST(0 AS DOUBLE) AS mean_{c}" for c in LINE_FEATURES)
    + " FROM known_lines",
)


def gradient_sql(source: str, features: list[str], scaler: str, label: str) -> str:
    """Forward and backward pass of the rule model written out, one mean per parameter."""
    widths = (len(features), 32, 16, 1)

    def weight(depth: int, i: int, j: int) -> str:
        return f"CAST({((i * 7 + j * 3 + depth) % 11 - 5) / 10} AS DOUBLE)"

    names = [[f"z_{c}" for c in features], [f"a{j}" for j in range(32)], [f"b{j}" for j in range(16)], ["logit"]]
    scaled = join(
        f"({c} - {scaler}.m_{c}) / CASE WHEN {scaler}.s_{c} = 0 THEN 1 ELSE {scaler}.s_{c} END AS z_{c}"
        for c in features
    )
    steps = [f"pass0 AS (SELECT {scaled}, {label} AS y FROM {source}, {scaler})"]
    for depth in range(3):
        units = []
        for j, out in enumerate(names[depth + 1]):
            terms = [f"{c} * {weight(depth, i, j)}" for i, c in enumerate(names[depth])]
            total = " + ".join([*terms, weight(depth, widths[depth], j)])
            units.append(f"{total} AS {out}" if depth == 2 else f"greatest({total}, 0) AS {out}")
        steps.append(f"pass{depth + 1} AS (SELECT *, {join(units)} FROM pass{depth})")
    steps.append(f"back2 AS (SELECT *, {sigmoid('logit')} - y AS d2_0 FROM pass3)")
    for depth in (1, 0):
        errors = [
            f"CASE WHEN {name} > 0 THEN "
            + " + ".join(f"d{depth + 1}_{k} * {weight(depth + 1, j, k)}" for k in range(widths[depth + 2]))
            + f" ELSE 0 END AS d{depth}_{j}"
            for j, name in enumerate(names[depth + 1])
        ]
        steps.append(f"back{depth} AS (SELECT *, {join(errors)} FROM back{depth + 1})")
    places = [
        (depth, i, j) for depth in range(3) for i in range(widths[depth] + 1) for j in range(widths[depth + 1])
    ]
    means = join(
        f"avg(d{d}_{j}{f' * {names[d][i]}' if i < widths[d] else ''}) AS g{n}"
        for n, (d, i, j) in enumerate(places)
    )
    steps.append(f"sums AS (SELECT {means} FROM back0)")
    columns = [
        f"unnest([{join(str(p[k]) for p in places)}]) AS {name}" for k, name in enumerate(("layer", "row", "col"))
    ]
    gradients = f"unnest([{join(f'g{n}' for n in range(len(places)))}])"
    return with_(
        FEATURED
        + ","
        + statistics_table(scaler, "(SELECT * FROM features WHERE dataset = 'train')", features, 3)
        + ","
        + ",\n".join(steps),
        f"SELECT {join(columns)}, round({gradients}, 9) AS gradient FROM sums",
    )


ORACLES["mlp_gradient"] = gradient_sql("features", FEATURES, "stats", "churn")


def linear_logit(epoch: int) -> str:
    terms = [
        f"(({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END) * {((i * 7 + epoch * 3) % 11 - 5) / 10}"
        for i, c in enumerate(LINE_FEATURES)
    ]
    return " + ".join([*terms, str(((len(LINE_FEATURES) * 7 + epoch * 3) % 11 - 5) / 10)])


ORACLES["epoch_ranking"] = with_(
    LINES
    + ","
    + statistics_table("stats", "lines", LINE_FEATURES, 3)
    + ", scored AS ("
    + " UNION ALL ".join(
        f"SELECT CAST({e} AS INT) AS epoch, round({linear_logit(e)}, 6) AS logit, large FROM lines, stats"
        for e in (1, 2, 3)
    )
    + "),"
    + ranking_tables("scored", "epoch", "logit", "large"),
    """SELECT g AS epoch, round(roc_auc, 9) AS roc_auc, round(average_precision, 9) AS average_precision
       FROM ranking""",
)
ORACLES["epoch_table"] = with_(
    LARGE,
    """SELECT CAST(unnest([1, 2, 3]) AS INT) AS epoch, row_count, positives, TRUE AS learned, TRUE AS precise
       FROM (SELECT count(*) AS row_count, CAST(sum(target) AS BIGINT) AS positives
             FROM marked WHERE dataset = 'external')""",
)
ORACLES["verified_replacement"] = ORACLES["features"]
ORACLES["ingest_report"] = with_(
    CLEANED,
    """SELECT r.dataset, r.n AS raw_rows, coalesce(c.n, 0) AS cleaned_rows,
              r.n - coalesce(c.n, 0) AS removed_rows, coalesce(c.n, 0) AS verified_rows,
              coalesce(c.n, 0) AS feature_rows, coalesce(c.n, 0) AS verified_features,
              CAST(0 AS BIGINT) AS null_rows
       FROM (SELECT dataset, count(*) AS n FROM raw GROUP BY dataset) r
       LEFT JOIN (SELECT dataset, count(*) AS n FROM cleaned GROUP BY dataset) c
         ON r.dataset = c.dataset""",
)
ORACLES["shift_display"] = with_(
    CUSTOMER_REPORT,
    """SELECT feature, round(train_correlation_with_churn, 4) AS train_correlation_with_churn,
              round(test_correlation_with_churn, 4) AS test_correlation_with_churn,
              round(correlation_change, 4) AS correlation_change
       FROM report ORDER BY round(absolute_correlation_change, 12) DESC NULLS LAST, feature
       LIMIT 10""",
)
