"""Expected results as SQL, written independently of the Spark plans."""

from __future__ import annotations

from txwarden.checks import model_sql
from txwarden.checks.queries import BOXED, CORRELATED

# Transactions, reports and events shaped from the order tables.
VIEWS = """
lines AS (SELECT l_orderkey AS k, min(l_suppkey) AS s, min(l_partkey) AS p
          FROM lineitem GROUP BY l_orderkey),
tx AS (SELECT o_orderkey AS eventId, o_custkey AS accountNumber, lines.s AS merchantId,
              p_brand AS mcc, n_name AS merchantCountry,
              CAST(s_nationkey AS VARCHAR) AS merchantZip, o_orderpriority AS posEntryMode,
              o_totalprice AS transactionAmount, c_acctbal AS availableCash,
              o_orderdate AS transactionTime
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey
       LEFT JOIN lines ON lines.k = o_orderkey
       LEFT JOIN supplier ON s_suppkey = lines.s
       LEFT JOIN nation ON n_nationkey = s_nationkey
       LEFT JOIN part ON p_partkey = lines.p),
reports AS (SELECT l_orderkey AS eventId, min(l_shipdate) AS reportedTime
            FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1 GROUP BY l_orderkey),
labelled AS (SELECT tx.*, reports.reportedTime,
                    date_diff('microsecond', transactionTime, reportedTime) / 3.6e9
                        AS reported_delay,
                    CAST(reportedTime IS NOT NULL AS INTEGER) AS Fraud,
                    CAST(month(transactionTime) AS INTEGER) AS month
             FROM tx LEFT JOIN reports ON tx.eventId IS NOT DISTINCT FROM reports.eventId),
ev AS (SELECT event_id AS eventId, user_id AS accountNumber,
              json_extract_string(props, '$.k') AS merchantId, event_type AS mcc,
              event_type AS posEntryMode, value AS transactionAmount, ts AS transactionTime
       FROM events)
"""


def _with(body: str, *more: str) -> str:
    return "WITH " + ",\n".join([VIEWS.strip(), *[m.strip() for m in more]]) + "\n" + body.strip()


def _int(expression: str, name: str) -> str:
    return f"CAST({expression} AS INTEGER) AS {name}"


def _flag(condition: str, name: str) -> str:
    return f"CAST(coalesce({condition}, false) AS INTEGER) AS {name}"


ENTRY_MODES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
BANDS = ", ".join(
    [
        _flag("h >= 6 AND h < 12", "hour_morning"),
        _flag("h >= 12 AND h < 18", "hour_afternoon"),
        _flag("h >= 18 AND h <= 23", "hour_evening"),
        _flag("h >= 0 AND h < 6", "hour_night"),
    ]
)


def _date_parts(time: str = "transactionTime") -> str:
    return ", ".join(
        [
            _int(f"hour({time})", "hour"),
            _int(f"day({time})", "day"),
            _int(f"month({time})", "month"),
            _int(f"isodow({time}) - 1", "weekday"),
            _flag(f"isodow({time}) IN (6, 7)", "is_weekend"),
        ]
    )


def _count_over(keys: str, guard: str, name: str) -> str:
    return f"CASE WHEN {guard} THEN count(*) OVER (PARTITION BY {keys}) END AS {name}"


GAP = """CASE WHEN accountNumber IS NOT NULL THEN date_diff('microsecond',
    lag(transactionTime) OVER (PARTITION BY accountNumber ORDER BY transactionTime, eventId),
    transactionTime) / 1e6 END"""


def _quartiles(table: str, columns: tuple[str, ...]) -> str:
    cells = ", ".join(
        f"quantile_cont({c}, 0.25) AS {c}_a, quantile_cont({c}, 0.5) AS {c}_m, "
        f"quantile_cont({c}, 0.75) AS {c}_b"
        for c in columns
    )
    return f"q AS (SELECT {cells} FROM {table})"


def _scaled(c: str) -> str:
    return f"({c} - {c}_m) / CASE WHEN {c}_b = {c}_a THEN 1 ELSE {c}_b - {c}_a END"


def _missing_report() -> str:
    columns = [
        "eventId", "accountNumber", "merchantId", "mcc", "merchantCountry", "merchantZip",
        "posEntryMode", "transactionAmount", "availableCash", "transactionTime",
        "accountNumber_freq", "merchantId_freq", "mcc_freq", "hour", "day", "month", "weekday",
        "is_weekend", "hour_morning", "hour_afternoon", "hour_evening", "hour_night",
    ]
    source = {
        "accountNumber_freq": "accountNumber", "merchantId_freq": "merchantId", "mcc_freq": "mcc",
        "hour": "transactionTime", "day": "transactionTime", "month": "transactionTime",
        "weekday": "transactionTime",
    }
    never = {"is_weekend", "hour_morning", "hour_afternoon", "hour_evening", "hour_night"}
    parts = [
        f"SELECT '{c}' AS \"column\", "
        + ("0" if c in never else f"count(*) - count({source.get(c, c)})")
        + " AS total, count(*) AS n FROM tx"
        for c in columns
    ]
    union = " UNION ALL ".join(parts)
    return f"""SELECT "column", CAST(total AS BIGINT) AS total,
        round(CAST(total AS DOUBLE) / n * 100, 6) AS percent FROM ({union})"""


def _correlations(table: str, columns: tuple[str, ...]) -> str:
    def pair(a: str, b: str) -> str:
        both = f'"{a}" IS NOT NULL AND "{b}" IS NOT NULL'
        constant = " OR ".join(
            f'coalesce(min("{c}") FILTER ({both}) = max("{c}") FILTER ({both}), true)'
            for c in (a, b)
        )
        return (
            f"SELECT '{a}' AS col_a, '{b}' AS col_b, CASE WHEN {constant} THEN NULL "
            f'ELSE round(corr("{a}"::DOUBLE, "{b}"::DOUBLE), 6) END AS corr FROM {table}'
        )

    return " UNION ALL ".join(pair(a, b) for a in columns for b in columns)


def _boxes(table: str, features: tuple[str, ...]) -> str:
    long = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, Fraud, CAST({f} AS DOUBLE) AS v FROM {table} "
        f"WHERE {f} IS NOT NULL"
        for f in features
    )
    return f"""
, long AS ({long}),
box AS (SELECT feature, Fraud, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
               quantile_cont(v, 0.75) AS q3 FROM long GROUP BY feature, Fraud)
SELECT feature, Fraud, count(*) AS rows, round(any_value(q1), 6) AS q1,
       round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
       round(least(coalesce(min(v) FILTER (v >= q1 - 1.5 * (q3 - q1)), any_value(q1)),
                   any_value(q1)), 6) AS whisker_low,
       round(greatest(coalesce(max(v) FILTER (v <= q3 + 1.5 * (q3 - q1)), any_value(q3)),
                      any_value(q3)), 6) AS whisker_high,
       count(*) FILTER (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outliers
FROM long JOIN box USING (feature, Fraud) GROUP BY feature, Fraud"""


def _quantiles_by(key: str) -> str:
    return _with(
        f"""SELECT {key}, count(*) AS rows, round(min(transactionAmount), 6) AS minimum,
            round(max(transactionAmount), 6) AS maximum,
            round(quantile_cont(transactionAmount, 0.25), 6) AS q1,
            round(quantile_cont(transactionAmount, 0.5), 6) AS median,
            round(quantile_cont(transactionAmount, 0.75), 6) AS q3
        FROM tx WHERE transactionAmount IS NOT NULL GROUP BY {key}"""
    )


def _before(key: str, count: str, total: str) -> str:
    over = (
        f"OVER (PARTITION BY {key} ORDER BY transactionTime, eventId "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    )
    return (
        f"CASE WHEN {key} IS NOT NULL THEN count(*) {over} END AS {count}, CASE WHEN {key} IS NOT NULL "
        f"THEN round(sum(transactionAmount) {over}, 2) END AS {total}"
    )


RANKED = """
ranked AS (SELECT eventId, month, Fraud, transactionAmount, -transactionAmount AS score,
                  row_number() OVER (PARTITION BY month ORDER BY -transactionAmount, eventId)
                      AS review_rank
           FROM labelled)
"""
RESULTS = """
results AS (SELECT month,
    coalesce(CAST(tp AS DOUBLE) / flagged, 0) AS precision,
    coalesce(2.0 * tp / (tp + flagged), 0) AS f1_score,
    tp AS true_frauds_flagged, frauds AS true_frauds,
    coalesce(saved, 0) AS amount_saved, coalesce(potential, 0) AS potential_amount_saved
  FROM (SELECT month, count(*) FILTER (review_rank <= 400) AS flagged,
               count(*) FILTER (review_rank <= 400 AND Fraud = 1) AS tp,
               count(*) FILTER (Fraud = 1) AS frauds,
               sum(transactionAmount) FILTER (review_rank <= 400 AND Fraud = 1) AS saved,
               sum(transactionAmount) FILTER (Fraud = 1) AS potential
        FROM ranked GROUP BY month))
"""
ROUNDED_RESULTS = """SELECT month, round(precision, 6) AS precision, round(f1_score, 6) AS f1_score,
    true_frauds_flagged, true_frauds, round(amount_saved, 2) AS amount_saved,
    round(potential_amount_saved, 2) AS potential_amount_saved FROM results"""

FOLDED = """
folded AS (SELECT eventId, month, Fraud, transactionAmount,
                  CAST((row_number() OVER (PARTITION BY month, Fraud
                        ORDER BY md5('42|' || eventId)) - 1) % 5 AS INTEGER) AS fold,
                  transactionAmount / 500000.0 AS probability
           FROM labelled)
"""
DECIDED = """
scored AS (SELECT eventId, month, -transactionAmount / 500000.0 AS anomaly,
                  availableCash / 20000.0 + 0.1 AS probability FROM labelled),
decided AS (SELECT scored.*, anomaly - cut AS decision
            FROM scored JOIN (SELECT month, quantile_cont(anomaly, 0.1) AS cut
                              FROM scored GROUP BY month) USING (month))
"""

CLASSES = """
points AS MATERIALIZED (SELECT month, id AS row_id, Fraud AS label, f FROM matrix),
sizes AS (SELECT month, count(*) FILTER (label = 1) AS ones, count(*) FILTER (label = 0) AS zeros
          FROM points GROUP BY month)
"""
# In every month label 1 is the rarer class of this data; the last column checks it.
ADASYN = """
near AS (SELECT a.month, a.row_id AS parent, b.label,
                row_number() OVER (PARTITION BY a.month, a.row_id ORDER BY list_distance(a.f, b.f), b.row_id) AS rn
         FROM points a JOIN points b ON a.month = b.month AND a.row_id <> b.row_id
         JOIN sizes ON sizes.month = a.month
         WHERE a.label = 1 AND ones < zeros AND ones > 5),
share AS (SELECT month, parent, count(*) FILTER (label = 0) / 5.0 AS r
          FROM near WHERE rn <= 5 GROUP BY month, parent),
born AS MATERIALIZED (
         SELECT month, parent,
                CAST(round_even(r / sum(r) OVER (PARTITION BY month) * (zeros - ones), 0)
                     AS BIGINT) AS new_rows
         FROM share JOIN sizes USING (month))
"""
SYNTHETIC = """
mates AS MATERIALIZED (
    SELECT month, parent, rn, f FROM (
        SELECT a.month, a.row_id AS parent, b.f,
               row_number() OVER (PARTITION BY a.month, a.row_id ORDER BY list_distance(a.f, b.f), b.row_id) AS rn
        FROM points a JOIN points b ON a.month = b.month AND a.row_id <> b.row_id AND b.label = 1
        WHERE a.label = 1)
    WHERE rn <= 5),
drawn AS (
    SELECT month, parent, i, md5('42|' || month || '|' || parent || '|' || i) AS m
    FROM (SELECT month, parent, unnest(range(1, new_rows + 1)) AS i FROM born WHERE new_rows > 0)),
synthetic AS (
    SELECT d.month, 's' || d.parent || '-' || i AS row_id,
           ('0x' || substr(m, 14, 13))::BIGINT::DOUBLE / 4503599627370496::DOUBLE AS u, p.f AS a, mates.f AS b
    FROM drawn d JOIN points p ON p.month = d.month AND p.row_id = d.parent
    JOIN mates ON mates.month = d.month AND mates.parent = d.parent
        AND mates.rn = 1 + ('0x' || substr(m, 1, 13))::BIGINT % 5),
moved AS (SELECT month, row_id, list_transform(range(1, len(a) + 1), lambda i: a[i] + u * (b[i] - a[i])) AS f
          FROM synthetic)
"""
NEAR_MISS = """
near AS (SELECT a.month, a.row_id, list_distance(a.f, b.f) AS d,
                row_number() OVER (PARTITION BY a.month, a.row_id ORDER BY list_distance(a.f, b.f), b.row_id) AS rn
         FROM points a JOIN points b ON a.month = b.month AND b.label = 1
         WHERE a.label = 0),
mean AS (SELECT month, row_id, sum(d) / count(*) AS m FROM near WHERE rn <= 3
         GROUP BY month, row_id),
placed AS (SELECT mean.*, row_number() OVER (PARTITION BY month
               ORDER BY m, md5('42|' || row_id)) AS place FROM mean),
kept AS (SELECT month, row_id, 0 AS label FROM placed JOIN sizes USING (month)
         WHERE place <= ones
         UNION ALL SELECT month, row_id, label FROM points WHERE label = 1)
"""

FEATURE_KEYS = ("accountNumber_freq", "merchantId_freq", "mcc_freq")
SCALED = ("transactionAmount", "availableCash", *FEATURE_KEYS, "cash_pct_spent")
BASE_FEATURES = f"""
base AS (SELECT labelled.*,
    {_count_over("accountNumber", "accountNumber IS NOT NULL", "accountNumber_freq")},
    {_count_over("merchantId", "merchantId IS NOT NULL", "merchantId_freq")},
    {_count_over("mcc", "mcc IS NOT NULL", "mcc_freq")},
    transactionAmount / nullif(availableCash, 0) AS cash_pct_spent,
    {_count_over("accountNumber, date_trunc('day', transactionTime)",
                 "accountNumber IS NOT NULL", "velocity")},
    {_count_over("accountNumber, mcc", "accountNumber IS NOT NULL AND mcc IS NOT NULL", "pair")},
    {GAP} AS gap
  FROM labelled),
{_quartiles("base", SCALED)},
scaled AS (SELECT eventId, {", ".join(f"{_scaled(c)} AS {c}" for c in SCALED)},
    merchantCountry, transactionTime, posEntryMode, velocity, pair, gap, reported_delay, Fraud,
    base.transactionAmount AS transactionAmount_original
  FROM base CROSS JOIN q),
features AS (SELECT eventId, {", ".join(SCALED)},
    {_int("day(transactionTime)", "day")}, {_int("month(transactionTime)", "month")},
    {_flag("isodow(transactionTime) IN (6, 7)", "is_weekend")},
    {BANDS.replace("h >", "hour(transactionTime) >").replace("h <", "hour(transactionTime) <")},
    {", ".join(_flag(f"isodow(transactionTime) - 1 = {d}", f"weekday_{d}") for d in range(7))},
    {", ".join(_flag(f"posEntryMode = '{m}'", f'"pos_{m}"') for m in ENTRY_MODES)},
    coalesce(velocity, 0) AS transaction_velocity,
    coalesce(pair, 0) AS merchant_category_frequency,
    coalesce(gap, 0.0) AS time_since_last_transaction,
    coalesce(reported_delay, 0.0) AS reported_delay, Fraud, transactionAmount_original,
    CASE WHEN merchantCountry IS NOT NULL THEN
        avg(transactionAmount) OVER (PARTITION BY merchantCountry) END
        AS avg_transaction_amount_by_country,
    avg(transactionAmount) OVER (PARTITION BY hour(transactionTime))
        AS avg_transaction_amount_by_hour
  FROM scaled)
"""
FEATURE_COLUMNS = (
    *SCALED, "day", "month", "is_weekend", "hour_morning", "hour_afternoon", "hour_evening",
    "hour_night", *[f"weekday_{d}" for d in range(7)], *[f"pos_{m}" for m in ENTRY_MODES],
    "transaction_velocity", "merchant_category_frequency", "time_since_last_transaction",
    "reported_delay", "Fraud", "transactionAmount_original",
    "avg_transaction_amount_by_country", "avg_transaction_amount_by_hour",
)
FEATURES_ROUNDED = (
    *SCALED, "reported_delay", "avg_transaction_amount_by_country",
    "avg_transaction_amount_by_hour",
)

# Features of the models: all columns of the feature table but the label and what tells it.
MATRIX_COLUMNS = sorted(
    set(FEATURE_COLUMNS) - {"reported_delay", "Fraud", "transactionAmount_original"}
)
MATRIX = model_sql.matrix(MATRIX_COLUMNS)
FOREST = model_sql.forest(len(MATRIX_COLUMNS))
YEAR_MONTHS = """
dated AS (SELECT *, CAST(year(transactionTime) * 100 + month(transactionTime) AS INTEGER) AS year_month
          FROM labelled)
"""
YEAR_MONTH_MATRIX = model_sql.matrix(
    MATRIX_COLUMNS, "year_month", "features JOIN (SELECT eventId, year_month FROM dated) USING (eventId)"
)
FOREST_RANKED = """
ranked AS (SELECT month, Fraud, amount AS transactionAmount,
                  row_number() OVER (PARTITION BY month ORDER BY decision, id) AS review_rank FROM decided)
"""

HISTOGRAM = """
d AS (SELECT reported_delay AS x FROM labelled WHERE reported_delay > 0),
s AS (SELECT count(*) AS n, min(x) AS lo, max(x) AS hi,
             2.0 * (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) / pow(count(*), 1.0 / 3)
                 AS fd,
             (max(x) - min(x)) / (log2(count(*)) + 1) AS sturges FROM d),
b AS (SELECT n, lo, hi, CAST(ceil((hi - lo) / CASE WHEN fd = 0 THEN sturges
             ELSE least(fd, sturges) END) AS BIGINT) AS bins FROM s),
c AS (SELECT least(CAST(floor((x - lo) / (hi - lo) * bins) AS BIGINT), bins - 1) AS bin,
             count(*) AS rows FROM d CROSS JOIN b GROUP BY 1)
SELECT g.bin, round(lo + g.bin * ((hi - lo) / bins), 6) AS left_edge,
       round(lo + (g.bin + 1) * ((hi - lo) / bins), 6) AS right_edge,
       coalesce(c.rows, 0) AS rows
FROM (SELECT unnest(generate_series(0, (SELECT bins - 1 FROM b))) AS bin) g
CROSS JOIN b LEFT JOIN c ON c.bin = g.bin
"""


def _slices() -> str:
    return " UNION ALL ".join(
        f"SELECT {m} AS scored_month, '{role}' AS role, count(*) AS rows, "
        f"round(sum(transactionAmount), 2) AS amount FROM labelled WHERE month = {source}"
        for m in range(2, 13)
        for role, source in (("current", m), ("previous", m - 1))
    )


VELOCITY_DAY = _count_over(
    "accountNumber, date_trunc('day', transactionTime)",
    "accountNumber IS NOT NULL",
    "transaction_velocity",
)

# Bins of five hours, counted from the midnight before the first event.
FIVE_HOURS = """SELECT eventId, count(*) OVER (PARTITION BY accountNumber, time_bucket(
    INTERVAL 5 HOURS, transactionTime, (SELECT date_trunc('day', min(transactionTime)) FROM ev)
        ::TIMESTAMP)) AS transaction_velocity FROM ev"""

ORACLES: dict[str, str] = {
    "tx_scan": _with("SELECT * REPLACE (CAST(transactionTime AS VARCHAR) AS transactionTime) FROM tx"),
    "labels_scan": _with("SELECT eventId, CAST(reportedTime AS VARCHAR) AS reportedTime FROM reports"),
    "ts_normalise": _with("SELECT eventId, CAST(transactionTime AS VARCHAR) AS transactionTime FROM ev"),
    "date_parts": _with(f"SELECT eventId, {_date_parts()} FROM tx"),
    "hour_bands": _with(
        f"SELECT eventId, CAST(h AS INTEGER) AS hour, {BANDS} "
        "FROM (SELECT eventId, hour(transactionTime) AS h FROM ev)"
    ),
    "one_hot_weekday": _with(
        "SELECT eventId, "
        + ", ".join(_flag(f"isodow(transactionTime) - 1 = {d}", f"weekday_{d}") for d in range(7))
        + " FROM tx"
    ),
    "one_hot_entry_mode": _with(
        "SELECT eventId, "
        + ", ".join(_flag(f"posEntryMode = '{m}'", f'"pos_{m}"') for m in ENTRY_MODES)
        + " FROM tx"
    ),
    "cash_share": _with(
        "SELECT eventId, round(transactionAmount / nullif(availableCash, 0), 6) AS cash_pct_spent "
        "FROM tx"
    ),
    "label_join": _with(
        "SELECT eventId, CAST(reportedTime AS VARCHAR) AS reportedTime, "
        "round(reported_delay, 6) AS reported_delay, Fraud FROM labelled"
    ),
    "robust_scale": _with(
        "SELECT eventId, "
        + ", ".join(
            f"round({_scaled(c)}, 6) AS {c}"
            for c in ("transactionAmount", "availableCash", "cash_pct_spent")
        )
        + ", t.transactionAmount AS transactionAmount_original FROM t CROSS JOIN q",
        "t AS (SELECT *, transactionAmount / nullif(availableCash, 0) AS cash_pct_spent FROM tx)",
        _quartiles("t", ("transactionAmount", "availableCash", "cash_pct_spent")),
    ),
    "fill_missing": _with(
        f"""SELECT eventId, coalesce(CASE WHEN transactionTime = date_trunc('day', transactionTime)
                AND accountNumber IS NOT NULL THEN count(*) OVER (PARTITION BY accountNumber,
                date_trunc('day', transactionTime)) END, 0) AS transaction_velocity,
            coalesce(CASE WHEN accountNumber IS NOT NULL AND mcc IS NOT NULL THEN
                count(*) OVER (PARTITION BY accountNumber, mcc) END, 0)
                AS merchant_category_frequency,
            coalesce({GAP}, 0.0) AS time_since_last_transaction,
            round(coalesce(reported_delay, 0.0), 6) AS reported_delay, mcc FROM labelled"""
    ),
    "drop_columns": _with(
        "SELECT eventId, accountNumber, transactionAmount, availableCash FROM tx"
    ),
    "month_slices": _with(_slices()),
    "key_frequency": _with(
        "SELECT eventId, "
        + ", ".join(
            _count_over(k, f"{k} IS NOT NULL", f"{k}_freq")
            for k in ("accountNumber", "merchantId", "mcc")
        )
        + " FROM tx"
    ),
    "velocity_bin": _with(f"SELECT eventId, {VELOCITY_DAY} FROM ev"),
    "velocity_six_hours": _with(
        "SELECT eventId, count(*) OVER (PARTITION BY accountNumber, "
        "time_bucket(INTERVAL 6 HOURS, transactionTime)) AS transaction_velocity FROM ev"
    ),
    "velocity_literal": _with(
        f"""SELECT eventId, CASE WHEN transactionTime = date_trunc('day', transactionTime)
            THEN transaction_velocity END AS transaction_velocity
        FROM (SELECT eventId, transactionTime, {VELOCITY_DAY}
              FROM (SELECT eventId, accountNumber, transactionTime FROM tx
                    UNION ALL SELECT -eventId - 1, accountNumber, transactionTime FROM ev))"""
    ),
    "velocity_trailing": _with(
        "SELECT eventId, count(*) OVER (PARTITION BY accountNumber ORDER BY transactionTime "
        "RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW) AS transaction_velocity FROM ev"
    ),
    "velocity_stream": _with(
        """SELECT accountNumber, CAST(date_trunc('day', transactionTime) AS TIMESTAMP)::VARCHAR
            AS window_start, count(*) AS transaction_velocity FROM ev
        GROUP BY accountNumber, date_trunc('day', transactionTime)
        HAVING date_trunc('day', transactionTime) + INTERVAL 1 DAY
            <= (SELECT max(transactionTime) FROM ev) - INTERVAL 1 HOUR"""
    ),
    "velocity_stream_all": _with(
        """SELECT accountNumber, CAST(date_trunc('day', transactionTime) AS TIMESTAMP)::VARCHAR
            AS window_start, count(*) AS transaction_velocity,
            CAST(date_trunc('day', transactionTime) + INTERVAL 1 DAY
                > (SELECT max(transactionTime) FROM ev) - INTERVAL 1 HOUR AS INTEGER) AS is_open
        FROM ev WHERE accountNumber IS NOT NULL
        GROUP BY accountNumber, date_trunc('day', transactionTime)"""
    ),
    "time_since_last_stream": _with(
        f"SELECT eventId, round({GAP}, 6) AS time_since_last_transaction FROM ev"
    ),
    "history_before": _with(
        "SELECT eventId, "
        + _before("accountNumber", "accountNumber_freq_before", "sum_amount_by_account_before")
        + ", "
        + _before("merchantCountry", "merchantCountry_freq_before", "sum_amount_by_country_before")
        + " FROM tx"
    ),
    "known_labels": _with(
        """SELECT eventId, month, Fraud, CAST(coalesce(reportedTime
            < date_trunc('month', transactionTime) + INTERVAL 1 MONTH, false) AS INTEGER) AS known_fraud
        FROM labelled"""
    ),
    "account_quantiles": _quantiles_by("accountNumber"),
    "merchant_quantiles_narrowed": _quantiles_by("merchantId"),
    "merged_sketch_ranks": _with(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count({c}) AS rows, round(min({c}), 6) AS minimum,
            round(max({c}), 6) AS maximum, 1 AS within_error FROM labelled HAVING count({c}) > 0"""
            for c in BOXED
        )
    ),
    "merchant_category_frequency": _with(
        "SELECT eventId, "
        + _count_over(
            "accountNumber, mcc",
            "accountNumber IS NOT NULL AND mcc IS NOT NULL",
            "merchant_category_frequency",
        )
        + " FROM tx"
    ),
    "avg_amount_country_hour": _with(
        """SELECT eventId, round(CASE WHEN merchantCountry IS NOT NULL THEN
            avg(transactionAmount) OVER (PARTITION BY merchantCountry) END, 4)
            AS avg_transaction_amount_by_country,
            round(avg(transactionAmount) OVER (PARTITION BY hour(transactionTime)), 4)
            AS avg_transaction_amount_by_hour FROM tx"""
    ),
    "avg_amount_hour_events": _with(
        """SELECT eventId, CAST(hour(transactionTime) AS INTEGER) AS hour,
            round(avg(transactionAmount) OVER (PARTITION BY hour(transactionTime)), 6)
            AS avg_transaction_amount_by_hour FROM ev"""
    ),
    "time_since_last": _with(f"SELECT eventId, {GAP} AS time_since_last_transaction FROM tx"),
    "time_since_last_events": _with(
        f"SELECT eventId, round({GAP}, 6) AS time_since_last_transaction FROM ev"
    ),
    "missing_report": _with(_missing_report()),
    "dataset_profile": _with(
        """SELECT count(*) AS row_count, CAST(13 AS BIGINT) AS column_count,
            CAST(13 * count(*) - count(eventId) - count(accountNumber) - count(merchantId)
                 - count(mcc) - count(merchantCountry) - count(merchantZip) - count(posEntryMode)
                 - count(transactionAmount) - count(availableCash) - count(transactionTime)
                 - count(reportedTime) - count(reported_delay) - count(Fraud) AS BIGINT)
                AS missing_cells,
            round(sum(Fraud) * 100.0 / count(*), 6) AS fraud_percentage FROM labelled"""
    ),
    "value_share": _with(
        """SELECT Fraud, count(*) AS rows,
            round(count(*) / sum(count(*)) OVER (), 6) AS share FROM labelled GROUP BY Fraud"""
    ),
    "value_share_country": _with(
        """SELECT merchantCountry, count(*) AS rows,
            round(count(*) / sum(count(*)) OVER (), 6) AS share FROM tx
            WHERE merchantCountry IS NOT NULL GROUP BY merchantCountry"""
    ),
    "correlation_matrix": _with(
        _correlations("t", CORRELATED),
        f"""t AS (SELECT * EXCLUDE (month), {_date_parts()},
            transactionAmount / nullif(availableCash, 0) AS cash_pct_spent FROM labelled)""",
    ),
    "histogram_auto": _with("SELECT * FROM h", f"h AS (WITH {HISTOGRAM.strip()})"),
    "box_stats": _with("", "one AS (SELECT 1)").rstrip() + _boxes("labelled", BOXED),
    "top_n_per_month": _with(
        "SELECT month, CAST(review_rank AS INTEGER) AS review_rank, eventId, score "
        "FROM ranked WHERE review_rank <= 400",
        RANKED,
    ),
    "top_n_per_weekday_wide": _with(
        """SELECT * FROM (SELECT eventId, CAST(isodow(transactionTime) - 1 AS INTEGER) AS weekday,
            -transactionAmount AS score,
            CAST(row_number() OVER (PARTITION BY isodow(transactionTime)
                 ORDER BY -transactionAmount, eventId) AS INTEGER) AS review_rank FROM tx)
        WHERE review_rank <= 1500"""
    ),
    "flagged_semi_join": _with(
        "SELECT eventId, Fraud, transactionAmount AS transactionAmount_original "
        "FROM ranked WHERE review_rank <= 400",
        RANKED,
    ),
    "monthly_evaluation": _with(ROUNDED_RESULTS, RANKED, RESULTS),
    "yearly_totals": _with(
        """SELECT round(sum(amount_saved), 2) AS total_amount_saved,
            round(sum(potential_amount_saved), 2) AS total_potential_amount_saved FROM results""",
        RANKED,
        RESULTS,
    ),
    "cumulative_saved": _with(
        """SELECT month, round(amount_saved, 2) AS amount_saved,
            round(sum(amount_saved) OVER (ORDER BY month), 2) AS cumulative_amount_saved
        FROM results""",
        RANKED,
        RESULTS,
    ),
    "metric_series": _with(
        """SELECT month, 'precision' AS metric, round(precision, 6) AS value FROM results
        UNION ALL SELECT month, 'f1_score', round(f1_score, 6) FROM results""",
        RANKED,
        RESULTS,
    ),
    "detected_share": _with(
        """SELECT month, round(p, 6) AS detected_percent,
            round(p / sum(p) OVER () * 100, 6) AS share_of_total
        FROM (SELECT month, CAST(true_frauds_flagged AS DOUBLE) / nullif(true_frauds, 0) * 100
              AS p FROM results)""",
        RANKED,
        RESULTS,
    ),
    "features_round_trip": _with("SELECT eventId, transactionAmount, Fraud, month FROM labelled"),
    "results_round_trip": _with(ROUNDED_RESULTS, RANKED, RESULTS),
    "feature_matrix": _with(
        """SELECT eventId, CAST(5 AS BIGINT) AS feature_count,
            round(coalesce(availableCash, 0) + day(transactionTime) + coalesce(merchantId, 0)
                  + coalesce(transactionAmount, 0) + (isodow(transactionTime) - 1), 4)
                AS feature_sum, Fraud FROM labelled"""
    ),
    "stratified_folds": _with("SELECT eventId, month, Fraud, fold FROM folded", FOLDED),
    "fold_selection": _with(
        """SELECT month, fold, round(p, 6) AS precision FROM (
            SELECT month, fold, p, row_number() OVER (PARTITION BY month ORDER BY p DESC, fold)
                AS rn
            FROM (SELECT month, fold, coalesce(CAST(count(*) FILTER (probability > 0.5
                         AND Fraud = 1) AS DOUBLE) / nullif(count(*) FILTER (probability > 0.5), 0),
                         0) AS p FROM folded GROUP BY month, fold)) WHERE rn = 1""",
        FOLDED,
    ),
    "confusion_metrics": _with(
        """SELECT month, tp, fp, fn, round(CAST(tp AS DOUBLE) / (tp + fp), 6) AS precision,
            round(2.0 * tp / (2 * tp + fp + fn), 6) AS f1_score
        FROM (SELECT month, count(*) FILTER (probability > 0.5 AND Fraud = 1) AS tp,
                     count(*) FILTER (probability > 0.5 AND Fraud = 0) AS fp,
                     count(*) FILTER (probability <= 0.5 AND Fraud = 1) AS fn
              FROM folded GROUP BY month)""",
        FOLDED,
    ),
    "decision_offset": _with(
        """SELECT eventId, month, round(decision, 10) AS decision,
            CAST(decision < 0 AS INTEGER) AS is_anomaly FROM decided""",
        DECIDED,
    ),
    "combined_score": _with(
        """SELECT eventId, round(probability * decision, 6) AS score,
            round(probability * anomaly, 6) AS positive_score FROM decided""",
        DECIDED,
    ),
    "near_miss": _with("SELECT * FROM kept", BASE_FEATURES, MATRIX, CLASSES, NEAR_MISS),
    "adasyn": _with(
        """SELECT month, row_id, CAST(1 AS INTEGER) AS label, round(list_sum(f), 3) AS total,
            round(list_sum(list_transform(f, lambda x, i: x * i)), 2) AS spread FROM moved""",
        BASE_FEATURES,
        MATRIX,
        CLASSES,
        ADASYN,
        SYNTHETIC,
    ),
    "near_miss_projections": _with(
        """SELECT month, 0 AS label, least(zeros, ones) AS count FROM sizes
        UNION ALL SELECT month, 1 AS label, ones AS count FROM sizes""",
        BASE_FEATURES,
        MATRIX,
        CLASSES,
    ),
    "training_report": _with(
        """SELECT month, CAST(m.fold AS INTEGER) AS fold, count(*) FILTER (f.fold <> m.fold) AS rows_before,
            count(*) FILTER (f.fold <> m.fold AND Fraud = 1) <= 5 AS skipped
        FROM folded f CROSS JOIN range(5) m(fold) WHERE month < 12 GROUP BY ALL""",
        FOLDED,
    ),
    "balanced_classes": _with(
        """SELECT month, 0 AS label, least(zeros, ones + extra) AS count FROM grown
        UNION ALL SELECT month, 1 AS label, least(zeros, ones + extra) AS count FROM grown""",
        BASE_FEATURES,
        MATRIX,
        CLASSES,
        ADASYN,
        """grown AS (SELECT month, ones, zeros, CAST(sum(new_rows) AS BIGINT) AS extra
            FROM born JOIN sizes USING (month) GROUP BY month, ones, zeros)""",
    ),
    "preprocess_features": _with(
        "SELECT eventId, "
        + ", ".join(
            f'round("{c}", 6) AS "{c}"' if c in FEATURES_ROUNDED else f'"{c}"'
            for c in FEATURE_COLUMNS
        )
        + " FROM features",
        BASE_FEATURES,
    ),
    "feature_boxes": _with("", BASE_FEATURES).rstrip()
    + _boxes(
        "features",
        ("transactionAmount", "availableCash", "reported_delay", "time_since_last_transaction"),
    ),
    "feature_correlations": _with(_correlations("features", FEATURE_COLUMNS), BASE_FEATURES),
    "isolation_forest_scores": _with(
        "SELECT eventId, month, round(anomaly, 9) AS anomaly, round(decision, 9) AS decision FROM decided",
        BASE_FEATURES,
        MATRIX,
        FOREST,
    ),
    "anomaly_flags": _with(ROUNDED_RESULTS, BASE_FEATURES, MATRIX, FOREST, FOREST_RANKED, RESULTS),
    "year_month_slices": _with(
        """SELECT scored_month, role, CAST(coalesce(n, 0) AS BIGINT) AS rows, amount FROM (
            SELECT a.m AS scored_month, role, CASE WHEN role = 'current' THEN a.m ELSE b.m END AS m
            FROM axis a JOIN axis b ON b.i = a.i - 1 CROSS JOIN (VALUES ('current'), ('previous')) r(role))
        LEFT JOIN (SELECT year_month AS m, count(*) AS n, round(sum(transactionAmount), 2) AS amount
                   FROM dated GROUP BY year_month) USING (m)""",
        YEAR_MONTHS,
        """axis AS (SELECT CAST(year(d) * 100 + month(d) AS INTEGER) AS m, row_number() OVER (ORDER BY d) AS i
            FROM (SELECT unnest(generate_series((SELECT date_trunc('month', min(transactionTime)) FROM tx)::TIMESTAMP,
                (SELECT max(transactionTime) FROM tx)::TIMESTAMP, INTERVAL 1 MONTH)) AS d))""",
    ),
    "year_month_top_n": _with(
        """SELECT year_month, eventId, CAST(place AS INTEGER) AS review_rank FROM (
            SELECT year_month, eventId, row_number() OVER (PARTITION BY year_month
                ORDER BY -transactionAmount, eventId) AS place FROM dated) WHERE place <= 10""",
        YEAR_MONTHS,
    ),
    "year_month_flags": _with(
        ROUNDED_RESULTS.replace("SELECT month", "SELECT month AS year_month"),
        YEAR_MONTHS,
        BASE_FEATURES,
        YEAR_MONTH_MATRIX,
        FOREST,
        FOREST_RANKED,
        RESULTS.replace("400", "20"),
    ),
    "year_month_models": _with(
        """SELECT year_month, count(*) AS rows FROM dated
        WHERE year_month > (SELECT min(year_month) FROM dated) GROUP BY year_month""",
        YEAR_MONTHS,
    ),
    "newton_margins": _with(
        "SELECT CAST(id AS BIGINT) AS eventId, round(margin, 9) AS margin FROM march",
        BASE_FEATURES,
        MATRIX,
        model_sql.newton(),
    ),
    "model_tables": _with(
        """SELECT m AS period, CAST(3 AS BIGINT) AS trees, CAST(0 AS BIGINT) AS lost,
            CAST(3 AS BIGINT) AS ends_over_splits, CAST(count(*) AS BIGINT) AS scored
        FROM labelled JOIN (SELECT CAST(unnest(range(2, 13)) AS INTEGER) AS m) ON m = month GROUP BY m"""
    ),
    "velocity_five_hours": _with(FIVE_HOURS),
    "velocity_five_hours_hot": _with(FIVE_HOURS),
    "time_since_last_hot": _with(
        f"SELECT eventId, round({GAP}, 6) AS time_since_last_transaction FROM ev"
    ),
    "time_since_last_null_ids": _with(
        f"""SELECT accountNumber, CAST(transactionTime AS VARCHAR) AS transactionTime,
            round({GAP}, 6) AS time_since_last_transaction
        FROM (SELECT * FROM ev UNION ALL SELECT * FROM ev WHERE eventId % 10 = 0)"""
    ),
    "key_frequency_hot": _with(
        "SELECT eventId, "
        + ", ".join(
            _count_over(k, f"{k} IS NOT NULL", f"{k}_freq")
            for k in ("accountNumber", "merchantId", "mcc")
        )
        + " FROM tx"
    ),
    "one_hot_numeric_mode": _with(
        """SELECT eventId,
            coalesce('pos_' || CAST(floor(transactionAmount * 2) / 2 AS VARCHAR), '') AS modes,
            CAST((SELECT count(DISTINCT floor(transactionAmount * 2)) FROM ev) AS INTEGER) AS columns
        FROM ev"""
    ),
    "csv_scan": _with(
        """SELECT 'tx-' || eventId AS eventId, CAST(accountNumber AS VARCHAR) AS accountNumber,
            CAST(merchantId AS VARCHAR) AS merchantId, mcc, merchantCountry, merchantZip,
            posEntryMode, transactionAmount, availableCash,
            strftime(transactionTime, '%Y-%m-%dT%H:%M:%S.%g') AS transactionTime FROM tx"""
    ),
    "full_run_csv": _with(
        """SELECT CAST(m AS INTEGER) AS month,
            CAST(count(*) FILTER (WHERE Fraud = 1) AS BIGINT) AS true_frauds,
            round(coalesce(sum(transactionAmount) FILTER (WHERE Fraud = 1), 0), 2)
                AS potential_amount_saved,
            CAST(least(400, count(eventId)) AS BIGINT) AS flagged
        FROM range(1, 13) AS months(m) LEFT JOIN labelled ON month(transactionTime) = m GROUP BY m"""
    ),
    "labels_csv_scan": _with(
        """SELECT 'tx-' || eventId AS eventId,
            strftime(reportedTime, '%Y-%m-%dT%H:%M:%S.%g') AS reportedTime FROM reports"""
    ),
}
