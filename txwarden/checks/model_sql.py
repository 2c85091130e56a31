"""SQL that grows the same trees as the model operators: isolation forests and Newton steps."""

from __future__ import annotations

FOREST_TREES, FOREST_ROWS, SEED = 100, 256, 42
LEVELS = 8  # a sample of 256 rows is cut at most so often


def matrix(columns: list[str], month: str = "month", source: str = "features") -> str:
    """matrix(month, id, Fraud, amount, f): the feature array of every row of ``features``."""
    cells = ", ".join(f'coalesce(CAST("{c}" AS DOUBLE), 0)' for c in columns)
    return f"""matrix AS MATERIALIZED (
    SELECT eventId, {month} AS month, CAST(eventId AS VARCHAR) AS id, Fraud, transactionAmount_original AS amount,
           [{cells}] AS f FROM {source})"""


def _path(n: str) -> str:
    exact = f"2 * (ln({n} - 1) + 0.5772156649) - 2 * ({n} - 1)::DOUBLE / {n}"
    return f"CASE WHEN {n} <= 1 THEN 0 WHEN {n} = 2 THEN 1 ELSE round(({exact}) * 1048576) / 1048576 END"


def _uniform(digest: str, first: int) -> str:
    return f"('0x' || substr({digest}, {first}, 13))::BIGINT::DOUBLE / 4503599627370496::DOUBLE"


def forest(features: int) -> str:
    """decided(eventId, id, month, Fraud, amount, anomaly, decision) from ``matrix``."""
    parts = [
        f"""hashed AS (
    SELECT month, id, ('0x' || substr(m, 1, 10))::BIGINT AS a, ('0x' || substr(m, 11, 10))::BIGINT AS b,
           ('0x' || substr(m, 21, 10))::BIGINT AS c
    FROM (SELECT month, id, md5('{SEED}|' || id) AS m FROM matrix))""",
        f"""sampled AS (
    SELECT month, CAST(tree AS INTEGER) AS tree, id FROM (
        SELECT month, tree, id, row_number() OVER (PARTITION BY month, tree
            ORDER BY (a + tree * b + tree * tree * c) % 1099511627776, id) AS place
        FROM hashed CROSS JOIN range({FOREST_TREES}) t(tree))
    WHERE place <= {FOREST_ROWS})""",
        f"""months AS (
    SELECT month, n, greatest(1, ceil(log2(greatest(2, n)))) AS depth
    FROM (SELECT month, least(count(*), {FOREST_ROWS}) AS n FROM matrix GROUP BY month))""",
        """s0 AS MATERIALIZED (
    SELECT month, tree, id, 0 AS node, f FROM sampled JOIN matrix USING (month, id))""",
    ]
    for level in range(LEVELS):
        parts.append(f"""split{level} AS MATERIALIZED (
    SELECT month, tree, node, j, low + {_uniform("d", 14)} * (high - low) AS edge
    FROM (SELECT *, md5('{SEED}|' || month || '|' || tree || '|' || node) AS d,
                 row_number() OVER (PARTITION BY month, tree, node ORDER BY j) AS k,
                 count(*) OVER (PARTITION BY month, tree, node) AS usable
          FROM (SELECT month, tree, node, j, min(f[j]) AS low, max(f[j]) AS high
                FROM s{level} CROSS JOIN range(1, {features + 1}) r(j) GROUP BY ALL)
          WHERE high > low)
    JOIN months USING (month)
    WHERE {level} < depth AND k = floor({_uniform("d", 1)} * usable) + 1)""")
        parts.append(f"""s{level + 1} AS MATERIALIZED (
    SELECT month, tree, id, 2 * node + 1 + CAST(f[j] > edge AS INTEGER) AS node, f
    FROM s{level} JOIN split{level} USING (month, tree, node))""")
    leaves = [
        f"""SELECT month, tree, node, {level} + {_path("count(*)")} AS value
        FROM s{level}{f" ANTI JOIN split{level} USING (month, tree, node)" if level < LEVELS else ""} GROUP BY ALL"""
        for level in range(LEVELS + 1)
    ]
    parts.append("leaves AS (" + " UNION ALL ".join(leaves) + ")")
    parts.append(
        f"w0 AS (SELECT month, id, CAST(tree AS INTEGER) AS tree, 0 AS node, f FROM matrix CROSS JOIN range({FOREST_TREES}) t(tree))"
    )
    for level in range(LEVELS):
        parts.append(f"""w{level + 1} AS (
    SELECT w.month, w.id, w.tree, w.f,
           CASE WHEN j IS NULL THEN w.node ELSE 2 * w.node + 1 + CAST(f[j] > edge AS INTEGER) END AS node
    FROM w{level} w LEFT JOIN split{level} s ON s.month = w.month AND s.tree = w.tree AND s.node = w.node)""")
    parts.append(f"""anomalies AS MATERIALIZED (
    SELECT month, id, -pow(2, -(total / {FOREST_TREES} / CASE WHEN n > 1 THEN {_path("n")} ELSE 1 END)) AS anomaly
    FROM (SELECT month, id, sum(value) AS total FROM w{LEVELS} JOIN leaves USING (month, tree, node) GROUP BY month, id)
    JOIN months USING (month))""")
    parts.append("""decided AS (
    SELECT eventId, id, month, Fraud, amount, anomaly, anomaly - cut AS decision
    FROM anomalies JOIN matrix USING (month, id)
    JOIN (SELECT month, quantile_cont(anomaly, 0.1) AS cut FROM anomalies GROUP BY month) USING (month))""")
    return ",\n".join(parts)


BINS, RATE, L2, LEAST, UNIT = 256, 0.3, 1.0, 1.0, 16777216


def newton_tree(name: str, train: str) -> str:
    """A tree of depth 2 from ``train`` (id, y, margin, f), as tables ``{name}_split`` (node, j, at) and
    ``{name}_leaf`` (node, value): exact cut points, whole-number sums, largest gain."""
    n = name

    def best(level: str, rows: str) -> str:
        return f"""{n}_sums{level} AS MATERIALIZED (
    SELECT node, j, code, sum(sum(g)) OVER w AS left_g, sum(sum(h)) OVER w AS left_h,
           sum(sum(g)) OVER (PARTITION BY node, j) AS all_g, sum(sum(h)) OVER (PARTITION BY node, j) AS all_h
    FROM {rows} JOIN {n}_codes USING (id) GROUP BY node, j, code
    WINDOW w AS (PARTITION BY node, j ORDER BY code ROWS UNBOUNDED PRECEDING)),
{n}_gain{level} AS (
    SELECT *, pow(left_g::DOUBLE / {UNIT}, 2) / (left_h::DOUBLE / {UNIT} + {L2})
            + pow((all_g - left_g)::DOUBLE / {UNIT}, 2) / ((all_h - left_h)::DOUBLE / {UNIT} + {L2}) AS gain,
           pow(all_g::DOUBLE / {UNIT}, 2) / (all_h::DOUBLE / {UNIT} + {L2}) + 1e-9 AS least
    FROM {n}_sums{level}
    WHERE left_h::DOUBLE / {UNIT} >= {LEAST} AND (all_h - left_h)::DOUBLE / {UNIT} >= {LEAST}),
{n}_split{level} AS MATERIALIZED (
    SELECT node, j, code, left_g, left_h, all_g, all_h, cut AS edge
    FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, j, code) AS place FROM {n}_gain{level})
    JOIN {n}_cuts ON {n}_cuts.feature = j AND {n}_cuts.number = code
    WHERE place = 1 AND gain > least)"""

    return f"""{n}_rows AS MATERIALIZED (
    SELECT id, f, CAST(round_even((y - p) * {UNIT}, 0) AS BIGINT) AS g,
           CAST(greatest(round_even(p * (1 - p) * {UNIT}, 0), 1) AS BIGINT) AS h, 0 AS node
    FROM (SELECT *, 1 / (1 + exp(-margin)) AS p FROM {train})),
{n}_cells AS MATERIALIZED (SELECT id, j, f[j] AS v FROM {n}_rows CROSS JOIN range(1, len(f) + 1) r(j)),
{n}_values AS (
    SELECT j, v, count(*) AS c, sum(count(*)) OVER (PARTITION BY j ORDER BY v) AS upto,
           count(*) OVER (PARTITION BY j) AS different, sum(count(*)) OVER (PARTITION BY j) AS total
    FROM {n}_cells GROUP BY j, v),
{n}_picked AS (
    SELECT j, v FROM {n}_values WHERE different <= {BINS}
    UNION SELECT j, v FROM {n}_values JOIN range({BINS}) r(i)
        ON i * (total - 1) // {BINS - 1} >= upto - c AND i * (total - 1) // {BINS - 1} < upto),
{n}_cuts AS MATERIALIZED (
    SELECT j AS feature, row_number() OVER (PARTITION BY j ORDER BY v) - 1 AS number, (v + next) / 2 AS cut
    FROM (SELECT j, v, lead(v) OVER (PARTITION BY j ORDER BY v) AS next FROM {n}_picked) WHERE next IS NOT NULL),
{n}_codes AS MATERIALIZED (
    SELECT id, j, code FROM {n}_cells JOIN (
        SELECT j, v, count(cut) AS code FROM {n}_values LEFT JOIN {n}_cuts ON feature = j AND cut < v GROUP BY j, v)
    USING (j, v)),
{best("0", f"{n}_rows")},
{n}_down AS MATERIALIZED (
    SELECT id, g, h, 1 + CAST(c.code > s.code AS INTEGER) AS node
    FROM {n}_rows JOIN {n}_split0 s USING (node) JOIN {n}_codes c USING (id, j)),
{best("1", f"{n}_down")},
{n}_split AS (SELECT node, j, edge FROM {n}_split0 UNION ALL SELECT node, j, edge FROM {n}_split1),
{n}_ends AS (  -- of all nodes; rows look at the one they end in
    SELECT node, sum(g) AS g, sum(h) AS h FROM {n}_rows GROUP BY node
    UNION ALL SELECT node, sum(g), sum(h) FROM {n}_down GROUP BY node
    UNION ALL SELECT 2 * node + 1, left_g, left_h FROM {n}_split1
    UNION ALL SELECT 2 * node + 2, all_g - left_g, all_h - left_h FROM {n}_split1),
{n}_leaf AS (SELECT node, {RATE} * (g::DOUBLE / {UNIT}) / (h::DOUBLE / {UNIT} + {L2}) AS value FROM {n}_ends)"""


def moved(name: str, tree: str, rows: str) -> str:
    """``name``: ``rows`` (id, y, margin, f) with the tree's step added to the margin."""
    return f"""{name} AS MATERIALIZED (
    SELECT id, y, f, margin + value AS margin FROM (
        SELECT a.id, a.y, a.f, a.margin,
               CASE WHEN b.j IS NULL THEN a.node ELSE 2 * a.node + 1 + CAST(a.f[b.j] > b.edge AS INTEGER) END AS node
        FROM (SELECT r.*, CASE WHEN s.j IS NULL THEN 0 ELSE 1 + CAST(f[s.j] > s.edge AS INTEGER) END AS node
              FROM {rows} r LEFT JOIN {tree}_split s ON s.node = 0 * r.y) a
        LEFT JOIN {tree}_split b ON b.node = a.node)
    JOIN {tree}_leaf USING (node))"""


def newton() -> str:
    """march(id, y, margin, f): March's margins after a round on January and one, warm started, on
    February."""
    base = "(SELECT ln(avg(Fraud) / (1 - avg(Fraud))) FROM matrix WHERE month = 1)"
    rows = lambda m: f"rows{m} AS MATERIALIZED (SELECT id, Fraud AS y, {base} AS margin, f FROM matrix WHERE month = {m})"
    return ",\n".join(
        [
            rows(1), rows(2), rows(3), newton_tree("t1", "rows1"), moved("after2", "t1", "rows2"),
            newton_tree("t2", "after2"), moved("after3", "t1", "rows3"), moved("march", "t2", "after3"),
        ]
    )
