"""The same queries as plain SQL over the given tables, for comparison.

Written from the definitions, with global windows and pairwise joins where
these say most directly what is meant. Shares no code with the operators.
"""

from __future__ import annotations


def _with(*tables: str) -> str:
    return "WITH " + ",\n".join(tables) + "\n"


_ORDERS = """
orders_tx AS (
    SELECT o.o_orderkey,
           o.o_custkey AS customer_id,
           CAST(o.o_orderdate AS DATE) AS transaction_date,
           CAST(COALESCE(l.quantity, 0) AS INTEGER) AS num_cds_purchased,
           CAST(o.o_totalprice AS DECIMAL(18, 2)) AS transaction_value
    FROM orders o
    LEFT JOIN (SELECT l_orderkey, SUM(l_quantity) AS quantity FROM lineitem GROUP BY 1) l
           ON l.l_orderkey = o.o_orderkey
)"""

_DIRTY = """
dirty AS (
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 13 <> 0 THEN customer_id END AS customer_id,
           transaction_date,
           CASE WHEN o_orderkey % 23 <> 0 THEN num_cds_purchased END AS num_cds_purchased,
           CASE WHEN o_orderkey % 17 = 0 THEN -transaction_value
                WHEN o_orderkey % 19 = 0 THEN 0
                ELSE transaction_value END AS transaction_value
    FROM orders_tx
)"""


def _rfm_of(source: str, as_of: str | None = None, where: str = "TRUE") -> str:
    day = f"DATE '{as_of}'" if as_of else f"(SELECT MAX(transaction_date) FROM {source} WHERE {where})"
    return f"""
rfm AS (
    SELECT customer_id,
           CAST(date_diff('day', MAX(transaction_date), {day}) AS INTEGER) AS Recency,
           COUNT(transaction_value) AS Frequency,
           CAST(SUM(transaction_value) AS DECIMAL(28, 2)) AS Monetary
    FROM {source}
    WHERE {where}
    GROUP BY customer_id
)"""


_CLEAN = (
    "transaction_value > 0 AND customer_id IS NOT NULL AND transaction_date IS NOT NULL"
    " AND num_cds_purchased IS NOT NULL"
)
_RFM = _rfm_of("orders_tx", where=_CLEAN)

_RANKED = """
ranked AS (
    SELECT *,
           row_number() OVER (ORDER BY Recency, customer_id) AS r,
           row_number() OVER (ORDER BY Frequency, customer_id) AS f,
           row_number() OVER (ORDER BY Monetary, customer_id) AS m,
           COUNT(*) OVER () AS n
    FROM rfm
)"""

_SCORED = """
quartiled AS (
    SELECT customer_id, Recency, Frequency, Monetary,
           CAST(5 - greatest(1, (4 * (r - 1) + n - 2) // (n - 1)) AS INTEGER) AS R4,
           CAST(greatest(1, (4 * (f - 1) + n - 2) // (n - 1)) AS INTEGER) AS F4,
           CAST(greatest(1, (4 * (m - 1) + n - 2) // (n - 1)) AS INTEGER) AS M4
    FROM ranked
),
scored AS (
    SELECT customer_id, Recency, Frequency, Monetary, R4 AS R, F4 AS F, M4 AS M,
           R4::VARCHAR || F4::VARCHAR || M4::VARCHAR AS RFM_Segment,
           R4 + F4 + M4 AS RFM_score
    FROM quartiled
)"""

_SCORE_TABLES = (_ORDERS, _RFM, _RANKED, _SCORED)

_LEVEL = {
    2: "CASE WHEN RFM_score >= 9 THEN 'Active Customers' ELSE 'Lost Customers' END",
    3: """CASE WHEN RFM_score = 12 THEN 'VIP Customers'
               WHEN R IN (3, 4) THEN 'Active Customers' ELSE 'Lost Customers' END""",
    4: """CASE WHEN RFM_Segment = '444' THEN 'VIP Customers'
               WHEN F = 4 AND R > 1 THEN 'Potential Loyalists'
               WHEN greatest(R, F, M) <= 2 THEN 'Lost' ELSE 'Regular' END""",
    5: """CASE WHEN RFM_Segment = '444' THEN 'Group 1' WHEN R = 4 THEN 'Group 2'
               WHEN M = 4 THEN 'Group 3' WHEN F = 4 THEN 'Group 4' ELSE 'Group 5' END""",
    6: """CASE WHEN RFM_Segment = '444' THEN 'Group 1' WHEN RFM_Segment = '111' THEN 'Group 2'
               WHEN M = 4 THEN 'Group 3' WHEN least(R, M) >= 3 THEN 'Group 4'
               WHEN least(R, F) >= 3 THEN 'Group 5' ELSE 'Group 6' END""",
    7: """CASE WHEN RFM_Segment = '444' THEN 'Group 1' WHEN R = 4 THEN 'Group 2'
               WHEN greatest(F, M) <= 2 THEN 'Group 3' WHEN M = 4 THEN 'Group 4'
               WHEN R = 3 AND F < 3 THEN 'Group 5' WHEN F > 2 AND R > 1 THEN 'Group 6'
               ELSE 'Group 7' END""",
}


def _profile_of(source: str, label: str, k: int, digits: int = 0) -> str:
    means = ", ".join(
        f"round_even(CAST(SUM({metric}) AS DOUBLE) / COUNT(*), {digits}) AS {metric}Mean"
        for metric in ("Recency", "Frequency", "Monetary")
    )
    return f"""
    SELECT {label}, {means}, COUNT(*) AS "Count",
           round_even(COUNT(*) / SUM(COUNT(*)) OVER () * 100, 2) AS "Percent",
           CAST({k} AS INTEGER) AS "Number of Clusters"
    FROM {source} GROUP BY {label}"""


def _rfm_profile(k: int) -> str:
    return _profile_of(
        f"(SELECT *, {_LEVEL[k]} AS RFM_level FROM scored)", "RFM_level", k
    )


_TEXT = """
text_fields AS (
    SELECT *,
           printf(' %010d', customer_id) AS id,
           strftime(transaction_date, '%Y%m%d') AS day,
           CAST(num_cds_purchased AS VARCHAR) AS quantity,
           printf('%.2f', CAST(transaction_value AS DOUBLE)) AS shown
    FROM orders_tx
),
text_lines AS (
    SELECT CASE WHEN o_orderkey % 11 = 0 THEN id || ' ' || day || ' ' || quantity
                WHEN o_orderkey % 29 = 0 THEN id || ' ' || day || ' ' || quantity || ' n/a'
                WHEN o_orderkey % 7 = 0 THEN id || '   ' || CAST(o_orderkey % 1000 AS VARCHAR)
                     || '   ' || day || '   ' || quantity || '   ' || shown
                ELSE id || '  ' || day || '  ' || quantity || '  ' || shown END AS value
    FROM text_fields
),
fields AS (
    SELECT value, regexp_split_to_array(trim(value), '\\s+') AS p FROM text_lines
),
located AS (
    SELECT value, len(p) AS n, p[1] AS customer_id,
           CASE WHEN len(p) = 5 THEN p[3] ELSE p[2] END AS day,
           CASE WHEN len(p) = 5 THEN p[4] ELSE p[3] END AS quantity,
           CASE WHEN len(p) = 5 THEN p[5] ELSE p[4] END AS amount
    FROM fields
),
converted AS (
    SELECT value, n, customer_id,
           CAST(try_strptime(day, '%Y%m%d') AS DATE) AS transaction_date,
           TRY_CAST(quantity AS INTEGER) AS num_cds_purchased,
           TRY_CAST(amount AS DECIMAL(18, 2)) AS transaction_value
    FROM located WHERE n IN (4, 5)
),
parsed AS (
    SELECT * FROM converted
    WHERE transaction_date IS NOT NULL AND num_cds_purchased IS NOT NULL
      AND transaction_value IS NOT NULL
)"""

_PADDED_ID = "printf('%010d', customer_id)"


def _transactions_of(customer: str) -> str:
    return (
        f"{customer} AS customer_id, CAST(transaction_date AS VARCHAR) AS transaction_date,"
        " num_cds_purchased, CAST(transaction_value AS DOUBLE) AS transaction_value"
    )


_TRANSACTION_OUTPUT = _transactions_of("customer_id")
_RFM_OUTPUT = "customer_id, Recency, Frequency, CAST(Monetary AS DOUBLE) AS Monetary"

_STANDARDIZED = """
standardized AS (
    SELECT customer_id, Recency, Frequency, Monetary,
           (Recency - AVG(Recency) OVER ()) / stddev_pop(Recency) OVER () AS zr,
           (Frequency - AVG(Frequency) OVER ()) / stddev_pop(Frequency) OVER () AS zf,
           (CAST(Monetary AS DOUBLE) - AVG(CAST(Monetary AS DOUBLE)) OVER ())
               / stddev_pop(CAST(Monetary AS DOUBLE)) OVER () AS zm
    FROM rfm
)"""

_NEAREST = """
centres(cluster, cr, cf, cm) AS (
    VALUES (0, -0.5, 1.0, 1.0), (1, 0.0, 0.0, 0.0), (2, 1.5, -1.0, -1.0), (3, -0.5, -0.5, -0.5)
),
nearest AS (
    SELECT s.*, CAST(c.cluster AS INTEGER) AS cluster,
           sqrt((zr - cr) ^ 2 + (zf - cf) ^ 2 + (zm - cm) ^ 2) AS distance
    FROM standardized s CROSS JOIN centres c
    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY distance, c.cluster) = 1
)"""

_CENTRE_ROWS = "(0, -0.5, 1.0, 1.0), (1, 0.0, 0.0, 0.0), (2, 1.5, -1.0, -1.0), (3, -0.5, -0.5, -0.5)"


def _moments(source: str) -> str:
    """Means and n - 1 deviations that a scoring model takes from ``source``."""
    parts = ", ".join(
        f"AVG(CAST({m} AS DOUBLE)) AS {n}_mean, stddev_samp(CAST({m} AS DOUBLE)) AS {n}_std"
        for m, n in (("Recency", "r"), ("Frequency", "f"), ("Monetary", "m"))
    )
    return f"moments AS (SELECT {parts} FROM {source})"


def _scored_by_centres(source: str) -> str:
    """Customers of ``source`` at the nearest of the given centres, scaled by ``moments``."""
    return f"""
given(cluster, cr, cf, cm) AS (VALUES {_CENTRE_ROWS}),
placed AS (
    SELECT s.customer_id, Recency, Frequency, CAST(Monetary AS DOUBLE) AS Monetary,
           CAST(g.cluster AS INTEGER) AS cluster,
           ((Recency - r_mean) / r_std - cr) ^ 2 + ((Frequency - f_mean) / f_std - cf) ^ 2
               + ((CAST(Monetary AS DOUBLE) - m_mean) / m_std - cm) ^ 2 AS squared
    FROM {source} s CROSS JOIN moments CROSS JOIN given g
    QUALIFY row_number() OVER (PARTITION BY s.customer_id ORDER BY squared, g.cluster) = 1
)"""


_PLACED = """(SELECT Recency, Frequency, Monetary, 'Cluster ' || cluster AS "Cluster" FROM placed)"""


def _batch(source: str, where: str = "TRUE", customer: str = "customer_id") -> str:
    """RFM of new transactions at the scoring day."""
    return f"""
batch AS (
    SELECT {customer} AS customer_id,
           CAST(date_diff('day', MAX(transaction_date), DATE '2000-06-30') AS INTEGER) AS Recency,
           COUNT(transaction_value) AS Frequency,
           CAST(SUM(transaction_value) AS DECIMAL(28, 2)) AS Monetary
    FROM {source} WHERE {where} GROUP BY 1
)"""


_SCORED_BATCH = (_ORDERS, _RFM, _TEXT, _batch("parsed"))
_IN_RANGE = (
    "SELECT customer_id, Recency, Frequency, CAST(Monetary AS DOUBLE) AS Monetary,"
    " TRUE AS in_range FROM rfm"
)


def _sizes_of(k: str) -> str:
    """A row per k: that many segments hold all customers."""
    return f"""SELECT CAST(k AS INTEGER) AS "Number of Clusters", CAST(k AS BIGINT) AS n_segments,
               (SELECT COUNT(*) FROM rfm) AS n_customers FROM (SELECT unnest({k}) AS k)"""


_PAIRWISE = (
    *_SCORE_TABLES,
    _STANDARDIZED,
    f"""labelled AS (SELECT customer_id, {_LEVEL[4]} AS c, zr, zf, zm
        FROM scored JOIN standardized USING (customer_id))""",
    """sizes AS (SELECT c, COUNT(*) AS size FROM labelled GROUP BY c)""",
    """sums AS (SELECT a.customer_id, a.c AS own, b.c AS other,
                SUM(sqrt((a.zr - b.zr) ^ 2 + (a.zf - b.zf) ^ 2 + (a.zm - b.zm) ^ 2)) AS total
                FROM labelled a CROSS JOIN labelled b GROUP BY 1, 2, 3)""",
    """parts AS (SELECT customer_id, any_value(own) AS own,
                 MAX(CASE WHEN own = other THEN total / greatest(size - 1, 1) END) AS a,
                 MIN(CASE WHEN own <> other THEN total / size END) AS b,
                 MAX(CASE WHEN own = other THEN size END) AS own_size
                 FROM sums JOIN sizes ON sizes.c = sums.other GROUP BY customer_id)""",
)
_NEAREST_TABLES = (_ORDERS, _RFM, _STANDARDIZED, _NEAREST)
_NAMED_CLUSTERS = (
    "(SELECT Recency, Frequency, Monetary, 'Cluster ' || cluster AS \"Cluster\" FROM nearest)"
)

_LONG = """
long AS (
    SELECT 'Recency' AS metric, CAST(Recency AS DECIMAL(28, 2)) AS v FROM rfm
    UNION ALL SELECT 'Frequency', CAST(Frequency AS DECIMAL(28, 2)) FROM rfm
    UNION ALL SELECT 'Monetary', Monetary FROM rfm
)"""


def _describe(column: str) -> str:
    v = f"CAST({column} AS DOUBLE)"
    quantiles = ", ".join(
        f"ROUND(quantile_cont({v}, {p / 100}), 4) AS p{p}" for p in (25, 50, 75)
    )
    return f"""
    SELECT '{column}' AS "column", COUNT({v}) AS "count", ROUND(AVG({v}), 4) AS mean,
           ROUND(stddev_samp({v}), 4) AS std, MIN({v}) AS "min", {quantiles}, MAX({v}) AS "max"
    FROM orders_tx"""


def _comparison(k: int, share: str) -> str:
    return f"""
    SELECT CAST({k} AS INTEGER) AS "Number of Clusters", 'RFM Analysis' AS "Model",
           SUM("Count") / 1000.0::DOUBLE AS "Execution Time (s)",
           {share}("Percent") / 100 AS "Silhouette Score"
    FROM ({_rfm_profile(k)})"""


_EVENTS = """
event_tx AS (
    SELECT user_id AS customer_id, CAST(ts AS DATE) AS transaction_date,
           CAST(1 AS INTEGER) AS num_cds_purchased, CAST(value AS DECIMAL(18, 2)) AS transaction_value
    FROM events
)"""


def _reason(start: str, end: str) -> str:
    return f"""
    CASE WHEN transaction_date < DATE '{start}' OR transaction_date > DATE '{end}'
              THEN 'Transaction date must be between {start} and {end}.'
         WHEN num_cds_purchased <= 0 THEN 'Number of CDs should be greater than 0'
         WHEN transaction_value <= 0 THEN 'Transaction value should be greater than 0' END"""


_EVENT_REASON = _reason("2024-01-03", "2024-01-27")

ORACLES: dict[str, str] = {
    "load_transactions": _with(_ORDERS)
    + f"SELECT {_transactions_of(_PADDED_ID)} FROM orders_tx",
    "parse_transactions": _with(_ORDERS, _TEXT) + f"SELECT {_TRANSACTION_OUTPUT} FROM parsed",
    "parse_transactions_four_fields": _with(_ORDERS, _TEXT)
    + f"SELECT {_TRANSACTION_OUTPUT} FROM parsed WHERE n = 4",
    "parse_rejects": _with(_ORDERS, _TEXT)
    + """SELECT value FROM converted WHERE transaction_date IS NULL
         OR num_cds_purchased IS NULL OR transaction_value IS NULL""",
    "load_row_count": _with(_ORDERS, _TEXT) + "SELECT COUNT(*) AS n_transactions FROM parsed",
    "tsv_roundtrip": _with(_ORDERS)
    + f"SELECT {_transactions_of('CAST(customer_id AS VARCHAR)')} FROM orders_tx",
    "results_roundtrip": _with(*_SCORE_TABLES)
    + " UNION ALL ".join(f"({_rfm_profile(k)})" for k in range(2, 8)),
    "assignments_roundtrip": _with(*_NEAREST_TABLES)
    + f"""SELECT {_RFM_OUTPUT}, cluster AS "Cluster",
          CAST(4 AS INTEGER) AS "Number of Clusters" FROM nearest""",
    "upsert_comparison": _with(*_SCORE_TABLES)
    + f"{_comparison(2, 'MAX')} UNION ALL {_comparison(3, 'MIN')} UNION ALL {_comparison(4, 'MIN')}",
    "comparison_for_k": _with(*_SCORE_TABLES)
    + f'SELECT * EXCLUDE ("Number of Clusters") FROM ({_comparison(3, "MIN")})',
    "model_roundtrip": _with(_ORDERS, _RFM)
    + "SELECT COUNT(*) AS n_customers, CAST(0 AS BIGINT) AS n_different FROM rfm",
    "clean_transactions": _with(_ORDERS, _DIRTY)
    + f"SELECT o_orderkey, {_TRANSACTION_OUTPUT} FROM dirty WHERE {_CLEAN}",
    "validate_transactions": _with(
        _ORDERS,
        _DIRTY,
        """checked AS (SELECT * REPLACE (CAST(COALESCE(num_cds_purchased, 0) AS INTEGER)
                      AS num_cds_purchased) FROM dirty)""",
    )
    + f"""SELECT o_orderkey, CAST(transaction_date AS VARCHAR) AS transaction_date,
          num_cds_purchased, CAST(transaction_value AS DOUBLE) AS transaction_value,
          {_reason('1996-01-01', '2000-06-30')} AS reject_reason FROM checked""",
    "head_rows": _with(_ORDERS)
    + f"SELECT o_orderkey, {_TRANSACTION_OUTPUT} FROM orders_tx ORDER BY o_orderkey LIMIT 5",
    "describe_transactions": _with(_ORDERS)
    + f"{_describe('num_cds_purchased')} UNION ALL {_describe('transaction_value')}",
    "daily_profile": _with(
        _ORDERS,
        _DIRTY,
        """stacked AS (
           SELECT 'num_cds_purchased' AS "column", CAST(num_cds_purchased AS DOUBLE) AS v, customer_id FROM dirty
           UNION ALL
           SELECT 'transaction_value', CAST(transaction_value AS DOUBLE), customer_id FROM dirty)""",
    )
    + """SELECT "column", COUNT(v) AS "count", ROUND(AVG(v), 4) AS mean,
         ROUND(stddev_samp(v), 4) AS std, MIN(v) AS min, MAX(v) AS max,
         COUNT(*) - COUNT(v) AS "Missing_Values",
         COUNT(*) - COUNT(customer_id) AS missing_ids,
         TRUE AS ids_within, TRUE AS ranks_within
         FROM stacked GROUP BY "column" """,
    "null_counts": _with(_ORDERS, _DIRTY)
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT(*) - COUNT({c}) AS "Missing_Values" FROM dirty"""
        for c in ("customer_id", "transaction_date", "num_cds_purchased", "transaction_value")
    ),
    "date_range": _with(_ORDERS)
    + """SELECT CAST(MIN(transaction_date) AS VARCHAR) AS first_date,
         CAST(MAX(transaction_date) AS VARCHAR) AS last_date FROM orders_tx""",
    "id_stats": _with(_ORDERS, _DIRTY)
    + """SELECT COUNT(*) - COUNT(customer_id) AS missing_ids,
         (SELECT COUNT(*) FROM (SELECT DISTINCT customer_id FROM dirty)) AS unique_ids FROM dirty""",
    "rfm_table": _with(_ORDERS, _RFM) + f"SELECT {_RFM_OUTPUT} FROM rfm",
    "rfm_table_dirty": _with(_ORDERS, _DIRTY, _rfm_of("dirty", where=_CLEAN))
    + f"SELECT {_RFM_OUTPUT} FROM rfm",
    "rfm_corrected": _with(
        _ORDERS,
        _DIRTY,
        """marked AS (
           SELECT *, o_orderkey % 7 = 3
                     OR transaction_date >= DATE '2000-03-01' AND o_orderkey % 2 = 1 AS gone,
                  o_orderkey % 5 = 1 AS moves
           FROM dirty)""",
        """corrected AS (
           SELECT * FROM marked WHERE NOT gone AND NOT moves
           UNION ALL
           SELECT * REPLACE (
               customer_id + o_orderkey % 2 AS customer_id,
               CAST(transaction_date - INTERVAL 40 DAY AS DATE) AS transaction_date,
               CAST(transaction_value + 1 AS DECIMAL(18, 2)) AS transaction_value)
           FROM marked WHERE NOT gone AND moves)""",
        _rfm_of("corrected", where=_CLEAN),
    )
    + f"SELECT {_RFM_OUTPUT} FROM rfm",
    "rfm_table_asof": _with(_ORDERS, _rfm_of("orders_tx", as_of="2000-06-30"))
    + f"SELECT {_RFM_OUTPUT} FROM rfm",
    "rfm_ranks": _with(_ORDERS, _RFM, _RANKED)
    + """SELECT customer_id, r AS "Recency_rank", f AS "Frequency_rank", m AS "Monetary_rank"
         FROM ranked""",
    "rfm_quartiles": _with(*_SCORE_TABLES) + "SELECT customer_id, R, F, M FROM scored",
    "rfm_quartiles_scaled": _with(*_SCORE_TABLES) + "SELECT customer_id, R, F, M FROM scored",
    "rfm_scores": _with(*_SCORE_TABLES)
    + f"SELECT {_RFM_OUTPUT}, R, F, M, RFM_Segment, RFM_score FROM scored",
    "segment_code_count": _with(*_SCORE_TABLES)
    + "SELECT COUNT(DISTINCT RFM_Segment) AS n_segment_codes FROM scored",
    "rfm_profile": _with(*_SCORE_TABLES) + _rfm_profile(4),
    "segment_labels": _with(*_SCORE_TABLES, f"profile AS ({_rfm_profile(4)})")
    + r"""SELECT RFM_level, printf(E'%s \n%d days \n%d orders \n%d $ \n%d customers (%s%%)',
          RFM_level, CAST(RecencyMean AS BIGINT), CAST(FrequencyMean AS BIGINT),
          CAST(MonetaryMean AS BIGINT), "Count", CAST("Percent" AS VARCHAR)) AS label FROM profile""",
    "rfm_histogram": _with(
        _ORDERS,
        _RFM,
        _LONG,
        "bounds AS (SELECT metric, MIN(v) AS low, MAX(v) AS high FROM long GROUP BY metric)",
        """counted AS (
            SELECT metric, least(29, CAST((v - low) * 100 AS BIGINT) * 30
                   // CAST((high - low) * 100 AS BIGINT)) AS bin, COUNT(*) AS n
            FROM long JOIN bounds USING (metric) GROUP BY 1, 2)""",
    )
    + """SELECT b.metric, CAST(g.bin AS INTEGER) AS bin,
         ROUND(low::DOUBLE + (high - low)::DOUBLE / 30 * g.bin, 4) AS bin_start,
         ROUND(low::DOUBLE + (high - low)::DOUBLE / 30 * (g.bin + 1), 4) AS bin_end,
         COALESCE(n, 0) AS "count"
         FROM bounds b CROSS JOIN (SELECT unnest(range(30)) AS bin) g
         LEFT JOIN counted c ON c.metric = b.metric AND c.bin = g.bin""",
    "rfm_kde": _with(
        _ORDERS,
        _RFM,
        _LONG,
        """stats AS (SELECT metric, COUNT(*) AS n, MIN(v)::DOUBLE AS low, MAX(v)::DOUBLE AS high,
           stddev_samp(v::DOUBLE) * COUNT(*) ^ (-0.2) AS h FROM long GROUP BY metric)""",
        """grid AS (SELECT stats.*, point, low + (high - low) * point / 199 AS x
           FROM stats CROSS JOIN (SELECT unnest(range(200)) AS point))""",
        """weighted AS (SELECT metric, v::DOUBLE AS v, COUNT(*) AS w FROM long GROUP BY 1, 2)""",
    )
    + """SELECT g.metric, CAST(point AS INTEGER) AS point, ROUND(x, 4) AS x,
         ROUND(SUM(w * exp(-pow((x - v) / h, 2) / 2)) / (any_value(h) * sqrt(2 * pi()))
               * any_value(high - low) / 30, 4) AS curve
         FROM grid g JOIN weighted USING (metric) GROUP BY g.metric, point, x""",
    "rfm_standardized": _with(_ORDERS, _RFM, _STANDARDIZED)
    + """SELECT customer_id, ROUND(zr, 6) AS "Recency_scaled", ROUND(zf, 6) AS "Frequency_scaled",
         ROUND(zm, 6) AS "Monetary_scaled" FROM standardized""",
    "rfm_minmax": _with(_ORDERS, _RFM)
    + "SELECT customer_id, "
    + ", ".join(
        f"""ROUND((CAST({m} AS DOUBLE) - MIN(CAST({m} AS DOUBLE)) OVER ())
            / (MAX(CAST({m} AS DOUBLE)) OVER () - MIN(CAST({m} AS DOUBLE)) OVER ()), 6)
            AS "{m}_scaled" """
        for m in ("Recency", "Frequency", "Monetary")
    )
    + "FROM rfm",
    "assign_nearest": _with(*_NEAREST_TABLES)
    + "SELECT customer_id, cluster, ROUND(distance, 6) AS distance FROM nearest",
    "assign_many_centres": _with(
        _ORDERS,
        _RFM,
        _STANDARDIZED,
        "placed AS (SELECT *, "
        + " + ".join(
            f"(greatest(least(floor({z} / 0.25), 7), -8) + 8) * {16 ** (2 - i)}"
            for i, z in enumerate(("zr", "zf", "zm"))
        )
        + " AS cell FROM standardized)",
        """means AS (SELECT CAST(cell AS BIGINT) AS cell, ROUND(AVG(zr), 9) AS r,
                   ROUND(AVG(zf), 9) AS f, ROUND(AVG(zm), 9) AS m FROM placed GROUP BY 1)""",
        """away AS (SELECT customer_id, MIN({'q': (zr - r) ^ 2 + (zf - f) ^ 2 + (zm - m) ^ 2,
                                             'cell': means.cell}) AS best
                  FROM placed CROSS JOIN means GROUP BY customer_id)""",
    )
    + """SELECT customer_id, best.cell AS cluster, ROUND(SQRT(best.q), 6) AS distance FROM away""",
    "attach_clusters": _with(
        *_NEAREST_TABLES, _DIRTY, _rfm_of("dirty", where=_CLEAN).replace("rfm AS", "dirty_rfm AS")
    )
    + """SELECT d.customer_id, d.Recency, d.Frequency, CAST(d.Monetary AS DOUBLE) AS Monetary,
         cluster AS "Cluster" FROM dirty_rfm d JOIN nearest n ON n.customer_id = d.customer_id""",
    "sample_rows": _with(_ORDERS)
    + f"""SELECT o_orderkey, {_TRANSACTION_OUTPUT} FROM orders_tx
          ORDER BY md5('42|' || CAST(o_orderkey AS VARCHAR)) LIMIT 5""",
    "parse_surplus_decimals": _with(_ORDERS)
    + f"""SELECT * REPLACE (CAST(num_cds_purchased AS DOUBLE) AS num_cds_purchased)
          FROM (SELECT {_transactions_of(_PADDED_ID)} FROM orders_tx WHERE o_orderkey % 5 <> 0)
          UNION ALL BY NAME
          SELECT concat_ws(' ', customer_id, strftime(transaction_date, '%Y%m%d'),
                 num_cds_purchased, printf('%.2f', CAST(transaction_value AS DOUBLE)) || '7') AS value
          FROM orders_tx WHERE o_orderkey % 5 = 0""",
    "kmeans_segments": _with(_ORDERS, _RFM)
    + f"SELECT {_RFM_OUTPUT}, TRUE AS in_range, TRUE AS at_nearest, 0.0::DOUBLE AS centre_gap,"
    " TRUE AS converged FROM rfm",
    "kmeans_profile": _with(_ORDERS, _RFM)
    + f"SELECT *, TRUE AS silhouette_in_bounds FROM ({_sizes_of('[4]')})",
    "kmeans_minmax_profile": _with(_ORDERS, _RFM)
    + "SELECT *, TRUE AS silhouette_in_bounds, 0.0::DOUBLE AS centre_gap"
    f" FROM ({_sizes_of('[4]')})",
    "kmeans_profiles": _with(_ORDERS, _RFM)
    + "SELECT *, TRUE AS below_one_cluster, 0.0::DOUBLE AS centre_gap"
    f" FROM ({_sizes_of('range(2, 8)')})",
    "ward_segments": _with(_ORDERS, _RFM) + _IN_RANGE,
    "bisecting_segments": _with(_ORDERS, _RFM) + _IN_RANGE,
    "ward_profile": _with(_ORDERS, _RFM)
    + f"SELECT *, TRUE AS silhouette_in_bounds FROM ({_sizes_of('[4]')})",
    "ward_profiles": _with(_ORDERS, _RFM, _STANDARDIZED)
    + f"""SELECT *, (SELECT ROUND(SUM(zr ^ 2 + zf ^ 2 + zm ^ 2), 4) FROM standardized) AS sse_of_one
          FROM ({_sizes_of("range(2, 8)")})""",
    "ward_merges": _with(_ORDERS, _RFM, _STANDARDIZED)
    + """SELECT COUNT(*) AS n_customers, ROUND(SUM(zr ^ 2 + zf ^ 2 + zm ^ 2), 4) AS sse,
         TRUE AS share_inside_kept, TRUE AS heights_rise, TRUE AS nodes_merge_once FROM standardized""",
    "elbow_curve": _with(_ORDERS, _RFM, _STANDARDIZED)
    + """SELECT CAST(k AS INTEGER) AS k, (SELECT ROUND(SUM(zr ^ 2 + zf ^ 2 + zm ^ 2), 4)
         FROM standardized) AS sse_of_one, TRUE AS sse_checked, TRUE AS falls, TRUE AS converged
         FROM (SELECT unnest(range(1, 20)) AS k)""",
    "elbow_curve_minmax": _with(_ORDERS, _RFM)
    + """SELECT CAST(k AS INTEGER) AS k, (SELECT ROUND(
         var_pop(Recency) * COUNT(*) / (MAX(Recency) - MIN(Recency)) ^ 2
         + var_pop(Frequency) * COUNT(*) / (MAX(Frequency) - MIN(Frequency)) ^ 2
         + var_pop(CAST(Monetary AS DOUBLE)) * COUNT(*)
           / CAST(MAX(Monetary) - MIN(Monetary) AS DOUBLE) ^ 2, 4) FROM rfm) AS sse_of_one,
         TRUE AS sse_checked, TRUE AS falls, TRUE AS converged
         FROM (SELECT unnest(range(1, 20)) AS k)""",
    "silhouette_bounded": _with(
        *_SCORE_TABLES,
        _STANDARDIZED,
        f"""labelled AS (SELECT customer_id, {_LEVEL[4]} AS c, zr, zf, zm,
            concat_ws(',', floor(zr / 0.5), floor(zf / 0.5), floor(zm / 0.5)) AS cell
            FROM scored JOIN standardized USING (customer_id))""",
        """cells AS (SELECT c, cell, COUNT(*) AS w, AVG(zr) AS ar, AVG(zf) AS af, AVG(zm) AS am,
            greatest(AVG(zr ^ 2 + zf ^ 2 + zm ^ 2) - AVG(zr) ^ 2 - AVG(zf) ^ 2 - AVG(zm) ^ 2, 0)
            AS spread FROM labelled GROUP BY c, cell)""",
        """sizes AS (SELECT c, COUNT(*) AS size FROM labelled GROUP BY c)""",
        """sums AS (SELECT customer_id, any_value(l.c) AS own, k.c AS other,
            SUM(w * sqrt((zr - ar) ^ 2 + (zf - af) ^ 2 + (zm - am) ^ 2)) AS near,
            SUM(w * sqrt((zr - ar) ^ 2 + (zf - af) ^ 2 + (zm - am) ^ 2 + spread)) AS far
            FROM labelled l CROSS JOIN cells k GROUP BY customer_id, k.c)""",
        """parts AS (SELECT customer_id, any_value(own) AS own,
            MAX(CASE WHEN own = other THEN near / greatest(size - 1, 1) END) AS own_near,
            MAX(CASE WHEN own = other THEN far / greatest(size - 1, 1) END) AS own_far,
            MIN(CASE WHEN own <> other THEN near / size END) AS other_near,
            MIN(CASE WHEN own <> other THEN far / size END) AS other_far,
            MAX(CASE WHEN own = other THEN size END) AS own_size
            FROM sums JOIN sizes ON sizes.c = sums.other GROUP BY customer_id)""",
        """bounds AS (SELECT own,
            CASE WHEN own_size = 1 THEN 0
                 ELSE (other_near - own_far) / greatest(other_near, own_far) END AS low,
            CASE WHEN own_size = 1 THEN 0
                 ELSE (other_far - own_near) / greatest(other_far, own_near) END AS high
            FROM parts)""",
    )
    + """SELECT ROUND((AVG(low) + AVG(high)) / 2, 6) AS silhouette,
         ROUND(AVG(low), 6) AS silhouette_low, ROUND(AVG(high), 6) AS silhouette_high,
         COUNT(*) AS n_rows, CAST(COUNT(DISTINCT own) AS INTEGER) AS n_clusters FROM bounds""",
    "score_single": _with(
        _ORDERS,
        _RFM,
        _moments("rfm"),
        _batch(
            "orders_tx", f"({_reason('1996-01-01', '2000-06-30')}) IS NULL", customer="'00001'"
        ),
        _scored_by_centres("batch"),
    )
    + 'SELECT customer_id, Recency, Frequency, Monetary, cluster AS "Cluster" FROM placed',
    "score_batch": _with(*_SCORED_BATCH, _moments("rfm"), _scored_by_centres("batch"))
    + _profile_of(_PLACED, '"Cluster"', 4),
    "score_batch_rescaled": _with(*_SCORED_BATCH, _moments("batch"), _scored_by_centres("batch"))
    + _profile_of(_PLACED, '"Cluster"', 4),
    "score_customers": _with(*_SCORED_BATCH, _moments("rfm"), _scored_by_centres("batch"))
    + """SELECT customer_id, Recency, Frequency, Monetary, cluster AS "Cluster",
         CAST(4 AS INTEGER) AS "Number of Clusters" FROM placed""",
    "select_model": _with(*_SCORE_TABLES)
    + f"""SELECT "Model", n_segments, (SELECT COUNT(*) FROM rfm) AS n_customers,
          CAST(3 AS BIGINT) AS n_compared
          FROM (SELECT 'RFM' AS "Model", COUNT(DISTINCT {_LEVEL[4]}) AS n_segments FROM scored
                UNION ALL SELECT 'KMeans', CAST(4 AS BIGINT)
                UNION ALL SELECT 'Hierarchical', CAST(4 AS BIGINT))""",
    "stream_scoring": _with(
        _EVENTS,
        _rfm_of("event_tx", where=_CLEAN),
        _moments("rfm"),
        _rfm_of(
            "event_tx", as_of="2024-01-31", where=f"({_EVENT_REASON}) IS NULL"
        ).replace("rfm AS", "live AS"),
        _scored_by_centres("live"),
    )
    + 'SELECT customer_id, Recency, Frequency, Monetary, cluster AS "Cluster" FROM placed',
    "cluster_profile": _with(*_NEAREST_TABLES) + _profile_of(_NAMED_CLUSTERS, '"Cluster"', 4),
    "cluster_profile_2dp": _with(*_NEAREST_TABLES)
    + _profile_of(_NAMED_CLUSTERS, '"Cluster"', 4, digits=2),
    "sse_k1": _with(_ORDERS, _RFM, _STANDARDIZED)
    + """SELECT ROUND(SUM((zr - ar) ^ 2 + (zf - af) ^ 2 + (zm - am) ^ 2), 4) AS sse
         FROM standardized,
              (SELECT AVG(zr) AS ar, AVG(zf) AS af, AVG(zm) AS am FROM standardized)""",
    "silhouette_euclidean": _with(
        *_PAIRWISE,
    )
    + """SELECT ROUND(AVG(CASE WHEN own_size = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6)
         AS silhouette, COUNT(*) AS n_rows, CAST(COUNT(DISTINCT own) AS INTEGER) AS n_clusters
         FROM parts""",
    "silhouette_tolerance": _with(*_PAIRWISE)
    + """SELECT ROUND(AVG(CASE WHEN own_size = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6)
         AS silhouette, COUNT(*) AS n_rows, TRUE AS enclosed, TRUE AS within_tolerance
         FROM parts""",
    "silhouette_squared": _with(
        *_NEAREST_TABLES,
        """sums AS (SELECT a.customer_id, a.cluster AS own, b.cluster AS other,
                    SUM((a.zr - b.zr) ^ 2 + (a.zf - b.zf) ^ 2 + (a.zm - b.zm) ^ 2) AS total,
                    COUNT(*) AS size
                    FROM nearest a CROSS JOIN nearest b GROUP BY 1, 2, 3)""",
        """parts AS (SELECT customer_id,
                     MAX(CASE WHEN own = other THEN total / greatest(size - 1, 1) END) AS a,
                     MIN(CASE WHEN own <> other THEN total / size END) AS b,
                     MAX(CASE WHEN own = other THEN size END) AS own_size
                     FROM sums GROUP BY customer_id)""",
    )
    + """SELECT ROUND(AVG(CASE WHEN own_size = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6)
         AS silhouette, COUNT(*) AS n_rows FROM parts""",
    "combined_results": _with(*_SCORE_TABLES, _STANDARDIZED, _NEAREST)
    + f"""SELECT RFM_level AS "Cluster", * EXCLUDE (RFM_level, "Number of Clusters"),
          'RFM' AS "Model" FROM ({_rfm_profile(4)})
          UNION ALL BY NAME
          SELECT * EXCLUDE ("Number of Clusters"), 'Nearest' AS "Model"
          FROM ({_profile_of(_NAMED_CLUSTERS, '"Cluster"', 4)})""",
    "stream_rfm": _with(
        _EVENTS, _rfm_of("event_tx", as_of="2024-01-31", where=f"({_EVENT_REASON}) IS NULL")
    )
    + f"SELECT {_RFM_OUTPUT} FROM rfm",
    "stream_levels": _with(
        _EVENTS,
        _rfm_of("event_tx", as_of="2024-01-31", where=f"({_EVENT_REASON}) IS NULL"),
        _RANKED,
        _SCORED,
    )
    + f'SELECT {_RFM_OUTPUT}, R, F, M, {_LEVEL[4]} AS "RFM_level" FROM scored',
    "stream_rejects": _with(_EVENTS)
    + f"""SELECT {_TRANSACTION_OUTPUT}, {_EVENT_REASON} AS reject_reason FROM event_tx
          WHERE ({_EVENT_REASON}) IS NOT NULL""",
}
for _k, _case in _LEVEL.items():
    ORACLES[f"rfm_level_k{_k}"] = (
        _with(*_SCORE_TABLES) + f"SELECT customer_id, {_case} AS RFM_level FROM scored"
    )
    ORACLES[f"rfm_profile_k{_k}"] = _with(*_SCORE_TABLES) + _rfm_profile(_k)
