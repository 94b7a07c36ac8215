"""ANSI SQL over the test tables that states what every query must return.

The texts are put together from named pieces but share nothing with the DataFrame code: bands are
plain interval conditions and metrics plain ``GROUP BY`` statements, one per metric.
"""

from __future__ import annotations

ITEMS = """items AS (
  SELECT l_orderkey, CAST(count(*) AS DOUBLE) AS n_items, sum(l_quantity) AS sum_qty,
         max(l_discount) AS max_discount
  FROM lineitem GROUP BY l_orderkey)"""

SCORED = """scored AS (
  SELECT o.o_orderkey AS id, o.o_custkey AS ref_no, o.o_orderdate AS created_at,
    CASE WHEN o.o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'APP_A'
         WHEN o.o_orderpriority IN ('3-MEDIUM','4-NOT SPECIFIED') THEN 'APP_B' ELSE 'WEB_AGG' END AS platform,
    CASE WHEN c.c_mktsegment IN ('BUILDING','MACHINERY') THEN 'REPEAT' ELSE 'NEW' END AS user_type,
    CASE WHEN o.o_orderkey % 97 = 0 THEN NULL WHEN o.o_orderkey % 89 = 0 THEN 0e0
         ELSE (o.o_totalprice - 5000e0) / 450000e0 END AS output_value,
    CASE WHEN o.o_orderstatus = 'F' THEN 'FINAL_APPROVED' WHEN o.o_orderstatus = 'O' THEN 'COND_APPROVED'
         WHEN o.o_orderkey % 2 = 0 THEN 'DENIED_1' ELSE 'DENIED_2' END AS status,
    CASE WHEN o.o_orderkey % 11 = 0 THEN 'none' WHEN o.o_orderkey % 13 = 0 THEN ' '
         WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE c.c_mktsegment END AS employment_type,
    CASE WHEN o.o_orderkey % 19 = 0 THEN 'n/a' ELSE CAST(680 + c.c_custkey % 100 AS VARCHAR) END AS bureau_score,
    CAST(o.o_orderkey % 12 AS DOUBLE) AS tenure,
    CAST(c.c_custkey % 90 AS DOUBLE) AS bureau_vintage,
    CAST(o.o_orderkey % 4 - 1 AS DOUBLE) AS no_of_cc_loan_entries,
    CAST(o.o_orderkey % 14 AS DOUBLE) AS unsecured_enquiries_in_last_1_mon,
    CAST(c.c_custkey % 16 AS DOUBLE) AS months_since_last_90_dpd,
    CASE WHEN o.o_orderkey % 23 = 0 THEN NULL WHEN o.o_orderkey % 29 = 0 THEN NULL
         ELSE CAST(o.o_orderkey % 4 AS VARCHAR) END AS active_cc_count,
    CASE WHEN o.o_orderkey % 23 = 0 THEN NULL WHEN o.o_orderkey % 29 = 0 THEN NULL
         ELSE CAST(o.o_orderkey % 8 AS VARCHAR) END AS active_pl_count,
    CASE WHEN o.o_orderkey % 23 = 0 THEN 'bad' WHEN o.o_orderkey % 29 = 0 THEN NULL
         ELSE concat('{"active_cc_count": ', CAST(o.o_orderkey % 4 AS VARCHAR), ', "active_pl_count": "',
                     CAST(o.o_orderkey % 8 AS VARCHAR), '"}') END AS bureau_json,
    i.n_items, i.sum_qty, i.max_discount, c.c_acctbal AS acctbal, o.o_totalprice AS totalprice
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN items i ON i.l_orderkey = o.o_orderkey)"""

SCORE_CUTS = ["0.0", "0.1", "0.2", "0.3", "0.4", "0.5", "0.6", "0.7", "0.8", "0.9", "1.0"]
SCORE_BAND = (
    "CASE "
    + " ".join(
        f"WHEN output_value >= {low}e0 AND output_value < {high}e0 THEN {band}"
        for band, (low, high) in enumerate(zip(SCORE_CUTS, SCORE_CUTS[1:]), start=1)
    )
    + " ELSE NULL END"
)
INVALID_LABEL = """CASE WHEN output_value IS NULL THEN 'NULL' WHEN output_value < 0 THEN '<0'
  WHEN output_value = 0 THEN '=0' WHEN output_value >= 1 THEN '>=1' ELSE '0-1' END"""

# Feature bands with the outermost edges dropped, as the edges in the stand-in's metadata give them.
FEATURE_BANDS = {
    "sum_qty": "CASE WHEN v <= 20e0 THEN 1 WHEN v > 20e0 AND v <= 80e0 THEN 2 "
    "WHEN v > 80e0 AND v <= 150e0 THEN 3 WHEN v > 150e0 THEN 4 END",
    "max_discount": "CASE WHEN v <= 0.05e0 THEN 1 WHEN v > 0.05e0 THEN 2 END",
    "n_items": "CASE WHEN v <= 5e0 THEN 1 WHEN v > 2e0 THEN 2 END",
    "acctbal": "CASE WHEN v <= 0e0 THEN 1 WHEN v > 0e0 AND v <= 1000e0 THEN 2 "
    "WHEN v > 1000e0 AND v <= 2500e0 THEN 3 WHEN v > 2500e0 AND v <= 5000e0 THEN 4 "
    "WHEN v > 5000e0 AND v <= 7500e0 THEN 5 WHEN v > 7500e0 THEN 6 END",
}
FILLS = {"sum_qty": "-1e0", "max_discount": "0e0", "n_items": "1e0", "acctbal": "0e0", "totalprice": "0e0"}

SEGMENT_LABELS = {
    "employment_type": "CASE WHEN employment_type IS NULL OR employment_type = ' ' "
    "OR employment_type = 'none' THEN 'NA' ELSE employment_type END",
    "bureau_score": "CASE WHEN v >= 750 THEN '750+' WHEN v < 720 THEN '<720' "
    "WHEN v >= 720 AND v < 750 THEN '[720,750)' ELSE 'NA' END",
    "tenure": "CASE WHEN v < 6 THEN '<6' WHEN v >= 6 AND v <= 8 THEN '6-8' WHEN v > 8 THEN '>8' ELSE 'NA' END",
    "bureau_vintage": "CASE WHEN v < 12 THEN '<12' WHEN v >= 12 AND v <= 60 THEN '12-60' "
    "WHEN v > 60 THEN '>60' ELSE 'NA' END",
    "no_of_cc_loan_entries": "CASE WHEN v = 1 THEN '1CC' WHEN v > 1 THEN '1+CC' WHEN v = 0 THEN 'No CC' ELSE 'NA' END",
    "active_cc_count": "CASE WHEN v < 1 THEN '<1' WHEN v >= 1 THEN '1 or 1+' ELSE 'NA' END",
    "active_pl_count": "CASE WHEN v < 1 THEN '<1' WHEN v >= 1 AND v <= 5 THEN '1-5' WHEN v > 5 THEN '>5' ELSE 'NA' END",
    "unsecured_enquiries_in_last_1_mon": "CASE WHEN v < 1 THEN '<1' WHEN v >= 1 AND v <= 10 THEN '1-10' "
    "WHEN v > 10 THEN '10+' ELSE 'NA' END",
    "months_since_last_90_dpd": "CASE WHEN v < 1 THEN '<1' WHEN v >= 1 AND v <= 12 THEN '1-12' "
    "WHEN v > 12 THEN '12+' ELSE 'NA' END",
}

POP = "platform, user_type"


def over_scored(body: str) -> str:
    return f"WITH {ITEMS},\n{SCORED}\n{body}"


def segment_rows(name: str) -> str:
    """(platform, user_type, segment_band, cnt) of one segment."""
    return f"""SELECT {POP}, {SEGMENT_LABELS[name]} AS segment_band, count(*) AS cnt
FROM (SELECT *, try_cast({name} AS DOUBLE) AS v FROM scored) s GROUP BY 1, 2, 3"""


def feature_rows(name: str) -> str:
    """(platform, user_type, feature, feature_band, cnt) of one feature, missing values filled."""
    return f"""SELECT {POP}, '{name}' AS feature, {FEATURE_BANDS[name]} AS feature_band, count(*) AS cnt
FROM (SELECT {POP}, coalesce({name}, {FILLS[name]}) AS v FROM scored) s GROUP BY 1, 2, 4"""


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


ALL_FEATURE_ROWS = union([feature_rows(name) for name in FEATURE_BANDS])
ALL_SEGMENT_ROWS = union(
    [
        f"SELECT {POP}, '{name}' AS value_name, segment_band, cnt FROM ({segment_rows(name)}) x"
        for name in SEGMENT_LABELS
    ]
)
CSI_ROWS = f"""SELECT {POP}, feature, feature_band,
  cnt, round(CAST(cnt AS DOUBLE) / CAST(sum(cnt) OVER (PARTITION BY {POP}, feature) AS BIGINT) * 100e0, 4) AS pct
FROM ({ALL_FEATURE_ROWS}) f"""
NULL_ROWS = union(
    [
        f"SELECT {POP}, '{name}' AS feature, count(*) FILTER (WHERE {name} IS NULL OR {name} = {fill}) AS null_count, "
        f"count(*) AS total_count FROM scored GROUP BY 1, 2"
        for name, fill in FILLS.items()
    ]
)
DISTINCT_ROWS = union(
    [
        f"SELECT {POP}, '{name}' AS feature, count(DISTINCT {name}) AS distinct_count, "
        f"count(*) AS total_count FROM scored GROUP BY 1, 2"
        for name in FILLS
    ]
)
BAND_ROWS = f"""SELECT {POP}, {SCORE_BAND} AS model_band, count(id) AS cnt,
  count(*) FILTER (WHERE status = 'FINAL_APPROVED') AS fa, count(*) FILTER (WHERE status = 'COND_APPROVED') AS ca,
  count(*) FILTER (WHERE status = 'DENIED_1') AS d1, count(*) FILTER (WHERE status = 'DENIED_2') AS d2
FROM scored GROUP BY 1, 2, 3"""
INVALID_ROWS = f"""SELECT p.platform, p.user_type, d.band_no, d.band_name, count(s.id) AS cnt
FROM (SELECT DISTINCT {POP} FROM scored) p
JOIN (SELECT 1 AS band_no, '<0' AS band_name UNION ALL SELECT 2, '=0' UNION ALL SELECT 3, '0-1'
      UNION ALL SELECT 4, '>=1' UNION ALL SELECT 5, 'NULL') d ON TRUE
LEFT JOIN (SELECT {POP}, id, {INVALID_LABEL} AS band_name FROM scored) s
  ON s.platform = p.platform AND s.user_type = p.user_type AND s.band_name = d.band_name
GROUP BY 1, 2, 3, 4"""
RATIO_ROWS = f"""SELECT {POP}, model_band,
  CASE WHEN fa = 0 THEN 0e0 ELSE CAST(ca AS DOUBLE) / fa END AS ca_fa,
  CASE WHEN fa = 0 THEN 0e0 ELSE CAST(d1 AS DOUBLE) / fa END AS d1_fa
FROM ({BAND_ROWS}) b"""

RESULT_ROWS = f"""SELECT sha256(CAST(to_json(['MODEL_X', platform, user_type, metric_name, value_name]) AS VARCHAR)) AS benchmark_id,
  'MODEL_X' AS model_name, {POP}, metric_name, value_name, band_label, cnt,
  CAST(sum(cnt) OVER (PARTITION BY {POP}, metric_name, value_name) AS BIGINT) AS total_count, TRUE AS is_active
FROM (
SELECT {POP}, 'PSI' AS metric_name, 'total_population' AS value_name, CAST(model_band AS VARCHAR) AS band_label, cnt
FROM ({BAND_ROWS}) b
UNION ALL
SELECT {POP}, 'SEGMENT_DISTRIBUTION', value_name, segment_band, cnt FROM ({ALL_SEGMENT_ROWS}) s) x"""


def long_rows() -> str:
    """Every metric in one long table; doubles are rounded to 6 digits."""
    parts = [
        f"SELECT {POP}, 'PSI' AS metric_name, 'score' AS value_name, CAST(model_band AS VARCHAR) AS band_label, "
        f"round(CAST(cnt AS DOUBLE) / CAST(sum(cnt) OVER (PARTITION BY {POP}) AS BIGINT) * 100e0, 3) AS metric_value, "
        f"CAST(sum(cnt) OVER (PARTITION BY {POP}) AS DOUBLE) AS total FROM bands"
    ]
    for metric in ("PSI", "DRIFT_IN_MB"):
        parts.append(
            f"SELECT {POP}, '{metric}', 'total_population', CAST(model_band AS VARCHAR), CAST(cnt AS DOUBLE), "
            f"CAST(sum(cnt) OVER (PARTITION BY {POP}) AS DOUBLE) FROM bands"
        )
    for status in ("fa", "ca", "d1", "d2"):
        parts.append(
            f"SELECT {POP}, 'DRIFT_IN_MB', '{status}', CAST(model_band AS VARCHAR), CAST({status} AS DOUBLE), "
            f"CAST(sum({status}) OVER (PARTITION BY {POP}) AS DOUBLE) FROM bands"
        )
    for ratio in ("ca_fa", "d1_fa"):
        parts.append(
            f"SELECT {POP}, 'DRIFT_IN_MB', '{ratio.replace('_', '/')}', CAST(model_band AS VARCHAR), "
            f"round({ratio}, 6), round(sum({ratio}) OVER (PARTITION BY {POP}), 6) FROM ratios"
        )
    parts.append(
        f"SELECT {POP}, 'CSI', feature, CAST(feature_band AS VARCHAR), pct, "
        f"round(sum(pct) OVER (PARTITION BY {POP}, feature), 6) FROM shares"
    )
    parts.append(
        f"SELECT {POP}, 'FEATURE_RANGE_DRIFT', feature, CAST(feature_band AS VARCHAR), CAST(cnt AS DOUBLE), "
        f"CAST(sum(cnt) OVER (PARTITION BY {POP}, feature) AS DOUBLE) FROM shares"
    )
    parts.append(
        f"SELECT {POP}, 'NULL_RATE', feature, CAST(NULL AS VARCHAR), CAST(null_count AS DOUBLE), "
        f"CAST(total_count AS DOUBLE) FROM ({NULL_ROWS}) n"
    )
    parts.append(
        f"SELECT {POP}, 'DISTINCT_RATE', feature, CAST(NULL AS VARCHAR), CAST(distinct_count AS DOUBLE), "
        f"CAST(total_count AS DOUBLE) FROM ({DISTINCT_ROWS}) d"
    )
    parts.append(
        f"SELECT {POP}, 'SEGMENT_DISTRIBUTION', value_name, segment_band, CAST(cnt AS DOUBLE), "
        f"CAST(sum(cnt) OVER (PARTITION BY {POP}, value_name) AS DOUBLE) FROM ({ALL_SEGMENT_ROWS}) s"
    )
    parts.append(
        f"SELECT {POP}, 'INVALID_SCORE', 'total_population', band_name, CAST(cnt AS DOUBLE), "
        f"CAST(sum(cnt) OVER (PARTITION BY {POP}) AS DOUBLE) FROM ({INVALID_ROWS}) i"
    )
    return union(parts)


LONG = (
    f"WITH {ITEMS},\n{SCORED},\nbands AS ({BAND_ROWS}),\nratios AS ({RATIO_ROWS}),\n"
    f"shares AS ({CSI_ROWS})\n{long_rows()}"
)

# Two sources: the first has one platform, the second gets its platform from the kind of event.
PREPARED = """SELECT c.c_custkey AS id, c.c_custkey AS bureau_reference_number, c.c_acctbal AS acctbal,
  o.n_orders, o.max_price AS v30_pred_prob, e.ts AS created_at, e.props AS new_bureau_variables, {platform} AS platform
FROM customer c
JOIN (SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS max_price FROM orders GROUP BY 1) o
  ON o.o_custkey = c.c_custkey
JOIN (SELECT user_id, ts, event_type, props FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
        FROM events WHERE {which}) z WHERE rn = 1) e ON e.user_id = c.c_custkey"""
PREPARED_A = PREPARED.format(platform="'APP_A'", which="event_type IN ('view','click')")
PREPARED_B = PREPARED.format(
    platform="CASE WHEN e.event_type = 'purchase' THEN 'APP_B' ELSE 'WEB_AGG' END",
    which="event_type NOT IN ('view','click')",
)
PREPARED_ALL = PREPARED.format(
    platform="CASE WHEN e.event_type = 'purchase' THEN 'APP_B' ELSE 'WEB_AGG' END", which="TRUE"
)
MERGED = f"""SELECT id, created_at, platform, acctbal, n_orders, v30_pred_prob AS output_value,
  CASE WHEN json_valid(new_bureau_variables) THEN json_extract_string(new_bureau_variables, '$.k') END AS k
FROM ({PREPARED_A}
UNION ALL
{PREPARED_B}) m"""

# The latest event of a customer over both sources.
POPULATION_ROWS = """SELECT id, event_id, created_at, platform, user_type, acctbal, n_orders, output_value, status,
  CASE WHEN json_valid(props) THEN json_extract_string(props, '$.k') END AS k
FROM (
  SELECT c.c_custkey AS id, e.event_id, e.ts AS created_at, e.props, c.c_mktsegment AS user_type,
    CASE WHEN e.event_type IN ('view','click') THEN 'APP_A' WHEN e.event_type = 'purchase' THEN 'APP_B'
         ELSE 'WEB_AGG' END AS platform,
    c.c_acctbal AS acctbal, o.n_orders, o.output_value, o.status,
    row_number() OVER (PARTITION BY c.c_custkey ORDER BY e.ts DESC NULLS LAST, e.event_id DESC) AS rn
  FROM customer c
  JOIN (SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) / 500000e0 AS output_value,
          CASE WHEN max(o_orderstatus) = 'P' THEN 'FINAL_APPROVED' ELSE 'COND_APPROVED' END AS status
        FROM orders GROUP BY 1) o ON o.o_custkey = c.c_custkey
  JOIN (SELECT * FROM events WHERE event_type IS NOT NULL) e ON e.user_id = c.c_custkey) x WHERE rn = 1"""
CREATED = f"""WITH scored AS ({POPULATION_ROWS}),
shown AS (
  SELECT p.platform, p.user_type, r.no, coalesce(b.cnt, 0) AS cnt,
    CAST(sum(coalesce(b.cnt, 0)) OVER (PARTITION BY p.platform, p.user_type) AS BIGINT) AS total
  FROM (SELECT DISTINCT {POP} FROM scored) p CROSS JOIN range(0, 11) r(no)
  LEFT JOIN ({BAND_ROWS}) b ON b.platform = p.platform AND b.user_type = p.user_type
    AND coalesce(b.model_band, 0) = r.no),
results AS (
  SELECT {POP}, 'PSI' AS metric_name, 'total_population' AS value_name, '1,2,3,4,5,6,7,8,9,10' AS categories,
    '' AS cutpoints, string_agg(CAST(cnt * 1000 AS VARCHAR), ',' ORDER BY no) AS counts,
    CAST(max(total) AS DOUBLE) AS total_count FROM shown GROUP BY 1, 2
  UNION ALL
  SELECT {POP}, 'PSI', 'score', '', '0,100,200,300,400,500,600,700,800,900,1000',
    string_agg(CAST(CAST(round(round(CAST(cnt AS DOUBLE) / total * 100e0, 3) * 1000) AS BIGINT) AS VARCHAR), ','
      ORDER BY no), CAST(max(total) AS DOUBLE) FROM shown GROUP BY 1, 2
  UNION ALL
  SELECT {POP}, 'INVALID_SCORE', 'total_population', '<0,=0,0-1,>=1,NULL', '',
    string_agg(CAST(cnt * 1000 AS VARCHAR), ',' ORDER BY band_no), CAST(sum(cnt) AS DOUBLE)
  FROM ({INVALID_ROWS}) i GROUP BY 1, 2
  UNION ALL
  SELECT {POP}, 'NULL_RATE', 'acctbal', '', '',
    CAST(1000 * count(*) FILTER (WHERE acctbal IS NULL OR acctbal = 0e0) AS VARCHAR), CAST(count(*) AS DOUBLE)
  FROM scored GROUP BY 1, 2)
SELECT sha256(CAST(to_json(['MODEL_X', platform, user_type, metric_name, value_name, 'b']) AS VARCHAR)) AS benchmark_id,
  'MODEL_X' AS model_name, * FROM results"""

STORED = "SELECT platform, employment_type, count(*) AS n FROM scored GROUP BY 1, 2"
INCOMING = "SELECT platform, employment_type, count(*) AS n FROM scored WHERE platform = 'APP_A' GROUP BY 1, 2"


def oracle_sql() -> dict[str, str]:
    oracles = {
        "benchmark_long": LONG,
        "model_band_distribution": over_scored(
            f"SELECT {POP}, model_band, cnt, CAST(sum(cnt) OVER (PARTITION BY {POP}) AS BIGINT) AS total_count, "
            f"round(CAST(cnt AS DOUBLE) / CAST(sum(cnt) OVER (PARTITION BY {POP}) AS BIGINT) * 100e0, 3) AS pct "
            f"FROM ({BAND_ROWS}) b"
        ),
        "model_band_population": over_scored(
            f"SELECT {POP}, model_band, cnt, CAST(sum(cnt) OVER (PARTITION BY {POP}) AS BIGINT) AS total_count "
            f"FROM ({BAND_ROWS}) b"
        ),
        "status_trend": over_scored(
            union(
                [
                    f"SELECT {POP}, '{name}' AS value_name, model_band, {name} AS cnt, "
                    f"CAST(sum({name}) OVER (PARTITION BY {POP}) AS BIGINT) AS total_count FROM ({BAND_ROWS}) b"
                    for name in ("fa", "ca", "d1", "d2")
                ]
            )
        ),
        "status_ratio": over_scored(
            union(
                [
                    f"SELECT {POP}, '{name.replace('_', '/')}' AS value_name, model_band, round({name}, 6) AS ratio, "
                    f"round(sum({name}) OVER (PARTITION BY {POP}), 6) AS ratio_total FROM ({RATIO_ROWS}) r"
                    for name in ("ca_fa", "d1_fa")
                ]
            )
        ),
        "invalid_score": over_scored(f"SELECT {POP}, band_name, cnt FROM ({INVALID_ROWS}) i"),
        "csi": over_scored(f"SELECT {POP}, feature, feature_band, pct FROM ({CSI_ROWS}) c"),
        "feature_range_drift": over_scored(ALL_FEATURE_ROWS),
        "null_rate": over_scored(NULL_ROWS),
        "distinct_rate": over_scored(DISTINCT_ROWS),
        "segment_distribution": over_scored(ALL_SEGMENT_ROWS),
        "population_filter": over_scored(
            f"SELECT id, {POP} FROM scored WHERE platform = 'APP_A' AND user_type = 'NEW'"
        ),
        "platform_from_channel": over_scored(
            "SELECT id, CASE WHEN platform = 'APP_A' THEN 'A' ELSE 'OTHER' END AS p FROM scored"
        ),
        "feature_unpivot": over_scored(
            union(
                [
                    f"SELECT id, '{name}' AS feature, {name} AS value FROM scored"
                    for name in ("sum_qty", "max_discount", "acctbal")
                ]
            )
        ),
        "computed_key_join": over_scored(
            "SELECT s.id, c.c_name FROM scored s JOIN customer c "
            "ON concat('#', CAST(s.ref_no AS VARCHAR)) = concat('#', CAST(c.c_custkey AS VARCHAR))"
        ),
        "latest_per_key": "SELECT user_id, event_id, ts, event_type FROM (SELECT *, row_number() OVER "
        "(PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn FROM events) x WHERE rn = 1",
        "dedup_population": over_scored(
            f"SELECT id, ref_no, created_at, {POP}, output_value, status FROM (SELECT *, row_number() OVER "
            "(PARTITION BY ref_no ORDER BY created_at DESC NULLS LAST, id DESC) AS rn FROM scored) x WHERE rn = 1"
        ),
        "duplicate_count": over_scored(
            "SELECT count(*) AS row_count, count(*) - count(DISTINCT ref_no) AS duplicates FROM scored"
        ),
        "json_map_extract": over_scored(
            "SELECT id, CASE WHEN json_valid(bureau_json) THEN json_extract_string(bureau_json, '$.active_cc_count') END "
            "AS active_cc_count, CASE WHEN json_valid(bureau_json) THEN "
            "json_extract_string(bureau_json, '$.active_pl_count') END AS active_pl_count FROM scored"
        ),
        "prepare_source": PREPARED_ALL,
        "merge_sources": MERGED,
        "build_population": POPULATION_ROWS,
        "create_benchmark": f"SELECT *, TRUE AS is_active FROM ({CREATED}) r",
        "stored_benchmark": f"SELECT *, TRUE AS is_active FROM ({CREATED}) r UNION ALL "
        f"SELECT *, FALSE AS is_active FROM ({CREATED}) r WHERE platform = 'APP_A'",
        "store_snapshot": f"SELECT *, TRUE AS is_active FROM ({CREATED}) r",
        "row_null_count_dedup": over_scored(
            f"SELECT {POP}, id FROM (SELECT {POP}, id, row_number() OVER (PARTITION BY {POP} ORDER BY "
            "CASE WHEN output_value IS NULL THEN 1 ELSE 0 END + CASE WHEN employment_type IS NULL THEN 1 ELSE 0 END "
            "+ CASE WHEN sum_qty IS NULL THEN 1 ELSE 0 END, id) AS rn FROM scored) x WHERE rn = 1"
        ),
        "result_table": over_scored(RESULT_ROWS),
        "result_arrays": over_scored(
            f"SELECT {POP}, value_name, string_agg(segment_band, ',' ORDER BY segment_band) AS categories, "
            "string_agg(CAST(cnt AS VARCHAR), ',' ORDER BY segment_band) AS category_count, "
            f"CAST(sum(cnt) AS DOUBLE) AS total_count FROM ({ALL_SEGMENT_ROWS}) s GROUP BY 1, 2, 3"
        ),
        "result_texts": over_scored(
            f"SELECT {POP}, value_name, '[' || string_agg('\"' || segment_band || '\"', ',' ORDER BY segment_band) || ']' "
            "AS categories, '[' || string_agg(CAST(cnt AS VARCHAR) || '.0', ',' ORDER BY segment_band) || ']' "
            f"AS category_count FROM ({ALL_SEGMENT_ROWS}) s GROUP BY 1, 2, 3"
        ),
        "glob_read": "SELECT r_regionkey, r_name FROM region",
        "exported_query": "SELECT o_orderpriority, count(*) AS n, max(o_orderkey) AS last_key FROM orders GROUP BY 1",
        "created_stamp": over_scored(
            "SELECT '2024-01-31 08:00:00' AS benchmark_created_at, 'DAILY' AS tracking_type, 'MODEL_X' AS model_name, "
            f"count(*) AS n FROM ({RESULT_ROWS}) r"
        ),
        "store_upsert": over_scored(
            f"SELECT e.platform, e.employment_type, e.n, i.hit IS NULL AS is_active FROM ({STORED}) e LEFT JOIN "
            f"(SELECT platform, employment_type, 1 AS hit FROM ({INCOMING}) q) i "
            "ON e.platform IS NOT DISTINCT FROM i.platform AND e.employment_type IS NOT DISTINCT FROM i.employment_type "
            f"UNION ALL SELECT platform, employment_type, n + 1000 AS n, TRUE AS is_active FROM ({INCOMING}) q"
        ),
        "store_view": over_scored(
            f"SELECT * FROM ({RESULT_ROWS}) r WHERE platform = 'APP_B' AND metric_name = 'PSI' "
            "ORDER BY benchmark_id, band_label NULLS FIRST LIMIT 20"
        ),
        "store_fetch": over_scored(f"SELECT * FROM ({RESULT_ROWS}) r WHERE model_name = upper('model_x')"),
        "store_verify_counts": over_scored(
            f"SELECT {POP}, status = 'FINAL_APPROVED' AS is_active, count(*) AS row_count FROM scored GROUP BY 1, 2, 3"
        ),
    }
    oracles |= {f"segment_{short}": over_scored(segment_rows(name)) for short, name in SHORT_SEGMENTS.items()}
    return oracles


# Query names of the single segments.
SHORT_SEGMENTS = {
    "employment_type": "employment_type",
    "bureau_score": "bureau_score",
    "tenure": "tenure",
    "bureau_vintage": "bureau_vintage",
    "cc_entries": "no_of_cc_loan_entries",
    "active_cc": "active_cc_count",
    "active_pl": "active_pl_count",
    "enquiries": "unsecured_enquiries_in_last_1_mon",
    "dpd": "months_since_last_90_dpd",
}
