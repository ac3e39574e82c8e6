"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL is written in the direct, row-level form: the actual curve groups
the fanned-out join rows, the planned curve explodes every schedule day and
the forecast joins rows to their per-key total. The Spark plans use the
optimized forms (pre-aggregation, percent-key jump, day totals), so agreement
checks the rewrites too. Exact decimals are cast to DOUBLE in the final
projection, as the Spark side reports them.
"""

from __future__ import annotations

from ..sources.fixtures import AS_OF

_AS_OF_TS = f"TIMESTAMP '{AS_OF.isoformat()} 00:00:00'"
_AS_OF_DATE = f"DATE '{AS_OF.isoformat()}'"
_K = "PROJECT_NUMBER, STAGE, SUB_STAGE"
_KW = f"PARTITION BY {_K}"


def _on(a: str, b: str) -> str:
    return " AND ".join(f"{a}.{c} = {b}.{c}" for c in ("PROJECT_NUMBER", "STAGE", "SUB_STAGE"))


# The adapter over lineitem + part (FIXTURES.md section 2), then the curves.
_CTES = f"""
base AS (
  SELECT l.l_suppkey AS sk, CAST(l.l_suppkey AS VARCHAR) AS project, l.l_returnflag AS stage,
         p.p_type AS sub, l.l_linestatus AS fund,
         CAST(CAST(l.l_shipdate AS DATE) AS TIMESTAMP) AS d, l.l_linenumber AS ln,
         CAST(CAST(l.l_extendedprice AS DECIMAL(16,2)) + l.l_linenumber * 0.0013 AS DECIMAL(18,4)) AS cost
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
act_rows AS (
  SELECT * FROM base WHERE (d <= {_AS_OF_TS} OR sk % 10 = 4) AND NOT (sk % 10 = 1 AND stage = 'N')),
invoice_t AS (
  SELECT CASE WHEN NOT (sk % 10 = 0 AND ln = 3 AND stage = 'N') THEN project END AS PROJECTID,
         stage AS STAGEPHASE_CODE, sub AS SUBSTAGEACTIVITY_CODE,
         CASE WHEN NOT (sk % 10 = 0 AND ln = 3 AND stage = 'A') THEN d END AS INVOICE_DATE,
         cost AS ACTUALS_COST FROM act_rows WHERE ln <= 3),
pay_app_t AS (
  SELECT project AS PROJECTID, stage AS STAGEPHASE_CODE, sub AS SUBSTAGEACTIVITY_CODE, d AS INVOICE_DATE,
         CASE WHEN sk % 10 = 1 AND ln = 5 THEN 'n/a' ELSE CAST(cost AS VARCHAR) END AS ACTUALS_COST
  FROM act_rows WHERE ln >= 4 AND d <= {_AS_OF_TS} - INTERVAL 30 DAY),
pay_req_t AS (
  SELECT project AS PROJECTID, stage AS STAGEPHASE_CODE, sub AS SUBSTAGEACTIVITY_CODE,
         d AS INVOICE_DATE,
         CAST(CASE WHEN ln = 1 AND stage = 'R' THEN -cost ELSE cost * -1.5 END AS DECIMAL(18,4)) AS ACTUALS_COST
  FROM act_rows WHERE (ln = 1 AND stage = 'R') OR (ln = 2 AND stage = 'A' AND sk % 10 = 2)),
budget_t AS (
  SELECT project AS PROJECT_NUMBER, stage AS STAGE, sub AS SUB_STAGE, fund AS FUND,
         CAST(CASE WHEN sk % 10 = 3 THEN NULL
                   ELSE SUM(cost) * (80 + (sk * 7) % 50) * 0.01 END AS DECIMAL(20,4))
           AS BUDGET_CURRENT_APPROVED
  FROM base WHERE sk % 10 <> 7 GROUP BY sk, project, stage, sub, fund),
sched_keys AS (
  SELECT sk, project, stage, sub,
         CASE WHEN sk % 10 = 6 THEN MAX(d) - INTERVAL 40 DAY ELSE MAX(d) END AS e,
         CASE WHEN sk % 10 = 9 THEN 0 ELSE 60 + (sk * 37 + ascii(stage) * 11) % 500 END AS n
  FROM base GROUP BY sk, project, stage, sub),
schedule_t AS (
  SELECT project AS PROJECTID, stage AS STAGECODE, sub AS STAGESUBSTAGECODE,
         e - to_days(CAST(n AS INTEGER)) AS CURRENTSTART,
         CASE WHEN sk % 10 = 8 AND stage = 'N' THEN NULL ELSE e END AS CURRENTEND
  FROM sched_keys
  UNION ALL
  SELECT project, stage, sub, e - to_days(CAST(n AS INTEGER)) + to_days(5), e
  FROM sched_keys WHERE sk % 10 = 5 AND stage = 'A'),
curve_k AS (
  SELECT p_type, unnest(range(0, 101)) AS k FROM (SELECT DISTINCT p_type FROM part)),
curve_t AS (
  SELECT p_type || ' - phase' AS SUBSTAGES,
         k / 100 + CASE WHEN k % 2 = 1 THEN CAST(0.002 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS PERCENT_COMPLETIONTIME,
         CASE WHEN p_type = 'PROMO' AND k = 50 THEN NULL
              ELSE CAST(CAST(k * k * (300 - 2 * k) AS DECIMAL(9,0)) * 0.000001 + k * 0.0000000123 AS DECIMAL(18,10)) END
           AS NORM_PERCENT_CUMSPENT
  FROM curve_k WHERE NOT (p_type = 'SMALL' AND k = 37)
  UNION ALL
  SELECT p_type || ' - phase', k / 100 + CAST(0.004 AS DOUBLE), CAST(0.9 AS DECIMAL(18,10))
  FROM curve_k WHERE k % 10 = 0),
actuals_u AS (
  SELECT PROJECTID AS PROJECT_NUMBER, STAGEPHASE_CODE AS STAGE, SUBSTAGEACTIVITY_CODE AS SUB_STAGE,
         INVOICE_DATE, CAST(ACTUALS_COST AS DECIMAL(38,10)) AS ACTUALS_COST FROM invoice_t
  UNION ALL
  SELECT PROJECTID, STAGEPHASE_CODE, SUBSTAGEACTIVITY_CODE, INVOICE_DATE,
         COALESCE(TRY_CAST(ACTUALS_COST AS DECIMAL(38,10)), 0) FROM pay_app_t
  UNION ALL
  SELECT PROJECTID, STAGEPHASE_CODE, SUBSTAGEACTIVITY_CODE, INVOICE_DATE, CAST(ACTUALS_COST AS DECIMAL(38,10)) FROM pay_req_t),
budget_k AS (
  SELECT {_K}, CAST(SUM(BUDGET_CURRENT_APPROVED) AS DECIMAL(28,4)) AS BUDGET_CURRENT_APPROVED
  FROM budget_t GROUP BY {_K}),
schedule_c AS (
  SELECT PROJECTID AS PROJECT_NUMBER, STAGECODE AS STAGE, STAGESUBSTAGECODE AS SUB_STAGE,
         CURRENTSTART, CURRENTEND FROM schedule_t),
enriched AS (
  SELECT a.PROJECT_NUMBER, a.STAGE, a.SUB_STAGE, a.INVOICE_DATE, a.ACTUALS_COST,
         b.BUDGET_CURRENT_APPROVED, s.CURRENTSTART, s.CURRENTEND
  FROM actuals_u a
  LEFT JOIN budget_k b ON {_on('a', 'b')}
  LEFT JOIN schedule_c s ON {_on('a', 's')}),
net AS (
  SELECT {_K}, INVOICE_DATE,
         CAST(SUM(COALESCE(ACTUALS_COST, 0)) AS DECIMAL(38,10)) AS ACTUALS_COST,
         first(BUDGET_CURRENT_APPROVED ORDER BY CURRENTSTART NULLS LAST, CURRENTEND NULLS LAST)
           FILTER (WHERE BUDGET_CURRENT_APPROVED IS NOT NULL) AS BUDGET_CURRENT_APPROVED,
         first(CURRENTSTART ORDER BY CURRENTSTART NULLS LAST, CURRENTEND NULLS LAST)
           FILTER (WHERE CURRENTSTART IS NOT NULL) AS CURRENTSTART,
         first(CURRENTEND ORDER BY CURRENTSTART NULLS LAST, CURRENTEND NULLS LAST)
           FILTER (WHERE CURRENTEND IS NOT NULL) AS CURRENTEND
  FROM enriched
  WHERE PROJECT_NUMBER IS NOT NULL AND STAGE IS NOT NULL AND SUB_STAGE IS NOT NULL
    AND INVOICE_DATE IS NOT NULL
  GROUP BY {_K}, INVOICE_DATE
  HAVING SUM(COALESCE(ACTUALS_COST, 0)) <> 0),
actual_v AS (
  SELECT {_K}, INVOICE_DATE, ACTUALS_COST, BUDGET_CURRENT_APPROVED, CURRENTSTART, CURRENTEND,
         CAST(SUM(ACTUALS_COST) OVER ({_KW} ORDER BY INVOICE_DATE
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,10))
           AS CUMULATIVE_ACTUAL_COST
  FROM net),
daily AS (
  SELECT {_K}, INVOICE_DATE, CAST(SUM(ACTUALS_COST) AS DECIMAL(38,10)) AS ACTUALS_COST
  FROM actuals_u
  WHERE PROJECT_NUMBER IS NOT NULL AND STAGE IS NOT NULL AND SUB_STAGE IS NOT NULL AND INVOICE_DATE IS NOT NULL
  GROUP BY {_K}, INVOICE_DATE HAVING SUM(ACTUALS_COST) <> 0),
curve_pts AS (
  SELECT NULLIF(regexp_extract(SUBSTAGES, '^([A-Z0-9]+)', 1), '') AS SUB_STAGE,
         CAST(round_even(PERCENT_COMPLETIONTIME * 100, 0) AS BIGINT) AS PCT_KEY,
         PERCENT_COMPLETIONTIME AS RAW_PERCENT, NORM_PERCENT_CUMSPENT
  FROM curve_t),
curve_lk AS (
  SELECT SUB_STAGE, PCT_KEY,
         first(NORM_PERCENT_CUMSPENT ORDER BY RAW_PERCENT, NORM_PERCENT_CUMSPENT NULLS LAST) AS CURVE_VALUE
  FROM curve_pts WHERE SUB_STAGE IS NOT NULL AND PCT_KEY IS NOT NULL
  GROUP BY SUB_STAGE, PCT_KEY),
p_in AS (
  SELECT b.PROJECT_NUMBER, b.STAGE, b.SUB_STAGE,
         CAST(COALESCE(b.BUDGET_CURRENT_APPROVED, 0) AS DECIMAL(28,4)) AS BUDGET_CURRENT_APPROVED,
         s.CURRENTSTART, s.CURRENTEND,
         row_number() OVER (PARTITION BY b.PROJECT_NUMBER, b.STAGE, b.SUB_STAGE
                            ORDER BY s.CURRENTSTART NULLS LAST, s.CURRENTEND NULLS LAST) AS rn
  FROM budget_k b JOIN schedule_c s ON {_on('b', 's')}),
p_days AS (
  SELECT *, (epoch_us(CURRENTEND) - epoch_us(CURRENTSTART)) // 86400000000 + 1 AS DURATION
  FROM p_in WHERE rn = 1 AND CURRENTSTART < CURRENTEND),
p_exp AS (
  SELECT {_K}, BUDGET_CURRENT_APPROVED, CURRENTSTART, DURATION,
         unnest(range(0, DURATION)) AS DAY
  FROM p_days),
p_key AS (
  SELECT *,
         CAST(round(CAST(printf('%.2f', CAST(DAY AS DOUBLE) / DURATION) AS DOUBLE) * 100) AS BIGINT) AS PCT_KEY
  FROM p_exp),
p_daily AS (
  SELECT k.PROJECT_NUMBER, k.STAGE, k.SUB_STAGE,
         k.CURRENTSTART + to_days(CAST(k.DAY AS INTEGER)) AS DATE,
         CASE WHEN c.PCT_KEY IS NULL THEN CAST(0 AS DECIMAL(18,10)) ELSE c.CURVE_VALUE END
           AS NORMALIZED_PERCENT,
         CAST((CASE WHEN c.PCT_KEY IS NULL THEN CAST(0 AS DECIMAL(18,10)) ELSE c.CURVE_VALUE END)
              * CAST(k.BUDGET_CURRENT_APPROVED AS DECIMAL(19,4)) AS DECIMAL(38,14)) AS PLANNED_CURVE_VALUE
  FROM p_key k LEFT JOIN curve_lk c ON k.SUB_STAGE = c.SUB_STAGE AND k.PCT_KEY = c.PCT_KEY),
p_first AS (
  SELECT {_K}, NORMALIZED_PERCENT, MIN(DATE) AS DATE,
         arg_min(PLANNED_CURVE_VALUE, DATE) AS PLANNED_CURVE_VALUE
  FROM p_daily WHERE NORMALIZED_PERCENT IS NOT NULL
  GROUP BY {_K}, NORMALIZED_PERCENT),
planned_v AS (
  SELECT {_K}, NORMALIZED_PERCENT, DATE, PLANNED_CURVE_VALUE,
         CAST(SUM(PLANNED_CURVE_VALUE) OVER ({_KW} ORDER BY DATE
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,14))
           AS CUMULATIVE_PLANNED_CURVE
  FROM p_first),
a_sum AS (
  SELECT {_K}, CAST(SUM(ACTUALS_COST) AS DECIMAL(38,10)) AS TOTAL_ACTUAL_COST,
         MAX(BUDGET_CURRENT_APPROVED) AS BUDGET_CURRENT_APPROVED
  FROM actual_v GROUP BY {_K}),
a_last AS (
  SELECT {_K}, INVOICE_DATE, CUMULATIVE_ACTUAL_COST FROM (
    SELECT *, row_number() OVER ({_KW} ORDER BY INVOICE_DATE DESC) AS rn FROM actual_v)
  WHERE rn = 1),
f_join AS (
  SELECT p.PROJECT_NUMBER, p.STAGE, p.SUB_STAGE, p.DATE, p.NORMALIZED_PERCENT,
         p.PLANNED_CURVE_VALUE, p.CUMULATIVE_PLANNED_CURVE,
         s.TOTAL_ACTUAL_COST, s.BUDGET_CURRENT_APPROVED, l.INVOICE_DATE, l.CUMULATIVE_ACTUAL_COST
  FROM planned_v p
  JOIN a_sum s ON {_on('p', 's')}
  JOIN a_last l ON {_on('p', 'l')}
  WHERE p.DATE > {_AS_OF_TS}),
f_dist AS (
  SELECT {_K}, CAST(SUM(PLANNED_CURVE_VALUE) AS DECIMAL(38,14)) AS FUTURE_PLANNED_TOTAL
  FROM f_join GROUP BY {_K}),
f_calc AS (
  SELECT j.*, d.FUTURE_PLANNED_TOTAL,
         CAST(SUM(j.PLANNED_CURVE_VALUE) OVER (PARTITION BY j.PROJECT_NUMBER, j.STAGE, j.SUB_STAGE
              ORDER BY j.DATE ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,14))
           AS RUNNING_PLANNED,
         CASE WHEN j.BUDGET_CURRENT_APPROVED IS NULL OR j.TOTAL_ACTUAL_COST IS NULL THEN NULL
              ELSE greatest(CAST(0 AS DECIMAL(38,10)),
                            CAST(j.BUDGET_CURRENT_APPROVED - j.TOTAL_ACTUAL_COST AS DECIMAL(38,10))) END
           AS REMAINING_AMOUNT
  FROM f_join j JOIN f_dist d ON {_on('j', 'd')}),
forecast_v AS (
  SELECT {_K}, DATE AS FORECAST_DATE,
         (CASE WHEN FUTURE_PLANNED_TOTAL = 0 THEN 0.0
               ELSE CAST(PLANNED_CURVE_VALUE AS DOUBLE) / CAST(FUTURE_PLANNED_TOTAL AS DOUBLE) END)
           * CAST(REMAINING_AMOUNT AS DOUBLE) AS FORECAST_VALUE,
         (CASE WHEN FUTURE_PLANNED_TOTAL = 0 THEN 0.0
               ELSE CAST(RUNNING_PLANNED AS DOUBLE) / CAST(FUTURE_PLANNED_TOTAL AS DOUBLE) END)
           * CAST(REMAINING_AMOUNT AS DOUBLE) + CAST(CUMULATIVE_ACTUAL_COST AS DOUBLE)
           AS FORECAST_FINAL_VALUE
  FROM f_calc),
combined_v AS (
  SELECT CAST(PROJECT_NUMBER AS VARCHAR) AS PROJECT_NUMBER, CAST(STAGE AS VARCHAR) AS STAGE,
         CAST(SUB_STAGE AS VARCHAR) AS SUB_STAGE, INVOICE_DATE AS DATE,
         COALESCE(CAST(CUMULATIVE_ACTUAL_COST AS DOUBLE), 0.0) AS VALUE, 'ACTUAL' AS TYPE
  FROM actual_v
  UNION ALL
  SELECT CAST(PROJECT_NUMBER AS VARCHAR), CAST(STAGE AS VARCHAR), CAST(SUB_STAGE AS VARCHAR), DATE,
         COALESCE(CAST(PLANNED_CURVE_VALUE AS DOUBLE), 0.0), 'PLANNED'
  FROM planned_v
  UNION ALL
  SELECT CAST(PROJECT_NUMBER AS VARCHAR), CAST(STAGE AS VARCHAR), CAST(SUB_STAGE AS VARCHAR),
         FORECAST_DATE, COALESCE(CASE WHEN isnan(FORECAST_FINAL_VALUE) THEN NULL
                                      ELSE FORECAST_FINAL_VALUE END, 0.0), 'FORECAST'
  FROM forecast_v),
last_actual AS (
  SELECT {_K}, MAX(INVOICE_DATE) AS LAST_ACTUAL_DATE,
         arg_max(CUMULATIVE_ACTUAL_COST, INVOICE_DATE) AS LAST_ACTUAL,
         CAST(SUM(ACTUALS_COST) AS DECIMAL(38,10)) AS TOTAL_ACTUAL_COST,
         MAX(BUDGET_CURRENT_APPROVED) AS BUDGET_CURRENT_APPROVED
  FROM actual_v GROUP BY {_K}),
pvb AS (
  SELECT p.PROJECT_NUMBER, p.STAGE, p.SUB_STAGE, p.MAX_PLANNED,
         COALESCE(b.BUDGET_CURRENT_APPROVED, 0) AS BUDGET_CURRENT_APPROVED,
         CAST(CAST(COALESCE(b.BUDGET_CURRENT_APPROVED, 0) AS DECIMAL(38,14))
              - CAST(p.MAX_PLANNED AS DECIMAL(38,14)) AS DECIMAL(38,14)) AS GAP,
         CASE WHEN abs(CAST(COALESCE(b.BUDGET_CURRENT_APPROVED, 0) AS DECIMAL(38,14))
                       - CAST(p.MAX_PLANNED AS DECIMAL(38,14))) < 0.01
              THEN 'PASS' ELSE 'FAIL' END AS STATUS
  FROM (SELECT {_K}, MAX(PLANNED_CURVE_VALUE) AS MAX_PLANNED FROM planned_v GROUP BY {_K}) p
  JOIN budget_k b ON {_on('p', 'b')}),
fcont AS (
  SELECT f.PROJECT_NUMBER, f.STAGE, f.SUB_STAGE, a.LAST_ACTUAL_DATE, a.LAST_ACTUAL,
         f.FIRST_FORECAST_DATE, f.FIRST_FORECAST,
         CASE WHEN f.FIRST_FORECAST >= CAST(a.LAST_ACTUAL AS DOUBLE) THEN 'PASS' ELSE 'FAIL' END AS STATUS
  FROM (SELECT {_K}, MIN(FORECAST_DATE) AS FIRST_FORECAST_DATE,
               arg_min(FORECAST_FINAL_VALUE, FORECAST_DATE) AS FIRST_FORECAST
        FROM forecast_v GROUP BY {_K}) f
  JOIN last_actual a ON {_on('f', 'a')}),
cont AS (
  SELECT a.PROJECT_NUMBER, a.max_actual_date, f.min_forecast_date,
         CASE WHEN f.min_forecast_date > a.max_actual_date THEN 'PASS' ELSE 'FAIL' END AS continuity_check
  FROM (SELECT PROJECT_NUMBER, MAX(INVOICE_DATE) AS max_actual_date FROM actual_v GROUP BY PROJECT_NUMBER) a
  JOIN (SELECT PROJECT_NUMBER, MIN(FORECAST_DATE) AS min_forecast_date FROM forecast_v GROUP BY PROJECT_NUMBER) f
    ON a.PROJECT_NUMBER = f.PROJECT_NUMBER),
expected_k AS (
  SELECT {_K} FROM budget_k
  WHERE PROJECT_NUMBER IS NOT NULL AND STAGE IS NOT NULL AND SUB_STAGE IS NOT NULL),
missing AS (
  SELECT e.*, 'ACTUAL' AS MISSING_FROM FROM expected_k e
  WHERE NOT EXISTS (SELECT 1 FROM actual_v x WHERE {_on('x', 'e')})
  UNION ALL
  SELECT e.*, 'PLANNED' FROM expected_k e
  WHERE NOT EXISTS (SELECT 1 FROM planned_v x WHERE {_on('x', 'e')})
  UNION ALL
  SELECT e.*, 'FORECAST' FROM expected_k e
  WHERE NOT EXISTS (SELECT 1 FROM forecast_v x WHERE {_on('x', 'e')})),
expected_p AS (SELECT DISTINCT PROJECT_NUMBER FROM budget_k WHERE PROJECT_NUMBER IS NOT NULL),
missing_p AS (
  SELECT e.PROJECT_NUMBER FROM expected_p e
  WHERE NOT EXISTS (SELECT 1 FROM actual_v x WHERE x.PROJECT_NUMBER = e.PROJECT_NUMBER)
  UNION ALL
  SELECT e.PROJECT_NUMBER FROM expected_p e
  WHERE NOT EXISTS (SELECT 1 FROM planned_v x WHERE x.PROJECT_NUMBER = e.PROJECT_NUMBER)
  UNION ALL
  SELECT e.PROJECT_NUMBER FROM expected_p e
  WHERE NOT EXISTS (SELECT 1 FROM forecast_v x WHERE x.PROJECT_NUMBER = e.PROJECT_NUMBER)),
ctl AS (
  SELECT {_K},
         COALESCE(s.SOURCE_TOTAL, 0) AS SOURCE_TOTAL, COALESCE(c.CURVE_TOTAL, 0) AS CURVE_TOTAL,
         CAST(COALESCE(c.CURVE_TOTAL, 0) - COALESCE(s.SOURCE_TOTAL, 0) AS DECIMAL(38,10)) AS DIFFERENCE,
         CASE WHEN COALESCE(c.CURVE_TOTAL, 0) = COALESCE(s.SOURCE_TOTAL, 0) THEN 'MATCH' ELSE 'MISMATCH' END
           AS STATUS
  FROM (SELECT {_K}, CAST(SUM(COALESCE(ACTUALS_COST, 0)) AS DECIMAL(38,10)) AS SOURCE_TOTAL
        FROM actuals_u
        WHERE PROJECT_NUMBER IS NOT NULL AND STAGE IS NOT NULL AND SUB_STAGE IS NOT NULL
        GROUP BY {_K}) s
  FULL OUTER JOIN (SELECT {_K}, CAST(SUM(ACTUALS_COST) AS DECIMAL(38,10)) AS CURVE_TOTAL
                   FROM actual_v GROUP BY {_K}) c
  USING (PROJECT_NUMBER, STAGE, SUB_STAGE)),
fresh AS (
  SELECT source, latest_date, CAST(date_diff('day', CAST(latest_date AS DATE), {_AS_OF_DATE}) AS BIGINT)
           AS days_since,
         CASE WHEN latest_date IS NOT NULL
                   AND date_diff('day', CAST(latest_date AS DATE), {_AS_OF_DATE}) <= 7
              THEN 'FRESH' ELSE 'STALE' END AS status
  FROM (SELECT 'INVOICE' AS source, MAX(INVOICE_DATE) AS latest_date FROM invoice_t
        UNION ALL SELECT 'PAY_APP', MAX(INVOICE_DATE) FROM pay_app_t
        UNION ALL SELECT 'PAY_REQ', MAX(INVOICE_DATE) FROM pay_req_t
        UNION ALL SELECT 'ACTUALVALUE', MAX(INVOICE_DATE) FROM actual_v)),
align AS (
  SELECT f.PROJECT_NUMBER, f.STAGE, f.SUB_STAGE, f.LAST_FORECAST_DATE, f.LAST_FORECAST,
         CAST(CASE WHEN a.BUDGET_CURRENT_APPROVED IS NOT NULL
                   THEN greatest(CAST(a.BUDGET_CURRENT_APPROVED AS DECIMAL(38,10)),
                                 CAST(a.TOTAL_ACTUAL_COST AS DECIMAL(38,10))) END AS DOUBLE)
           AS EXPECTED_FINAL,
         CASE WHEN abs(f.LAST_FORECAST - CAST(CASE WHEN a.BUDGET_CURRENT_APPROVED IS NOT NULL
                   THEN greatest(CAST(a.BUDGET_CURRENT_APPROVED AS DECIMAL(38,10)),
                                 CAST(a.TOTAL_ACTUAL_COST AS DECIMAL(38,10))) END AS DOUBLE)) < 0.01
              THEN 'PASS' ELSE 'FAIL' END AS STATUS
  FROM (SELECT {_K}, MAX(FORECAST_DATE) AS LAST_FORECAST_DATE,
               arg_max(FORECAST_FINAL_VALUE, FORECAST_DATE) AS LAST_FORECAST
        FROM forecast_v GROUP BY {_K}) f
  JOIN last_actual a ON {_on('f', 'a')}),
timeline AS (
  SELECT {_K}, INVOICE_DATE, CURRENTSTART, CURRENTEND,
         CASE WHEN CURRENTSTART IS NULL OR CURRENTEND IS NULL THEN 'NO_SCHEDULE'
              WHEN INVOICE_DATE < CURRENTSTART THEN 'BEFORE_START'
              WHEN INVOICE_DATE > CURRENTEND THEN 'AFTER_END' END AS ISSUE
  FROM actual_v),
monotone AS (
  SELECT {_K}, INVOICE_DATE, PREVIOUS_CUMULATIVE, CUMULATIVE_ACTUAL_COST FROM (
    SELECT *, lag(CUMULATIVE_ACTUAL_COST) OVER ({_KW} ORDER BY INVOICE_DATE) AS PREVIOUS_CUMULATIVE
    FROM actual_v)
  WHERE CUMULATIVE_ACTUAL_COST < PREVIOUS_CUMULATIVE)
"""

_D = "DOUBLE"

_FINAL = {
    "actuals_union": f"""
SELECT {_K}, INVOICE_DATE, CAST(ACTUALS_COST AS {_D}) AS ACTUALS_COST FROM actuals_u""",
    "budget_rollup": f"""
SELECT {_K}, CAST(BUDGET_CURRENT_APPROVED AS {_D}) AS BUDGET_CURRENT_APPROVED FROM budget_k""",
    "actuals_enriched": f"""
SELECT {_K}, INVOICE_DATE, CAST(ACTUALS_COST AS {_D}) AS ACTUALS_COST,
       CAST(BUDGET_CURRENT_APPROVED AS {_D}) AS BUDGET_CURRENT_APPROVED, CURRENTSTART, CURRENTEND
FROM enriched""",
    "actuals_net": f"""
SELECT {_K}, INVOICE_DATE, CAST(ACTUALS_COST AS {_D}) AS ACTUALS_COST,
       CAST(BUDGET_CURRENT_APPROVED AS {_D}) AS BUDGET_CURRENT_APPROVED, CURRENTSTART, CURRENTEND
FROM net""",
    "actual_value": f"""
SELECT {_K}, INVOICE_DATE, CAST(ACTUALS_COST AS {_D}) AS ACTUALS_COST,
       CAST(BUDGET_CURRENT_APPROVED AS {_D}) AS BUDGET_CURRENT_APPROVED, CURRENTSTART, CURRENTEND,
       CAST(CUMULATIVE_ACTUAL_COST AS {_D}) AS CUMULATIVE_ACTUAL_COST
FROM actual_v""",
    "norm_curve": f"""
SELECT SUB_STAGE, PCT_KEY, CAST(PCT_KEY / 100 AS {_D}) AS PERCENT_COMPLETIONTIME,
       CAST(NORM_PERCENT_CUMSPENT AS {_D}) AS NORM_PERCENT_CUMSPENT
FROM curve_pts""",
    "planned_inputs": f"""
SELECT {_K}, CAST(BUDGET_CURRENT_APPROVED AS {_D}) AS BUDGET_CURRENT_APPROVED, CURRENTSTART, CURRENTEND
FROM p_in WHERE rn = 1""",
    "planned_daily": f"""
SELECT {_K}, DATE, CAST(NORMALIZED_PERCENT AS {_D}) AS NORMALIZED_PERCENT,
       CAST(PLANNED_CURVE_VALUE AS {_D}) AS PLANNED_CURVE_VALUE
FROM p_daily""",
    "planned_value": f"""
SELECT {_K}, CAST(NORMALIZED_PERCENT AS {_D}) AS NORMALIZED_PERCENT, DATE,
       CAST(PLANNED_CURVE_VALUE AS {_D}) AS PLANNED_CURVE_VALUE,
       CAST(CUMULATIVE_PLANNED_CURVE AS {_D}) AS CUMULATIVE_PLANNED_CURVE
FROM planned_v""",
    "actuals_summary": f"""
SELECT {_K}, CAST(TOTAL_ACTUAL_COST AS {_D}) AS TOTAL_ACTUAL_COST,
       CAST(BUDGET_CURRENT_APPROVED AS {_D}) AS BUDGET_CURRENT_APPROVED
FROM a_sum""",
    "last_cumulative": f"""
SELECT {_K}, INVOICE_DATE, CAST(CUMULATIVE_ACTUAL_COST AS {_D}) AS CUMULATIVE_ACTUAL_COST FROM a_last""",
    "future_weights": f"""
SELECT {_K}, DATE, CAST(NORMALIZED_PERCENT AS {_D}) AS NORMALIZED_PERCENT,
       CAST(PLANNED_CURVE_VALUE AS {_D}) AS PLANNED_CURVE_VALUE,
       CAST(CUMULATIVE_PLANNED_CURVE AS {_D}) AS CUMULATIVE_PLANNED_CURVE,
       CAST(TOTAL_ACTUAL_COST AS {_D}) AS TOTAL_ACTUAL_COST,
       CAST(BUDGET_CURRENT_APPROVED AS {_D}) AS BUDGET_CURRENT_APPROVED,
       INVOICE_DATE, CAST(CUMULATIVE_ACTUAL_COST AS {_D}) AS CUMULATIVE_ACTUAL_COST
FROM f_join""",
    "forecast_value": f"""
SELECT {_K}, FORECAST_DATE, FORECAST_VALUE, FORECAST_FINAL_VALUE FROM forecast_v""",
    "combined_curves": f"""
SELECT {_K}, DATE, VALUE, TYPE FROM combined_v""",
    "combined_preview": f"""
SELECT {_K}, DATE, VALUE, TYPE FROM combined_v
ORDER BY TYPE, PROJECT_NUMBER, STAGE, SUB_STAGE, DATE LIMIT 10""",
    "recent_refresh": f"""
SELECT PROJECTID, STAGEPHASE_CODE, SUBSTAGEACTIVITY_CODE, INVOICE_DATE,
       CAST(ACTUALS_COST AS {_D}) AS ACTUALS_COST
FROM invoice_t WHERE INVOICE_DATE >= CAST({_AS_OF_DATE} - INTERVAL 2 YEAR AS TIMESTAMP)""",
    "source_counts": """
SELECT 'INVOICE' AS source, COUNT(*) AS record_count FROM invoice_t
UNION ALL SELECT 'PAY_APP', COUNT(*) FROM pay_app_t
UNION ALL SELECT 'PAY_REQ', COUNT(*) FROM pay_req_t
UNION ALL SELECT 'UNIFIER_COSTSHEET_SUBSTAGE_FUND', COUNT(*) FROM budget_t
UNION ALL SELECT 'P6_SCHEDULE', COUNT(*) FROM schedule_t""",
    "source_profile": """
SELECT source, COUNT(*) AS record_count, MIN(INVOICE_DATE) AS earliest_date,
       MAX(INVOICE_DATE) AS latest_date, COUNT(DISTINCT PROJECTID) AS unique_projects
FROM (SELECT 'INVOICE' AS source, PROJECTID, INVOICE_DATE FROM invoice_t
      UNION ALL SELECT 'PAY_APP', PROJECTID, INVOICE_DATE FROM pay_app_t
      UNION ALL SELECT 'PAY_REQ', PROJECTID, INVOICE_DATE FROM pay_req_t)
GROUP BY source""",
    "completeness_check": """
SELECT 'ACTUAL' AS source, COUNT(DISTINCT PROJECT_NUMBER) AS project_count FROM actual_v
UNION ALL SELECT 'PLANNED', COUNT(DISTINCT PROJECT_NUMBER) FROM planned_v
UNION ALL SELECT 'FORECAST', COUNT(DISTINCT PROJECT_NUMBER) FROM forecast_v""",
    "continuity_check": """
SELECT PROJECT_NUMBER, max_actual_date, min_forecast_date, continuity_check FROM cont""",
    "monotone_violations": f"""
SELECT {_K}, INVOICE_DATE, CAST(PREVIOUS_CUMULATIVE AS {_D}) AS PREVIOUS_CUMULATIVE,
       CAST(CUMULATIVE_ACTUAL_COST AS {_D}) AS CUMULATIVE_ACTUAL_COST
FROM monotone""",
    "planned_vs_budget": f"""
SELECT {_K}, CAST(MAX_PLANNED AS {_D}) AS MAX_PLANNED,
       CAST(BUDGET_CURRENT_APPROVED AS {_D}) AS BUDGET_CURRENT_APPROVED, CAST(GAP AS {_D}) AS GAP, STATUS
FROM pvb""",
    "forecast_continuity": f"""
SELECT {_K}, LAST_ACTUAL_DATE, CAST(LAST_ACTUAL AS {_D}) AS LAST_ACTUAL, FIRST_FORECAST_DATE,
       FIRST_FORECAST, STATUS
FROM fcont""",
    "missing_keys": f"""
SELECT {_K}, MISSING_FROM FROM missing""",
    "control_totals": f"""
SELECT {_K}, CAST(SOURCE_TOTAL AS {_D}) AS SOURCE_TOTAL, CAST(CURVE_TOTAL AS {_D}) AS CURVE_TOTAL,
       CAST(DIFFERENCE AS {_D}) AS DIFFERENCE, STATUS
FROM ctl""",
    "freshness": """
SELECT source, latest_date, days_since, status FROM fresh""",
    "budget_alignment": f"""
SELECT {_K}, LAST_FORECAST_DATE, LAST_FORECAST, EXPECTED_FINAL, STATUS FROM align""",
    "timeline_check": f"""
SELECT {_K}, INVOICE_DATE, CURRENTSTART, CURRENTEND, ISSUE FROM timeline WHERE ISSUE IS NOT NULL""",
    "quality_score": f"""
SELECT "check", checked, failed,
       CASE WHEN checked = 0 THEN 1.0 ELSE 1.0 - CAST(failed AS DOUBLE) / CAST(checked AS DOUBLE) END
         AS pass_rate,
       (CASE WHEN checked = 0 THEN 1.0 ELSE 1.0 - CAST(failed AS DOUBLE) / CAST(checked AS DOUBLE) END)
         >= 0.999 AS meets_target
FROM (
  SELECT "check", CAST(checked AS BIGINT) AS checked, CAST(failed AS BIGINT) AS failed FROM (
    SELECT 'monotone' AS "check", (SELECT COUNT(*) FROM actual_v) AS checked,
           (SELECT COUNT(*) FROM monotone) AS failed
    UNION ALL SELECT 'planned_vs_budget', (SELECT COUNT(*) FROM pvb),
           (SELECT COUNT(*) FROM pvb WHERE STATUS = 'FAIL')
    UNION ALL SELECT 'forecast_continuity', (SELECT COUNT(*) FROM fcont),
           (SELECT COUNT(*) FROM fcont WHERE STATUS = 'FAIL')
    UNION ALL SELECT 'continuity', (SELECT COUNT(*) FROM cont),
           (SELECT COUNT(*) FROM cont WHERE continuity_check = 'FAIL')
    UNION ALL SELECT 'completeness', (SELECT 3 * COUNT(*) FROM expected_p), (SELECT COUNT(*) FROM missing_p)
    UNION ALL SELECT 'missing_keys', (SELECT 3 * COUNT(*) FROM expected_k),
           (SELECT COUNT(*) FROM missing)
    UNION ALL SELECT 'control_totals', (SELECT COUNT(*) FROM ctl),
           (SELECT COUNT(*) FROM ctl WHERE STATUS = 'MISMATCH')
    UNION ALL SELECT 'freshness', (SELECT COUNT(*) FROM fresh),
           (SELECT COUNT(*) FROM fresh WHERE status = 'STALE')
    UNION ALL SELECT 'budget_alignment', (SELECT COUNT(*) FROM align),
           (SELECT COUNT(*) FROM align WHERE STATUS = 'FAIL')
    UNION ALL SELECT 'timeline', (SELECT COUNT(*) FROM actual_v),
           (SELECT COUNT(*) FROM timeline WHERE ISSUE IS NOT NULL))
  UNION ALL
  SELECT 'OVERALL', CAST(SUM(checked) AS BIGINT), CAST(SUM(failed) AS BIGINT) FROM (
    SELECT (SELECT COUNT(*) FROM actual_v) + (SELECT COUNT(*) FROM pvb) + (SELECT COUNT(*) FROM fcont)
           + (SELECT COUNT(*) FROM cont) + (SELECT 3 * COUNT(*) FROM expected_p) + (SELECT 3 * COUNT(*) FROM expected_k)
           + (SELECT COUNT(*) FROM ctl) + (SELECT COUNT(*) FROM fresh) + (SELECT COUNT(*) FROM align)
           + (SELECT COUNT(*) FROM actual_v) AS checked,
           (SELECT COUNT(*) FROM monotone) + (SELECT COUNT(*) FROM pvb WHERE STATUS = 'FAIL')
           + (SELECT COUNT(*) FROM fcont WHERE STATUS = 'FAIL')
           + (SELECT COUNT(*) FROM cont WHERE continuity_check = 'FAIL')
           + (SELECT COUNT(*) FROM missing_p) + (SELECT COUNT(*) FROM missing) + (SELECT COUNT(*) FROM ctl WHERE STATUS = 'MISMATCH')
           + (SELECT COUNT(*) FROM fresh WHERE status = 'STALE')
           + (SELECT COUNT(*) FROM align WHERE STATUS = 'FAIL')
           + (SELECT COUNT(*) FROM timeline WHERE ISSUE IS NOT NULL) AS failed))""",
}

_FINAL["costs_by_schedule"] = f"""
SELECT d.PROJECT_NUMBER, d.STAGE, d.SUB_STAGE, d.INVOICE_DATE, CAST(d.ACTUALS_COST AS {_D}) AS ACTUALS_COST,
       first(s.CURRENTSTART ORDER BY s.CURRENTSTART, s.CURRENTEND) AS CURRENTSTART,
       first(s.CURRENTEND ORDER BY s.CURRENTSTART, s.CURRENTEND) AS CURRENTEND, COUNT(s.CURRENTSTART) AS COVERING_ROWS
FROM daily d LEFT JOIN (SELECT DISTINCT * FROM schedule_c) s
  ON {_on('d', 's')} AND d.INVOICE_DATE BETWEEN s.CURRENTSTART AND s.CURRENTEND
GROUP BY d.PROJECT_NUMBER, d.STAGE, d.SUB_STAGE, d.INVOICE_DATE, d.ACTUALS_COST"""
_FINAL["schedule_row_totals"] = f"""
SELECT {_K}, CURRENTSTART, CURRENTEND, COUNT(*) AS COST_DAYS, CAST(SUM(COST) AS {_D}) AS ACTUALS_COST
FROM (SELECT d.PROJECT_NUMBER, d.STAGE, d.SUB_STAGE, d.INVOICE_DATE, d.ACTUALS_COST AS COST,
             first(s.CURRENTSTART ORDER BY s.CURRENTSTART, s.CURRENTEND) AS CURRENTSTART,
             first(s.CURRENTEND ORDER BY s.CURRENTSTART, s.CURRENTEND) AS CURRENTEND
      FROM daily d LEFT JOIN schedule_c s ON {_on('d', 's')} AND d.INVOICE_DATE BETWEEN s.CURRENTSTART AND s.CURRENTEND
      GROUP BY ALL)
GROUP BY {_K}, CURRENTSTART, CURRENTEND"""
_FINAL["curve_as_of"] = f"""
SELECT c.TYPE, c.PROJECT_NUMBER, c.STAGE, c.SUB_STAGE, c.DATE,
       (SELECT MAX(a.INVOICE_DATE) FROM actual_v a WHERE {_on('a', 'c')} AND a.INVOICE_DATE <= c.DATE) AS ACTUAL_DATE,
       CAST((SELECT arg_max(a.CUMULATIVE_ACTUAL_COST, a.INVOICE_DATE) FROM actual_v a
             WHERE {_on('a', 'c')} AND a.INVOICE_DATE <= c.DATE) AS {_D}) AS ACTUAL_TO_DATE
FROM (SELECT 'PLANNED' AS TYPE, {_K}, DATE FROM planned_v
      UNION ALL SELECT 'FORECAST', {_K}, FORECAST_DATE FROM forecast_v) c"""
_FINAL["sketched_profile"] = """
WITH s AS (SELECT 'INVOICE' AS source, * FROM invoice_t UNION ALL BY NAME SELECT 'PAY_REQ' AS source, * FROM pay_req_t
           UNION ALL BY NAME SELECT 'PAY_APP' AS source, * EXCLUDE (ACTUALS_COST) FROM pay_app_t)
SELECT source, COUNT(*) AS row_count, MIN(INVOICE_DATE) AS min_date, MAX(INVOICE_DATE) AS max_date,
       COUNT(DISTINCT PROJECTID) AS distinct_projects, (SELECT COUNT(DISTINCT PROJECTID) FROM s) < 4096 AS exact,
       (SELECT COUNT(DISTINCT PROJECTID) FROM s) - COUNT(DISTINCT PROJECTID) AS missing_projects
FROM s GROUP BY source"""
_FINAL["sketched_quantiles"] = """
SELECT source, STAGE, quantile, items, TRUE AS within_bound
FROM (SELECT source, STAGEPHASE_CODE AS STAGE, COUNT(*) AS items
      FROM (SELECT 'INVOICE' AS source, STAGEPHASE_CODE FROM invoice_t UNION ALL SELECT 'PAY_APP', STAGEPHASE_CODE FROM pay_app_t
            UNION ALL SELECT 'PAY_REQ', STAGEPHASE_CODE FROM pay_req_t) GROUP BY ALL),
     (SELECT CAST(unnest([0.05, 0.25, 0.5, 0.75, 0.95]) AS DOUBLE) AS quantile)"""
_FINAL["control_cube"] = f"""
SELECT {_K}, GROUPING_ID({_K}) AS LEVEL, CAST(SUM(SOURCE_TOTAL) AS {_D}) AS SOURCE_TOTAL,
       CAST(SUM(CURVE_TOTAL) AS {_D}) AS CURVE_TOTAL, CAST(SUM(CURVE_TOTAL) - SUM(SOURCE_TOTAL) AS {_D}) AS DIFFERENCE,
       CASE WHEN SUM(CURVE_TOTAL) = SUM(SOURCE_TOTAL) THEN 'MATCH' ELSE 'MISMATCH' END AS STATUS
FROM ctl GROUP BY CUBE ({_K})"""
_FINAL["shortfall_episodes"] = f"""
WITH peaks AS (SELECT *, MAX(CUMULATIVE_ACTUAL_COST) OVER (PARTITION BY {_K} ORDER BY INVOICE_DATE) AS PEAK,
                      MAX(INVOICE_DATE) OVER (PARTITION BY {_K}) AS LAST FROM actual_v),
marked AS (SELECT *, COUNT(*) FILTER (CUMULATIVE_ACTUAL_COST = PEAK) OVER (PARTITION BY {_K} ORDER BY INVOICE_DATE) AS EPISODE FROM peaks)
SELECT {_K}, MIN(INVOICE_DATE) AS FIRST_DATE, MAX(INVOICE_DATE) AS LAST_DATE, COUNT(*) AS DATES,
       date_diff('day', MIN(INVOICE_DATE), MAX(INVOICE_DATE)) + 1 AS DAYS,
       CAST(MAX(PEAK - CUMULATIVE_ACTUAL_COST) AS {_D}) AS DEPTH, MAX(INVOICE_DATE) < MAX(LAST) AS RECOVERED
FROM marked WHERE CUMULATIVE_ACTUAL_COST < PEAK GROUP BY {_K}, EPISODE"""
_FINAL["timeline_episodes"] = f"""
WITH marked AS (SELECT *, COUNT(*) FILTER (ISSUE IS NULL) OVER (PARTITION BY {_K} ORDER BY INVOICE_DATE) AS EPISODE FROM timeline)
SELECT {_K}, MIN(INVOICE_DATE) AS FIRST_DATE, MAX(INVOICE_DATE) AS LAST_DATE, COUNT(*) AS DATES,
       string_agg(DISTINCT ISSUE, ',' ORDER BY ISSUE) AS ISSUES
FROM marked WHERE ISSUE IS NOT NULL GROUP BY {_K}, EPISODE"""
_FINAL["backed_up_sources"] = f"""
SELECT source, COUNT(*) AS row_count, CAST(SUM(c) AS {_D}) AS total FROM (
  SELECT 'INVOICE' AS source, CAST(ACTUALS_COST AS DECIMAL(38,10)) AS c FROM invoice_t
  UNION ALL SELECT 'PAY_APP', COALESCE(TRY_CAST(ACTUALS_COST AS DECIMAL(38,10)), 0) FROM pay_app_t
  UNION ALL SELECT 'PAY_REQ', CAST(ACTUALS_COST AS DECIMAL(38,10)) FROM pay_req_t)
GROUP BY source"""
_FINAL["refreshed_months"] = f"""
SELECT PROJECTID, STAGEPHASE_CODE, SUBSTAGEACTIVITY_CODE, INVOICE_DATE,
       CAST(ACTUALS_COST + CASE WHEN strftime(INVOICE_DATE, '%Y-%m') = '2000-05' THEN 1 ELSE 0 END AS {_D}) AS ACTUALS_COST,
       strftime(INVOICE_DATE, '%Y-%m') AS MONTH
FROM invoice_t WHERE INVOICE_DATE >= {_AS_OF_TS} - INTERVAL 2 YEAR"""
for _name, _same in (("late_invoices", "actual_value"), ("streamed_actual_value", "actual_value"),
                     ("staged_curves", "combined_curves"), ("combined_from_numeric_keys", "combined_curves"),
                     ("planned_without_null_projects", "planned_value")):
    _FINAL[_name] = _FINAL[_same]

# The same query, reached on the Spark side by the day explosion.
_FINAL["planned_value_by_day"] = _FINAL["planned_value"]


def oracle_sql() -> dict[str, str]:
    def whole(body: str) -> str:
        body = body.strip()
        return f"WITH {_CTES.strip()},\n{body[5:]}" if body.startswith("WITH ") else f"WITH {_CTES.strip()}\n{body}"

    return {name: whole(body) for name, body in _FINAL.items()}
