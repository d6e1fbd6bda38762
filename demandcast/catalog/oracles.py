"""DuckDB SQL for the registered queries, written on the dense grid and with plain joins.

Named subqueries are shared; ``_sql`` puts the ones a statement needs in front of it.
"""

from __future__ import annotations

import re
from datetime import timedelta

from demandcast.catalog.inputs import AS_OF, END, LAST_ACTUAL, WINDOW_START
from demandcast.catalog.queries import BACKTEST_LAUNCH, BACKTEST_ORIGINS, RUN_DATE, RUN_LAUNCH, RUN_START, UPSERT_FROM
from demandcast.config import ForecastConfig

CFG = ForecastConfig()
K = "chain_id, store_id, product_id"


def d(day) -> str:
    return f"DATE '{day.isoformat()}'"


def r(expression: str, digits: int = 6) -> str:
    return f"round({expression}, {digits}) + 0.0"


def shrink(value: str, bounds: tuple[float, float, float]) -> str:
    s, lo, hi = bounds
    return f"CASE WHEN {value} > 0 THEN least(greatest(1 + {s} * ({value} - 1), {lo}), {hi}) ELSE 1.0 END"


def season(month: str) -> str:
    return f"CAST(floor(({month} % 12) / 3) + 1 AS INTEGER)"


def grid_of(facts: str, last: str) -> str:
    return f"""
        SELECT chain_id, store_id, product_id, week_start, w.weekly_total, w.weekly_total IS NOT NULL AS has_actual
        FROM (SELECT DISTINCT {K} FROM {facts} WHERE week_start <= {last})
        CROSS JOIN (
            SELECT CAST(unnest(generate_series(CAST(min(week_start) AS TIMESTAMP), CAST({last} AS TIMESTAMP),
                                               INTERVAL 7 DAY)) AS DATE) AS week_start
            FROM {facts})
        LEFT JOIN {facts} w USING (chain_id, store_id, product_id, week_start)"""


def history_of(grid: str) -> str:
    return f"""
        SELECT *,
            lag(x, 1) OVER w AS lag_1w, lag(x, 2) OVER w AS lag_2w, lag(x, 3) OVER w AS lag_3w,
            lag(x, 52) OVER w AS lag_52w,
            avg(x) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS roll3w,
            avg(x) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS roll12w,
            sum(CASE WHEN x > 0 THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS nz12,
            sum(x) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS sum12,
            stddev_samp(x) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS std3,
            sum(CASE WHEN x = 0 THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS zeros6,
            no - max(CASE WHEN x > 0 THEN no END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS since
        FROM (SELECT *, coalesce(weekly_total, 0) AS x, date_diff('day', DATE '1970-01-05', week_start) // 7 AS no
              FROM {grid})
        WINDOW w AS (PARTITION BY {K} ORDER BY week_start)"""


BASELINE = "coalesce(nullif(lag_52w, 0), nullif(lag_3w, 0), nullif(lag_2w, 0), nullif(lag_1w, 0), nullif(roll12w, 0), 0)"

HISTORY_COLUMNS = {
    "lag_1w": "lag_1w",
    "lag_2w": "lag_2w",
    "lag_3w": "lag_3w",
    "lag_52w": "lag_52w",
    "diff_1w": "lag_1w - lag_2w",
    "diff_2w": "lag_2w - lag_3w",
    "roll3w": "roll3w",
    "roll12w": "roll12w",
    "nonzero_12w": "CAST(coalesce(nz12, 0) AS BIGINT)",
    "avg_nonzero_12w": "CASE WHEN nz12 > 0 THEN sum12 / nz12 ELSE 0.0 END",
    "weeks_since_last_sale": "CAST(coalesce(since, 0) AS INTEGER)",
    "volatility_3w": "coalesce(std3, 0.0)",
    "zero_run_length_6w": "CAST(coalesce(zeros6, 0) AS BIGINT)",
}
WHOLE = ("nonzero_12w", "weeks_since_last_sale", "zero_run_length_6w")


def history_select(*names: str) -> str:
    return ", ".join(
        f"{HISTORY_COLUMNS[n]} AS {n}" if n in WHOLE else f"{r(HISTORY_COLUMNS[n])} AS {n}" for n in names
    )


CALENDAR = f"""
    CAST(year(week_start) AS INTEGER) AS year, CAST(month(week_start) AS INTEGER) AS month,
    CAST(week(week_start) AS INTEGER) AS week_of_year,
    CAST(year(week_start) * 53 + week(week_start) AS INTEGER) AS week_index,
    {r("sin(2 * pi() * week(week_start) / 52.0)")} AS sin_woy, {r("cos(2 * pi() * week(week_start) / 52.0)")} AS cos_woy,
    CASE WHEN month(week_start) IN (2, 3, 5, 6, 8, 9, 11, 12) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS transition_flag,
    CASE WHEN month(week_start) IN (3, 6, 9, 12) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS transition_pos"""


def index_of(keys: list[str], bucket: str, name: str, months: int, bounds: tuple[float, float, float]) -> str:
    """Share of the parent's total over the mean share, on the grid; buckets without facts flagged."""
    by = "".join(f"{k}, " for k in keys)
    parent = f"PARTITION BY {', '.join(keys)}" if keys else ""
    return f"""
        SELECT {by}{name}, facts > 0 AS sold, {shrink("share / mean_share", bounds)} AS szn_index
        FROM (SELECT *, avg(share) OVER ({parent}) AS mean_share
              FROM (SELECT *, total / nullif(sum(total) OVER ({parent}), 0) AS share
                    FROM (SELECT {by}{bucket} AS {name}, coalesce(sum(weekly_total), 0) AS total,
                                 count(weekly_total) AS facts
                          FROM dense
                          WHERE week_start < {d(AS_OF)} AND week_start >= {d(AS_OF)} - INTERVAL {months} MONTH
                          GROUP BY ALL)))"""


def recursion(facts: str, origin: str, steps: int) -> str:
    """One row per SKU and step; the state is a list of the last 52 weeks."""
    model = "coalesce(list_avg(hist[41:52]), 0)"
    base = (
        "coalesce(nullif(hist[1], 0), nullif(hist[50], 0), nullif(hist[51], 0), nullif(hist[52], 0), "
        "nullif(list_avg(hist[41:52]), 0), 0)"
    )
    return f"""
        SELECT {K}, -1 AS step, list(x ORDER BY week_start) AS hist, any_value(is_dense) AS is_dense,
               NULL::DOUBLE AS pred_model, NULL::DOUBLE AS pred_base, NULL::DOUBLE AS pred_final
        FROM (SELECT k.*, c.week_start,
                     CASE WHEN c.week_start >= (SELECT min(week_start) FROM {facts}) THEN coalesce(weekly_total, 0) END AS x
              FROM ({launched_density_of(facts, origin, steps)}) k
              CROSS JOIN (SELECT CAST({origin} - INTERVAL (7 * unnest(range(1, 53))) DAY AS DATE) AS week_start) c
              LEFT JOIN {facts} USING (chain_id, store_id, product_id, week_start))
        GROUP BY {K}
        UNION ALL
        SELECT {K}, step + 1, list_append(hist[2:52], pf), is_dense, pm, pb, pf
        FROM (SELECT *, CASE WHEN is_dense THEN pm ELSE pb END AS pf
              FROM (SELECT {K}, step, hist, is_dense, {model} AS pm, {base} AS pb FROM recursion))
        WHERE step + 1 < {steps}"""


def launched_density_of(facts: str, origin: str, steps: int) -> str:
    """Dense flag at the origin of every SKU that has sold by the end of the window."""
    weeks = f"ceil(date_diff('day', (SELECT min(week_start) FROM {facts}), {origin}) / 7.0)"
    before = f"FILTER (WHERE week_start < {origin})"
    return f"""
        SELECT {K}, coalesce(sum(weekly_total) {before}, 0) / {weeks} >= 3.0
                    AND 1.0 - count(*) FILTER (WHERE weekly_total > 0 AND week_start < {origin}) / {weeks} <= 0.70 AS is_dense
        FROM {facts} WHERE week_start < {origin} + {7 * steps} GROUP BY {K}"""


def density_of(facts: str, origin: str) -> str:
    weeks = f"ceil(date_diff('day', (SELECT min(week_start) FROM {facts}), {origin}) / 7.0)"
    return f"""
        SELECT {K}, avg_weekly, zero_rate, avg_weekly >= 3.0 AND zero_rate <= 0.70 AS is_dense
        FROM (SELECT {K}, sum(weekly_total) / {weeks} AS avg_weekly,
                     1.0 - count(*) FILTER (WHERE weekly_total > 0) / {weeks} AS zero_rate
              FROM {facts} WHERE week_start < {origin} GROUP BY {K})"""


def ewma_of(rows: str) -> str:
    """State of each SKU's residuals: smoothed value and confidence of the last week."""
    return f"""
        SELECT {K}, count(*) AS points,
            CASE WHEN count(*) >= 3 THEN sum((actual - forecast) * pow(7 / 9.0, rn - 1)) / sum(pow(7 / 9.0, rn - 1)) END
                AS resid_ewma,
            CASE WHEN count(*) >= 3 THEN least(greatest(
                0.6 * avg(CASE WHEN actual > 0 THEN 1.0 ELSE 0.0 END) FILTER (WHERE rn <= 12)
                + 0.4 * least(count(*) / 52.0, 1.0), 0.0), 1.0) END AS confidence
        FROM (SELECT *, row_number() OVER (PARTITION BY {K} ORDER BY week_start DESC) AS rn
              FROM {rows} WHERE week_start <= {d(LAST_ACTUAL)})
        GROUP BY {K}"""


def weights_of(rows: str) -> str:
    return f"""
        SELECT {K}, mae_model, mae_base,
               least(greatest(mae_base / (mae_model + mae_base + 1e-9), 0.10), 0.90) AS w_model
        FROM (SELECT {K}, avg(abs(pred_model - actual)) AS mae_model, avg(abs(pred_base - actual)) AS mae_base
              FROM (SELECT *, row_number() OVER (PARTITION BY {K} ORDER BY week_start DESC) AS rn
                    FROM {rows} WHERE week_start <= {d(LAST_ACTUAL)} AND actual > 0)
              WHERE rn <= 8 GROUP BY {K})"""


def blended_of(rows: str) -> str:
    return f"""
        SELECT s.* EXCLUDE (forecast),
            CASE WHEN week_start > {d(LAST_ACTUAL)}
                 THEN greatest(coalesce(w_model, 0.7) * pred_model + (1 - coalesce(w_model, 0.7)) * pred_base, 0)
                 ELSE forecast END AS forecast
        FROM {rows} s LEFT JOIN ({weights_of(rows)}) USING ({K})"""


def anchored_of(rows: str) -> str:
    return f"""
        SELECT * EXCLUDE (forecast, actual_last, pos),
            CASE WHEN week_start > {d(LAST_ACTUAL)} AND actual_last > 0
                 THEN greatest(1 - pos / 2.0, 0) * actual_last + (1 - greatest(1 - pos / 2.0, 0)) * forecast
                 ELSE forecast END AS forecast
        FROM (SELECT s.*, a.actual_last, row_number() OVER (
                  PARTITION BY {K}, week_start > {d(LAST_ACTUAL)} ORDER BY week_start) - 1 AS pos
              FROM {rows} s
              LEFT JOIN (SELECT {K}, arg_max(actual, week_start) AS actual_last FROM {rows}
                         WHERE week_start <= {d(LAST_ACTUAL)} AND actual > 0 GROUP BY {K}) a USING ({K}))"""


def nudged_of(rows: str) -> str:
    return f"""
        SELECT s.* EXCLUDE (forecast),
            CASE WHEN week_start > {d(LAST_ACTUAL)}
                      AND (SELECT count(*) FROM {rows} WHERE week_start <= {d(LAST_ACTUAL)}) >= 100
                 THEN greatest(forecast - CASE WHEN coalesce(confidence, 0) < 0.2 THEN 0
                                               ELSE 0.35 * confidence * coalesce(resid_ewma, 0) END, 0)
                 ELSE forecast END AS forecast
        FROM {rows} s LEFT JOIN ({ewma_of(rows)}) USING ({K})"""


def week_capped_of(rows: str, yoy: str) -> str:
    return f"""
        SELECT s.* EXCLUDE (forecast), forecast * coalesce(scale, 1.0) AS forecast
        FROM {rows} s
        LEFT JOIN (
            SELECT f.chain_id, f.week_start, least(f.total, 2.0 * l.total) / f.total AS scale
            FROM (SELECT chain_id, week_start, sum(forecast) AS total FROM {rows} GROUP BY ALL) f
            JOIN (SELECT chain_id, week_start, sum(weekly_total) AS total FROM known GROUP BY ALL) l
                ON f.chain_id = l.chain_id AND l.week_start = f.week_start - 364
            JOIN {yoy} y ON f.chain_id = y.chain_id AND y.use_yoy
            WHERE l.total > 0 AND f.total > 0) USING (chain_id, week_start)"""


def sku_capped_of(rows: str, yoy: str) -> str:
    ratio = "CASE WHEN l.weekly_total < 20 THEN 2.5 WHEN l.weekly_total < 100 THEN 2.0 WHEN l.weekly_total < 1000 THEN 1.5 ELSE 1.2 END"
    return f"""
        SELECT s.* EXCLUDE (forecast),
            CASE WHEN y.use_yoy AND l.weekly_total > 0 THEN least(s.forecast, {ratio} * l.weekly_total)
                 ELSE s.forecast END AS forecast
        FROM {rows} s
        LEFT JOIN known l ON s.chain_id = l.chain_id AND s.store_id = l.store_id AND s.product_id = l.product_id
            AND l.week_start = s.week_start - 364
        LEFT JOIN {yoy} y ON s.chain_id = y.chain_id"""


def trend_of(months: str) -> str:
    """Last four chain weeks before each month against the first four of the last eight."""
    return f"""
        SELECT chain_id, month_start,
            CASE WHEN n >= 4 THEN least(greatest((last4 + 1e-6) / (head4 + 1e-6), 0.7), 1.3) ELSE 1.0 END AS trend
        FROM (SELECT chain_id, month_start, count(total) AS n,
                     sum(total) FILTER (WHERE back <= 4) AS last4, sum(total) FILTER (WHERE ahead <= 4) AS head4
              FROM (SELECT *, row_number() OVER (PARTITION BY chain_id, month_start ORDER BY week_start) AS ahead
                    FROM (SELECT m.chain_id, m.month_start, w.week_start, w.total,
                                 row_number() OVER (PARTITION BY m.chain_id, m.month_start ORDER BY w.week_start DESC) AS back
                          FROM {months} m
                          LEFT JOIN (SELECT chain_id, week_start, sum(weekly_total) AS total FROM known GROUP BY ALL) w
                              ON m.chain_id = w.chain_id AND w.week_start < m.month_start)
                    WHERE back <= 8)
              GROUP BY ALL)"""


def recent_of(months: str) -> str:
    return f"""
        SELECT chain_id, month_start, avg(total) AS recent_base
        FROM (SELECT m.chain_id, m.month_start, a.total,
                     row_number() OVER (PARTITION BY m.chain_id, m.month_start ORDER BY a.month_start DESC) AS back
              FROM {months} m
              LEFT JOIN chain_months a ON m.chain_id = a.chain_id AND a.month_start < m.month_start)
        WHERE back <= 6 GROUP BY ALL"""


def month_capped_of(rows: str, yoy: str) -> str:
    return f"""
        SELECT s.* EXCLUDE (forecast, month_start), forecast * coalesce(scale, 1.0) AS forecast
        FROM (SELECT *, CAST(date_trunc('month', week_start) AS DATE) AS month_start FROM {rows}) s
        LEFT JOIN (
            SELECT chain_id, month_start,
                CASE WHEN use_yoy AND last_year > 0 THEN least(total, 1.6 * last_year) / total
                     ELSE least(greatest(total, lo), greatest(hi, lo + 1e-6)) / total END AS scale
            FROM (
                SELECT *, greatest(base * bias *
                        CASE WHEN recent_base IS NULL THEN 0.65 WHEN recent_base < 20 THEN 0.6
                             WHEN recent_base < 100 THEN 0.7 WHEN recent_base < 500 THEN 0.8 ELSE 0.9 END, 0) AS lo,
                    base * bias *
                        CASE WHEN recent_base IS NULL THEN 1.35 WHEN recent_base < 20 THEN 1.5
                             WHEN recent_base < 100 THEN 1.35 WHEN recent_base < 500 THEN 1.25 ELSE 1.15 END AS hi
                FROM (
                    SELECT f.*, y.use_yoy, l.total AS last_year, b.recent_base,
                        CASE WHEN b.recent_base > 0 THEN b.recent_base ELSE f.total END AS base,
                        least(greatest(1 + 0.3 * coalesce(direction, 0) * (trend - 1), 0.85), 1.15) AS bias
                    FROM (SELECT chain_id, CAST(date_trunc('month', week_start) AS DATE) AS month_start,
                                 sum(forecast) AS total
                          FROM {rows} GROUP BY ALL) f
                    LEFT JOIN {yoy} y USING (chain_id)
                    LEFT JOIN chain_months l ON f.chain_id = l.chain_id
                        AND l.month_start = CAST(f.month_start - INTERVAL 12 MONTH AS DATE)
                    LEFT JOIN ({recent_of("fm")}) b ON f.chain_id = b.chain_id AND f.month_start = b.month_start
                    LEFT JOIN ({trend_of("fm")}) t ON f.chain_id = t.chain_id AND f.month_start = t.month_start
                    LEFT JOIN directions g ON f.chain_id = g.chain_id AND g.season = {season("month(f.month_start)")}
                    WHERE f.total > 0))) USING (chain_id, month_start)"""


def smoothed_of(rows: str) -> str:
    return f"""
        SELECT * EXCLUDE (forecast, month_start, n_free, mean_free, budget),
            CASE WHEN NOT actual > 0 AND n_free > 1 AND budget > 0 THEN 0.85 * forecast + 0.15 * mean_free
                 ELSE forecast END AS forecast
        FROM (SELECT *, CAST(date_trunc('month', week_start) AS DATE) AS month_start,
                  count(*) FILTER (WHERE NOT actual > 0) OVER m AS n_free,
                  avg(forecast) FILTER (WHERE NOT actual > 0) OVER m AS mean_free,
                  sum(forecast) FILTER (WHERE NOT actual > 0) OVER m AS budget
              FROM {rows} WINDOW m AS (PARTITION BY chain_id, date_trunc('month', week_start)))"""


NAMED = {
    "sales": """
        SELECT CAST(n_regionkey AS BIGINT) AS chain_id, CAST(s_nationkey AS BIGINT) AS store_id,
               CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) AS product_id,
               CAST(l_shipdate AS DATE) AS sale_date, l_quantity AS qty, l_orderkey, l_linenumber
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        JOIN part ON l_partkey = p_partkey""",
    "weekly": f"""
        SELECT {K}, CAST(date_trunc('week', sale_date) AS DATE) AS week_start,
               sum(greatest(coalesce(qty, 0), 0)) AS weekly_total
        FROM sales GROUP BY ALL""",
    "known": f"SELECT * FROM weekly WHERE week_start < {d(AS_OF)}",
    "dense": grid_of("weekly", d(END)),
    "dense_all": grid_of("weekly", "(SELECT max(week_start) FROM weekly)"),
    "dense_known": grid_of("known", d(END)),
    "history": history_of("dense_all"),
    "level": f"""
        SELECT {K}, month_start, m0 + m1 + m2 AS curr_sum, p1 + p2 + p3 AS prev_sum,
               (m0 + m1 + m2) / least(rn, 3) AS curr_mean,
               coalesce((p1 + p2 + p3) / nullif(least(rn - 1, 3), 0), 0.0) AS prev_mean
        FROM (SELECT *, t AS m0, lag(t, 1, 0) OVER w AS m1, lag(t, 2, 0) OVER w AS m2, lag(t, 1, 0) OVER w AS p1,
                     lag(t, 2, 0) OVER w AS p2, lag(t, 3, 0) OVER w AS p3, row_number() OVER w AS rn
              FROM (SELECT {K}, CAST(date_trunc('month', week_start) AS DATE) AS month_start,
                           coalesce(sum(weekly_total), 0) AS t
                    FROM dense_all GROUP BY ALL)
              WINDOW w AS (PARTITION BY {K} ORDER BY month_start))""",
    "codes": f"""
        SELECT {K}, CAST(dense_rank() OVER (ORDER BY chain_id) - 1 AS INTEGER) AS chain_code,
               CAST(dense_rank() OVER (ORDER BY store_id) - 1 AS INTEGER) AS store_code,
               CAST(dense_rank() OVER (ORDER BY product_id) - 1 AS INTEGER) AS product_code
        FROM (SELECT DISTINCT {K} FROM weekly)""",
    "idx_global": index_of([], "month(week_start)", "month", 24, CFG.global_shrink),
    "idx_chain": index_of(["chain_id"], "month(week_start)", "month", 18, CFG.chain_shrink),
    "idx_sku": index_of(["chain_id", "product_id"], "month(week_start)", "month", 18, CFG.sku_shrink),
    "idx_product": index_of(["product_id"], season("month(week_start)"), "season", 24, CFG.product_shrink),
    "chain_weeks": f"""
        SELECT chain_id, count(DISTINCT week_start) AS weeks FROM known GROUP BY chain_id""",
    "seasonal": f"""
        SELECT {K}, week_start, ci AS chain_szn_index, si AS sku_szn_index, pi_ AS prod_season_index,
               m * ci AS month_chain_szn, m * si AS month_sku_szn, m * pi_ AS month_prod_season
        FROM (SELECT w.chain_id, w.store_id, w.product_id, w.week_start, CAST(w.month AS DOUBLE) AS m,
                     CASE WHEN cw.weeks >= 26 AND c.szn_index IS NOT NULL THEN c.szn_index
                          ELSE coalesce(g.szn_index, 1.0) END AS ci,
                     coalesce(s.szn_index, c.szn_index, g.szn_index, 1.0) AS si, coalesce(p.szn_index, 1.0) AS pi_
              FROM (SELECT *, month(week_start) AS month FROM weekly) w
              LEFT JOIN chain_weeks cw ON w.chain_id = cw.chain_id
              LEFT JOIN idx_chain c ON w.chain_id = c.chain_id AND w.month = c.month
              LEFT JOIN idx_global g ON w.month = g.month
              LEFT JOIN idx_sku s ON w.chain_id = s.chain_id AND w.product_id = s.product_id AND w.month = s.month
              LEFT JOIN idx_product p ON w.product_id = p.product_id AND {season("w.month")} = p.season)""",
    "directions": f"""
        SELECT chain_id, season,
               CASE WHEN bool_or(prev = 0) THEN 1 WHEN avg(t / nullif(prev, 0) - 1) > 0.05 THEN 1
                    WHEN avg(t / nullif(prev, 0) - 1) < -0.05 THEN -1 ELSE 0 END AS direction
        FROM (SELECT *, lag(t) OVER (PARTITION BY chain_id, season ORDER BY year) AS prev
              FROM (SELECT chain_id, {season("month(week_start)")} AS season, year(week_start) AS year,
                           coalesce(sum(weekly_total), 0) AS t
                    FROM dense_all WHERE week_start < {d(AS_OF)} GROUP BY ALL))
        WHERE prev > 0 OR (prev = 0 AND t > 0)
        GROUP BY ALL""",
    "scored_features": history_of("dense_known"),
    "scored": f"""
        SELECT {K}, week_start, x AS actual, roll12w AS pred_model, {BASELINE} AS pred_base, roll12w AS forecast
        FROM scored_features WHERE week_start >= {d(WINDOW_START)}""",
    "inflated": f"SELECT * REPLACE (2.5 * pred_model AS forecast) FROM scored WHERE week_start >= {d(AS_OF)}",
    "one_step": f"""
        SELECT {K}, week_start, weekly_total AS actual, {BASELINE} AS forecast FROM history WHERE has_actual""",
    "chain_months": """
        SELECT chain_id, CAST(date_trunc('month', week_start) AS DATE) AS month_start, sum(weekly_total) AS total
        FROM known GROUP BY ALL""",
    "all_yoy": f"""
        SELECT chain_id, min(week_start) AS first_week, min(week_start) <= {d(AS_OF - timedelta(days=365))} AS use_yoy
        FROM known GROUP BY chain_id""",
    "some_yoy": "SELECT chain_id, first_week, use_yoy AND chain_id % 2 = 0 AS use_yoy FROM all_yoy",
    "fm": """
        SELECT DISTINCT chain_id, CAST(date_trunc('month', week_start) AS DATE) AS month_start FROM scored""",
    "bias_weeks": """
        SELECT a.chain_id, a.week_start, a.actual, f.forecast
        FROM (SELECT chain_id, week_start, sum(weekly_total) AS actual FROM weekly GROUP BY ALL) a
        JOIN (SELECT chain_id, week_start, sum(forecast) AS forecast FROM one_step GROUP BY ALL) f
            USING (chain_id, week_start)""",
    "bias_groups": """
        SELECT chain_id, CAST(month(week_start) AS INTEGER) AS month_num, sum(actual) AS a, sum(forecast) AS f
        FROM bias_weeks
        WHERE chain_id NOT IN (1, 2, 3)
          AND chain_id IN (SELECT chain_id FROM bias_weeks GROUP BY chain_id HAVING count(DISTINCT week_start) >= 104)
        GROUP BY ALL HAVING sum(actual) >= 500 AND sum(forecast) > 0""",
    "alpha_errors": """
        SELECT alpha, sum(abs(a - f * (1 + alpha * (a / f - 1)))) / sum(a) AS wmape
        FROM bias_groups CROSS JOIN (SELECT unnest([0.0, 0.05, 0.10, 0.15, 0.20, 0.25])::DOUBLE AS alpha)
        WHERE a > 0 GROUP BY alpha""",
    "history_rows": f"""
        SELECT week_start, {K}, weekly_total AS actual, weekly_total * 1.25 AS forecast,
               week_start - 7 AS forecast_run_date
        FROM weekly""",
    # the whole forecast, from the last actual on
    "run_scored": f"""
        SELECT {K}, CAST({d(RUN_START + timedelta(days=1))} + INTERVAL (7 * step) DAY AS DATE) AS week_start,
               coalesce(w.weekly_total, 0) AS actual, pred_model, pred_base, pred_model AS forecast
        FROM (SELECT *, CAST({d(RUN_START + timedelta(days=1))} + INTERVAL (7 * step) DAY AS DATE) AS week_start
              FROM recursion WHERE step >= 0)
        LEFT JOIN known w USING ({K}, week_start)""",
    "run_blended": blended_of("run_scored"),
    "run_anchored": anchored_of("run_blended"),
    "run_nudged": nudged_of("run_anchored"),
    "run_future": f"SELECT * FROM run_nudged WHERE week_start > {d(LAST_ACTUAL)}",
    "run_yoy": f"""
        SELECT chain_id, min(week_start) <= {d(RUN_START - timedelta(days=365))} AS use_yoy FROM known GROUP BY chain_id""",
    "run_week": week_capped_of("run_future", "run_yoy"),
    "run_sku": sku_capped_of("run_week", "run_yoy"),
    "run_month": month_capped_of("run_sku", "run_yoy"),
    "run_smooth": smoothed_of("run_month"),
}


def launched_sales(day) -> dict[str, str]:
    """Sales in which every fifth product is first sold on ``day``."""
    return {"sales": f"SELECT * FROM ({NAMED['sales']}) WHERE product_id % 5 <> 2 OR sale_date >= {d(day)}"}


def _needs(text: str) -> set[str]:
    return {n for n in NAMED if re.search(rf"\b{n}\b", text)}


def _sql(body: str, recursive: str | None = None, instead: dict[str, str] | None = None) -> str:
    """Statement with the named subqueries it needs, in order of definition; ``instead`` replaces some."""
    named = NAMED | (instead or {})
    wanted, queue = set(), _needs(body + (recursive or ""))
    while queue:
        name = queue.pop()
        if name not in wanted:
            wanted.add(name)
            queue |= _needs(named[name]) - wanted
    parts = []
    for name, text in named.items():
        if recursive and name == "run_scored":
            parts.append(f"recursion AS ({recursive})")
            recursive = None
        if name in wanted:
            parts.append(f"{name} AS ({text})")
    if recursive:
        parts.append(f"recursion AS ({recursive})")
    return f"WITH RECURSIVE {', '.join(parts)} {body}"


def _features(*names: str) -> str:
    return _sql(f"SELECT {K}, week_start, {history_select(*names)} FROM history WHERE has_actual")


def _index(name: str, keys: str) -> str:
    return _sql(f"SELECT {keys}, {r('szn_index')} AS szn_index FROM {name} WHERE sold")


def _forecast(rows: str, digits: int = 6) -> str:
    return _sql(f"SELECT {K}, week_start, {r('forecast', digits)} AS forecast FROM ({rows})")


def backtest_sql(instead: dict[str, str] | None = None) -> str:
    """All origins through the same recursion, with the origin as one more key."""
    origins = ", ".join(d(o) for o in BACKTEST_ORIGINS)
    model = "coalesce(list_avg(hist[41:52]), 0)"
    base = (
        "coalesce(nullif(hist[1], 0), nullif(hist[50], 0), nullif(hist[51], 0), nullif(hist[52], 0), "
        "nullif(list_avg(hist[41:52]), 0), 0)"
    )
    recursive = f"""
        SELECT {K}, origin, -1 AS step, list(x ORDER BY week_start) AS hist, any_value(is_dense) AS is_dense,
               NULL::DOUBLE AS pf
        FROM (SELECT k.*, CAST(k.origin - INTERVAL (7 * c.back) DAY AS DATE) AS week_start,
                     coalesce(w.weekly_total, 0) AS x
              FROM (SELECT {K}, origin,
                           coalesce(sum(weekly_total) FILTER (WHERE week_start < origin), 0) / any_value(weeks) >= 3.0
                           AND 1.0 - count(*) FILTER (WHERE weekly_total > 0 AND week_start < origin) / any_value(weeks)
                               <= 0.70 AS is_dense
                    FROM weekly, (SELECT origin, date_diff('day', (SELECT min(week_start) FROM weekly), origin) / 7.0
                                         AS weeks FROM (SELECT unnest([{origins}]) AS origin))
                    WHERE week_start < origin + 28 GROUP BY {K}, origin) k
              CROSS JOIN (SELECT unnest(range(1, 53)) AS back) c
              LEFT JOIN weekly w ON k.chain_id = w.chain_id AND k.store_id = w.store_id
                  AND k.product_id = w.product_id AND w.week_start = k.origin - CAST(7 * c.back AS INTEGER))
        GROUP BY {K}, origin
        UNION ALL
        SELECT {K}, origin, step + 1, list_append(hist[2:52], p), is_dense, p
        FROM (SELECT *, CASE WHEN is_dense THEN {model} ELSE {base} END AS p FROM recursion)
        WHERE step + 1 < 4"""
    return _sql(
        f"""
        SELECT origin, count(*) AS forecasts, sum(coalesce(weekly_total, 0)) AS actual,
               {r("sum(abs(coalesce(weekly_total, 0) - pf)) / sum(coalesce(weekly_total, 0))")} AS wape
        FROM (SELECT *, CAST(origin + INTERVAL (7 * step) DAY AS DATE) AS week_start FROM recursion WHERE step >= 0)
        LEFT JOIN weekly USING ({K}, week_start)
        GROUP BY origin""",
        recursive,
        instead,
    )


def run_sql(instead: dict[str, str] | None = None) -> str:
    """The whole forecast with the 12-week mean as model, over past and future weeks."""
    return _sql(
        f"""SELECT week_start, {K}, CAST(greatest(round_even(actual, 0), 0) AS BIGINT) AS actual,
                   CAST(greatest(round_even(coalesce(forecast, 0), 0), 0) AS BIGINT) AS forecast,
                   {r("pred_model")} AS pred_model, {r("pred_base")} AS pred_base
            FROM (SELECT week_start, {K}, actual, forecast, pred_model, pred_base FROM run_nudged
                  WHERE week_start <= {d(LAST_ACTUAL)}
                  UNION ALL
                  SELECT week_start, {K}, actual, forecast, pred_model, pred_base FROM run_smooth)""",
        recursion("known", d(RUN_START + timedelta(days=1)), 20),
        instead,
    )


def replaced_window(key: str, in_window: str) -> str:
    """Both algorithms' rows, those of the first replaced in the window."""
    replaced = f"(week_start >= {d(UPSERT_FROM)} AND {in_window})"
    return f"""
        SELECT {K}, {key} AS date_key, weekly_total AS forecast, algo_id
        FROM weekly CROSS JOIN (SELECT unnest([1, 2]) AS algo_id)
        WHERE algo_id = 2 OR NOT {replaced}
        UNION ALL
        SELECT {K}, {key}, weekly_total + 0.5, 1 FROM weekly WHERE {replaced}"""


def bias_sql(more: str) -> str:
    """Bias factors. A blend factor replaces the one chosen so far if it lowers the error by over 2 %."""
    fold = "lambda best, s: CASE WHEN s.wmape < best.wmape * 0.98 THEN s ELSE best END"
    return f"""
        SELECT chain_id, month_num, {r("least(greatest(1 + best * (a / f - 1), 0.90), 1.10)")} AS bias_factor{more}
        FROM bias_groups CROSS JOIN (
            SELECT nullif(list_reduce(list({{'alpha': alpha, 'wmape': wmape}} ORDER BY alpha), {fold}).alpha, 0.0) AS best
            FROM alpha_errors)
        WHERE best IS NOT NULL"""


def oracles() -> dict[str, str]:
    key = "CAST(strftime(week_start, '%Y%m%d') AS INTEGER)"
    return {
        "src_csv_clean": _sql(
            f"""SELECT {K}, sale_date, CASE WHEN l_linenumber % 5 IN (0, 1) THEN 0.0 ELSE qty END AS qty FROM sales
                WHERE NOT (l_linenumber % 4 = 3 AND l_orderkey % 10 = 0) AND l_orderkey % 17 <> 0"""
        ),
        "norm_columns": _sql(
            f"SELECT {K}, CAST(strftime(sale_date, '%Y%m%d') AS INTEGER) AS sale_date, qty FROM sales"
        ),
        "clean_sales": _sql(
            f"""SELECT {K}, sale_date, CASE WHEN l_orderkey % 7 IN (0, 1) THEN 0.0 ELSE qty END AS qty FROM sales
                WHERE l_orderkey % 3 = 0 OR l_orderkey % 11 <> 0"""
        ),
        "history_before_run": _sql(
            f"""SELECT week_start, {K}, actual, CASE WHEN product_id % 5 = 0 THEN 0.0 ELSE forecast END AS forecast,
                       forecast_run_date
                FROM history_rows WHERE forecast_run_date < {d(AS_OF)}"""
        ),
        "history_upsert": _sql(
            f"""SELECT * FROM history_rows WHERE week_start < {d(UPSERT_FROM)}
                UNION ALL
                SELECT week_start, {K}, actual, forecast + 1, {d(AS_OF)} FROM history_rows
                WHERE week_start >= {d(UPSERT_FROM)}"""
        ),
        "stored_history_upsert": _sql(
            f"""SELECT week_start, {K}, CAST(floor(actual) AS DOUBLE) AS actual, CAST(floor(forecast) AS DOUBLE) AS forecast,
                       CASE WHEN week_start < {d(UPSERT_FROM - timedelta(weeks=30))} THEN {d(RUN_DATE - timedelta(days=2))}
                            ELSE {d(RUN_DATE - timedelta(days=1))} END AS forecast_run_date
                FROM history_rows WHERE week_start < {d(UPSERT_FROM)}
                UNION ALL
                SELECT week_start, {K}, floor(actual), floor(forecast) + 1, {d(RUN_DATE)} FROM history_rows
                WHERE week_start BETWEEN {d(UPSERT_FROM)} AND {d(UPSERT_FROM + timedelta(weeks=9))}"""
        ),
        "replace_window": _sql(replaced_window(key, "TRUE")),
        "stored_replace_window": _sql(replaced_window(key, f"week_start <= DATE '2000-10-31'")),
        "upload_projection": _sql(
            f"""SELECT CASE WHEN product_id % 4 = 1 THEN 0 ELSE {key} END AS date_key, {K},
                       CASE WHEN store_id % 3 = 0 THEN 0.0 ELSE weekly_total END AS forecast,
                       2 AS algo_id, CAST(NULL AS BIGINT) AS supplier_id
                FROM weekly"""
        ),
        "final_output": _sql(
            f"""SELECT {key} AS week_start, {K}, CAST(round_even(actual, 0) AS BIGINT) AS actual,
                       CAST(greatest(round_even(coalesce(forecast, 0), 0), 0) AS BIGINT) AS forecast,
                       {r("pred_model")} AS pred_model, {r("pred_base")} AS pred_base
                FROM scored WHERE week_start >= {d(AS_OF - timedelta(weeks=8))}"""
        ),
        "weekly_totals": _sql("SELECT * FROM weekly"),
        "dense_panel": _sql("SELECT *, weekly_total AS sim_sales FROM dense"),
        "chain_week_totals": _sql(
            f"""SELECT chain_id, week_start, sum(actual) AS actual, {r("sum(forecast)")} AS forecast
                FROM scored GROUP BY chain_id, week_start"""
        ),
        "chain_month_totals": _sql("SELECT chain_id, month_start, total AS weekly_total FROM chain_months"),
        "eligible_chains": _sql("SELECT * FROM chain_weeks WHERE weeks >= 8"),
        "eligible_sales": _sql(
            "SELECT * FROM weekly WHERE chain_id IN (SELECT chain_id FROM chain_weeks WHERE weeks >= 8)"
        ),
        "yoy_eligible": _sql(
            f"""SELECT chain_id, min(week_start) AS first_week,
                       min(week_start) <= {d(AS_OF - timedelta(days=365))} AS use_yoy
                FROM weekly GROUP BY chain_id"""
        ),
        "last_actual": _sql(
            """SELECT max(sale_date) AS last_actual, max(sale_date) + 28 AS forecast_cutoff FROM sales WHERE qty > 0"""
        ),
        "horizon_rows": _sql(
            f"""SELECT {K}, week_start, weekly_total FROM dense
                WHERE week_start >= DATE '2000-09-03' AND week_start < DATE '2000-10-01' AND week_start <= {d(END)}"""
        ),
        "sku_density": _sql(
            f"""SELECT {K}, {r("avg_weekly")} AS avg_weekly, {r("zero_rate")} AS zero_rate, is_dense
                FROM ({density_of("weekly", d(AS_OF))})"""
        ),
        "last_k_per_sku": _sql(
            f"""SELECT {K}, week_start, weekly_total, CAST(rn AS INTEGER) AS recency
                FROM (SELECT *, row_number() OVER (PARTITION BY {K} ORDER BY week_start DESC) AS rn FROM known)
                WHERE rn <= 8"""
        ),
        "merge_update": _sql(
            f"""SELECT {K}, week_start, {r("coalesce(pred_model, weekly_total)")} AS sim_sales
                FROM dense LEFT JOIN (SELECT * FROM scored WHERE week_start >= {d(AS_OF - timedelta(weeks=2))})
                    USING ({K}, week_start)"""
        ),
        "assemble_output": _sql(
            f"""SELECT {K}, week_start, {r("pred_model")} AS pred_model, {r("pred_base")} AS pred_base,
                       coalesce(weekly_total, 0.0) AS actual
                FROM scored LEFT JOIN weekly USING ({K}, week_start)"""
        ),
        "feat_calendar": _sql(
            f"SELECT {K}, week_start, {CALENDAR}, {season('month(week_start)')} AS season FROM weekly"
        ),
        "feat_lags": _features("lag_1w", "lag_2w", "lag_3w", "lag_52w", "diff_1w", "diff_2w"),
        "feat_rolling": _features("roll3w", "roll12w"),
        "feat_intermittency": _features("nonzero_12w", "avg_nonzero_12w"),
        "feat_weeks_since_sale": _features("weeks_since_last_sale"),
        "feat_volatility": _features("volatility_3w"),
        "feat_zero_run": _features("zero_run_length_6w"),
        "feat_sku_3m": _sql(
            f"""SELECT {K}, week_start, prev_sum, {r("prev_mean")} AS prev_mean, curr_sum, {r("curr_mean")} AS curr_mean
                FROM (SELECT *, CAST(date_trunc('month', week_start) AS DATE) AS month_start FROM weekly)
                JOIN level USING ({K}, month_start)"""
        ),
        "feat_category_codes": _sql("SELECT * FROM codes"),
        "baseline_forecast": _sql(
            f"SELECT {K}, week_start, {r(BASELINE)} AS pred_base FROM history WHERE has_actual"
        ),
        "features": _sql(
            f"""SELECT h.*, prev_sum AS sku_3m_sum, {r("prev_mean")} AS sku_3m_mean, chain_code, store_code,
                       product_code, {", ".join(f"{r(c)} AS {c}" for c in (
                           "chain_szn_index", "sku_szn_index", "prod_season_index",
                           "month_chain_szn", "month_sku_szn", "month_prod_season"))}
                FROM (SELECT {K}, week_start, {history_select(*HISTORY_COLUMNS)}, {CALENDAR}
                      FROM history WHERE has_actual) h
                JOIN codes USING ({K})
                JOIN seasonal USING ({K}, week_start)
                JOIN level l ON h.chain_id = l.chain_id AND h.store_id = l.store_id AND h.product_id = l.product_id
                    AND l.month_start = date_trunc('month', h.week_start)"""
        ),
        "train_rows": _sql(
            f"""SELECT {K}, week_start, {r("ln(1 + weekly_total)")} AS label,
                       {history_select(*[c for c in HISTORY_COLUMNS if c != "lag_52w"])}
                FROM history
                WHERE has_actual AND weekly_total >= 0 AND lag_1w IS NOT NULL AND lag_2w IS NOT NULL
                  AND lag_3w IS NOT NULL"""
        ),
        "recency_weights": _sql(
            f"""SELECT {K}, week_start, {r(f'''exp(-0.03 * CASE WHEN avg_nonzero > 40 OR roll12w > 40 THEN 1.5 ELSE 1.0 END
                       * date_diff('day', week_start, {d(AS_OF)}) / 7.0)''')} AS weight
                FROM (SELECT *, CASE WHEN nz12 > 0 THEN sum12 / nz12 ELSE 0 END AS avg_nonzero FROM history
                      WHERE has_actual AND week_start < {d(AS_OF)})"""
        ),
        "szn_global": _index("idx_global", "CAST(month AS INTEGER) AS month"),
        "szn_chain": _index("idx_chain", "chain_id, CAST(month AS INTEGER) AS month"),
        "szn_sku": _index("idx_sku", "chain_id, product_id, CAST(month AS INTEGER) AS month"),
        "szn_product": _index("idx_product", "product_id, season"),
        "szn_features": _sql(
            f"""SELECT {K}, week_start, {", ".join(f"{r(c)} AS {c}" for c in (
                "chain_szn_index", "sku_szn_index", "prod_season_index",
                "month_chain_szn", "month_sku_szn", "month_prod_season"))} FROM seasonal"""
        ),
        "season_direction": _sql("SELECT * FROM directions"),
        "recursive_baseline": _sql(
            f"""SELECT {K}, CAST({d(AS_OF)} + INTERVAL (7 * step) DAY AS DATE) AS week_start, is_dense,
                       {r("pred_model")} AS pred_model, {r("pred_base")} AS pred_base, {r("pred_final")} AS pred_final
                FROM recursion WHERE step >= 0""",
            recursion("weekly", d(AS_OF), 4),
        ),
        "backtest_baseline": backtest_sql(),
        "backtest_launches": backtest_sql(launched_sales(BACKTEST_LAUNCH)),
        "ensemble_weights": _sql(
            f"""SELECT {K}, {r("mae_model")} AS mae_model, {r("mae_base")} AS mae_base, {r("w_model")} AS w_model
                FROM ({weights_of("scored")})"""
        ),
        "ensemble_blend": _forecast(blended_of("scored")),
        "last_actual_sku": _sql(
            f"""SELECT {K}, arg_max(actual, week_start) FILTER (WHERE actual > 0) AS last_nonzero,
                       arg_max(actual, week_start) AS actual_last
                FROM scored WHERE week_start <= {d(LAST_ACTUAL)} GROUP BY {K} HAVING max(actual) > 0"""
        ),
        "anchor_forecast": _forecast(anchored_of("scored")),
        "resid_ewma": _sql(f"SELECT {K}, points, {r('resid_ewma')} AS resid_ewma FROM ({ewma_of('scored')})"),
        "resid_ewma_series": _sql(
            f"""SELECT {K}, a.week_start, {r("any_value(a.actual - a.pred_base)")} AS residual,
                       {r('''CASE WHEN count(*) >= 3 THEN
                           sum((b.actual - b.pred_base) * pow(7 / 9.0, date_diff('day', b.week_start, a.week_start) / 7))
                           / sum(pow(7 / 9.0, date_diff('day', b.week_start, a.week_start) / 7)) END''', 8)} AS resid_ewma
                FROM scored a JOIN scored b USING ({K})
                WHERE a.week_start < {d(AS_OF)} AND b.week_start <= a.week_start
                GROUP BY {K}, a.week_start"""
        ),
        "confidence": _sql(f"SELECT {K}, {r('confidence')} AS confidence FROM ({ewma_of('scored')})"),
        "confidence_series": _sql(
            f"""SELECT {K}, week_start, {r('''CASE WHEN n >= 3 THEN least(greatest(0.6 * share
                       + 0.4 * least(total / 52.0, 1.0), 0.0), 1.0) END''')} AS confidence
                FROM (SELECT *, count(*) OVER w AS n,
                             avg(CASE WHEN weekly_total > 0 THEN 1.0 ELSE 0.0 END) OVER w AS share,
                             count(*) OVER (PARTITION BY {K}) AS total
                      FROM known
                      WINDOW w AS (PARTITION BY {K} ORDER BY week_start ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))"""
        ),
        "residual_nudge": _forecast(nudged_of("scored")),
        "yoy_week_chain": _sql(
            f"""SELECT f.chain_id, f.week_start, {r("f.total")} AS forecast, l.total AS last_year
                FROM (SELECT chain_id, week_start, sum(forecast) AS total FROM inflated GROUP BY ALL) f
                LEFT JOIN (SELECT chain_id, week_start, sum(weekly_total) AS total FROM known GROUP BY ALL) l
                    ON f.chain_id = l.chain_id AND l.week_start = f.week_start - 364"""
        ),
        "yoy_week_sku": _sql(
            f"""SELECT {K}, f.week_start, {r("f.forecast")} AS forecast, l.weekly_total AS last_year
                FROM inflated f LEFT JOIN (SELECT * REPLACE (week_start + 364 AS week_start) FROM known) l
                    USING ({K}, week_start)"""
        ),
        "yoy_month_chain": _sql(
            f"""SELECT f.chain_id, f.month_start, {r("f.total")} AS forecast, l.total AS last_year
                FROM (SELECT chain_id, CAST(date_trunc('month', week_start) AS DATE) AS month_start,
                             sum(forecast) AS total FROM inflated GROUP BY ALL) f
                LEFT JOIN chain_months l ON f.chain_id = l.chain_id
                    AND l.month_start = CAST(f.month_start - INTERVAL 12 MONTH AS DATE)"""
        ),
        "reconcile": _forecast(
            """SELECT * EXCLUDE (forecast),
                   CASE WHEN NOT actual > 0 AND free > 0 AND 1.1 * total - locked > 0
                        THEN forecast * (1.1 * total - locked) / free ELSE forecast END AS forecast
               FROM (SELECT *, sum(forecast) OVER g AS total,
                            coalesce(sum(forecast) FILTER (WHERE actual > 0) OVER g, 0) AS locked,
                            coalesce(sum(forecast) FILTER (WHERE NOT actual > 0) OVER g, 0) AS free
                     FROM scored WINDOW g AS (PARTITION BY chain_id, week_start))""",
            8,
        ),
        "cap_chain_week": _forecast(week_capped_of("inflated", "some_yoy")),
        "cap_sku_yoy": _forecast(sku_capped_of("inflated", "some_yoy")),
        "recent_actuals_base": _sql(
            f"SELECT chain_id, month_start, {r('recent_base')} AS recent_base FROM ({recent_of('fm')})"
        ),
        "past_forecast_base": _sql(
            f"""SELECT fm.chain_id, fm.month_start, {r("avg(h.total)")} AS past_base
                FROM fm LEFT JOIN (
                    SELECT chain_id, CAST(date_trunc('month', week_start) AS DATE) AS month_start, sum(forecast) AS total
                    FROM history_rows WHERE forecast_run_date < {d(AS_OF)} GROUP BY ALL) h
                    ON fm.chain_id = h.chain_id AND h.month_start < fm.month_start
                GROUP BY ALL"""
        ),
        "chain_trend": _sql(f"SELECT chain_id, month_start, {r('trend')} AS trend FROM ({trend_of('fm')})"),
        "cap_chain_month": _forecast(month_capped_of("inflated", "some_yoy")),
        "smooth_month": _forecast(smoothed_of("scored")),
        "actual_vs_forecast": _sql(
            f"SELECT chain_id, week_start, actual, {r('forecast')} AS forecast FROM bias_weeks"
        ),
        "wape_by_chain": _sql(
            f"""SELECT chain_id, {r("sum(abs(actual - forecast)) / nullif(sum(actual), 0)")} AS wape
                FROM one_step GROUP BY chain_id"""
        ),
        "wmape_by_chain": _sql(
            f"""SELECT chain_id, {r("sum(actual * abs(actual - forecast) / actual) / sum(actual)")} AS wmape
                FROM one_step WHERE actual > 0 GROUP BY chain_id"""
        ),
        "fallback_bounds": _sql(
            f"""SELECT {r("CASE WHEN a > 0 AND f > 0 AND lo < hi THEN lo ELSE 0.65 END")} AS low,
                       {r("CASE WHEN a > 0 AND f > 0 AND lo < hi THEN hi ELSE 1.35 END")} AS high
                FROM (SELECT a, f, greatest(0.65, 1 - abs(1 - f / a)) AS lo, least(1.35, 1 + abs(1 - f / a)) AS hi
                      FROM (SELECT sum(a) AS a, sum(f) AS f
                            FROM (SELECT date_trunc('month', week_start) AS m, sum(actual) AS a, sum(forecast) AS f
                                  FROM one_step GROUP BY ALL ORDER BY m DESC LIMIT 6)))"""
        ),
        "bias_alpha_errors": _sql(f"SELECT alpha, {r('wmape')} AS wmape FROM alpha_errors"),
        "bias_table": _sql(bias_sql("")),
        "stored_bias_table": _sql(bias_sql(f", {d(RUN_DATE)} AS run_date")),
        "forecast_run": run_sql(),
        "forecast_run_launches": run_sql(launched_sales(RUN_LAUNCH)),
    }
