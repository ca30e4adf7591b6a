"""Independent SQL statements of the study's inputs and steps, for checking results."""

from __future__ import annotations

import re

# name -> SQL of a common table expression over the warehouse tables or earlier names
STEPS: dict[str, str] = {
    "shipments": """
        SELECT l_suppkey AS company_id, CAST(date_trunc('week', l_shipdate) AS DATE) AS trade_date,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, CAST(l_quantity AS BIGINT) AS quantity
        FROM lineitem""",
    "prices": """
        SELECT company_id, trade_date,
               floor(CAST(sum(cents) AS DOUBLE) / CAST(sum(quantity) AS DOUBLE) * 100 + 0.5) / 1e4 AS adj_close,
               CAST(sum(quantity) AS BIGINT) AS volume
        FROM shipments GROUP BY company_id, trade_date""",
    "market": """
        SELECT trade_date,
               floor(CAST(sum(cents) AS DOUBLE) / CAST(sum(quantity) AS DOUBLE) * 100 + 0.5) / 1e4 AS adj_close,
               CAST(sum(quantity) AS BIGINT) AS volume
        FROM shipments GROUP BY trade_date""",
    "companies": """
        SELECT s_suppkey AS company_id, s_name AS company_name,
               CASE WHEN s_acctbal >= 0 THEN 'S' || s_suppkey END AS ticker_symbol,
               CASE WHEN s_acctbal < 9000 THEN n_name END AS industry
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "lead_line": """
        SELECT l_orderkey AS event_id, l_suppkey AS company_id
        FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey) = 1""",
    "announcements": """
        SELECT event_id, company_id, CAST(o_orderdate AS DATE) AS announcement_date,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice / 100) AS INT) END AS employees_laid_off,
               CASE WHEN o_orderstatus <> 'O'
                    THEN CAST(floor(o_totalprice) AS BIGINT) % 100 / 1e2 END AS percentage_laid_off,
               CASE WHEN o_totalprice >= 100000 THEN floor(o_totalprice) * 3 END AS funds_raised_usd,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS stage
        FROM orders JOIN lead_line ON o_orderkey = event_id""",
    "all_events": """
        SELECT * FROM announcements
        QUALIFY row_number() OVER (
            PARTITION BY company_id, announcement_date
            ORDER BY (CASE WHEN employees_laid_off IS NULL THEN 0 ELSE 1 END)
                   + (CASE WHEN percentage_laid_off IS NULL THEN 0 ELSE 1 END)
                   + (CASE WHEN funds_raised_usd IS NULL THEN 0 ELSE 1 END)
                   + (CASE WHEN stage IS NULL THEN 0 ELSE 1 END) DESC, event_id) = 1""",
    "study": """
        SELECT e.*, c.company_name, c.ticker_symbol, c.industry
        FROM all_events e JOIN companies c USING (company_id) WHERE c.ticker_symbol IS NOT NULL""",
    "days": """
        SELECT trade_date, adj_close, row_number() OVER (ORDER BY trade_date) - 1 AS idx,
               ln(adj_close / lag(adj_close) OVER (ORDER BY trade_date)) AS r_mkt
        FROM market""",
    "returns": """
        SELECT company_id, trade_date, adj_close,
               ln(adj_close / lag(adj_close) OVER (PARTITION BY company_id ORDER BY trade_date)) AS r_stock
        FROM prices""",
    "abnormal": """
        SELECT company_id, idx, trade_date, r_stock, r_mkt, r_stock - r_mkt AS ar
        FROM returns JOIN days USING (trade_date)
        WHERE r_stock IS NOT NULL AND r_mkt IS NOT NULL""",
    "aligned": """
        SELECT s.*, d.idx AS t0 FROM study s ASOF LEFT JOIN days d ON s.announcement_date <= d.trade_date""",
    "spans": """
        SELECT * FROM (VALUES (-30, 30), (-5, 5), (-1, 1), (0, 3)) AS v(ws, we)""",
    "estimation": """
        SELECT a.event_id, CASE WHEN count(x.ar) >= 150 AND a.t0 - 250 >= 1
                                THEN nullif(stddev_samp(x.ar), 0) END AS sigma
        FROM aligned a LEFT JOIN abnormal x
          ON x.company_id = a.company_id AND x.idx BETWEEN a.t0 - 250 AND a.t0 - 31
        GROUP BY a.event_id, a.t0""",
    "sums": """
        SELECT a.event_id, a.company_id, a.t0, w.ws, w.we, sum(x.ar) AS total, count(x.ar) AS n
        FROM aligned a CROSS JOIN spans w LEFT JOIN abnormal x
          ON x.company_id = a.company_id AND x.idx BETWEEN a.t0 + w.ws AND a.t0 + w.we
        WHERE a.t0 IS NOT NULL AND a.company_id IN (SELECT company_id FROM prices)
        GROUP BY a.event_id, a.company_id, a.t0, w.ws, w.we""",
    "windows": """
        SELECT event_id, company_id, t0, ws AS window_start_offset, we AS window_end_offset, car,
               car / n AS avg_ar, car / (sigma * sqrt(we - ws + 1)) AS scar
        FROM (SELECT s.*, e.sigma,
                     CASE WHEN t0 + ws >= 1 AND t0 + we < (SELECT count(*) FROM days)
                           AND n >= (we - ws + 1) * 0.9 THEN total END AS car
              FROM sums s JOIN estimation e USING (event_id))""",
    "stored": """
        SELECT event_id, window_start_offset, window_end_offset, CAST(car AS DECIMAL(10,6)) AS car,
               CAST(avg_ar AS DECIMAL(10,6)) AS avg_ar, CAST(scar AS DECIMAL(10,6)) AS scar
        FROM windows""",
    "headline": """
        SELECT event_id, company_id, car, scar FROM windows
        WHERE window_start_offset = -5 AND window_end_offset = 5""",
    "regimes": """
        SELECT idx, trade_date, CASE WHEN count(r_mkt) OVER w >= 20 THEN sum(r_mkt) OVER w END AS regime
        FROM days WINDOW w AS (ORDER BY idx ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
    "top_industries": """
        SELECT industry, count(*) AS n FROM study WHERE industry IS NOT NULL
        GROUP BY industry ORDER BY n DESC, industry LIMIT 15""",
    "history": """
        SELECT *, row_number() OVER w AS event_rank,
               coalesce(date_diff('day', lag(announcement_date) OVER w, announcement_date), 9999)
                   AS days_since_prior_layoff
        FROM study WINDOW w AS (PARTITION BY company_id ORDER BY announcement_date, event_id)""",
    "features": """
        SELECT h.event_id, h.company_id, h.announcement_date, h.event_rank,
               CASE WHEN h.event_rank > 1 THEN 1 ELSE 0 END AS is_repeat,
               CASE WHEN h.event_rank = 1 THEN 1 ELSE 0 END AS is_first,
               h.days_since_prior_layoff,
               ln(1 + coalesce(h.employees_laid_off, (SELECT median(employees_laid_off) FROM study)))
                   AS log_employees_laid_off,
               CASE WHEN h.percentage_laid_off IS NULL THEN 0 ELSE 1 END AS has_pct,
               coalesce(h.percentage_laid_off, (SELECT median(percentage_laid_off) FROM study))
                   AS pct_laid_off_filled,
               ln(1 + coalesce(h.funds_raised_usd, 0)) AS log_funds_raised,
               CASE WHEN h.funds_raised_usd IS NULL THEN 0 ELSE 1 END AS has_funds,
               coalesce(r.regime, 0) AS market_regime_30d,
               CASE WHEN h.industry IN (SELECT industry FROM top_industries) THEN h.industry ELSE 'Other' END
                   AS industry_top15,
               coalesce(h.stage, 'Unknown') AS stage_clean,
               year(h.announcement_date) AS event_year
        FROM history h ASOF LEFT JOIN regimes r ON h.announcement_date > r.trade_date""",
    "daily": """
        SELECT w.event_id, x.idx - w.t0 AS "offset", x.ar
        FROM windows w JOIN abnormal x
          ON x.company_id = w.company_id AND x.idx BETWEEN w.t0 - 30 AND w.t0 + 30
        WHERE w.window_start_offset = -30 AND w.window_end_offset = 30 AND w.car IS NOT NULL""",
    "monthly": """
        SELECT CAST(date_trunc('month', s.announcement_date) AS DATE) AS month, count(*) AS n_events,
               CAST(sum(w.car) AS DOUBLE) / count(w.car) AS mean_car
        FROM study s LEFT JOIN stored w
          ON w.event_id = s.event_id AND w.window_start_offset = -5 AND w.window_end_offset = 5
        GROUP BY 1""",
}


def statement(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` preceded by every step it mentions, directly or through another step."""
    steps = {**STEPS, **(extra or {})}
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in steps:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                needed.add(name)
                visit(steps[name])

    visit(body)
    ordered = [n for n in steps if n in needed]
    ctes = ",\n".join(f"{n} AS ({steps[n]})" for n in ordered)
    return f"WITH {ctes}\n{body}" if ctes else body


# Least squares solved in SQL: scaled cross-products beside the identity, one Gauss-Jordan pivot per step.
OLS_STEPS: dict[str, str] = {
    "model": "SELECT f.*, h.car AS y FROM features f JOIN headline h USING (event_id) WHERE h.car IS NOT NULL",
    "terms": """
        SELECT term, row_number() OVER (ORDER BY ord, term) AS j FROM (
          SELECT 0 AS ord, 'Intercept' AS term UNION ALL
          SELECT 1, 'C(industry_top15)[T.' || v || ']' FROM (SELECT DISTINCT industry_top15 AS v FROM model)
          WHERE v > (SELECT min(industry_top15) FROM model) UNION ALL
          SELECT 2, 'C(stage_clean)[T.' || v || ']' FROM (SELECT DISTINCT stage_clean AS v FROM model)
          WHERE v > (SELECT min(stage_clean) FROM model) UNION ALL
          SELECT 3, unnest(['log_employees_laid_off', 'pct_laid_off_filled', 'has_pct', 'is_repeat',
                            'days_since_prior_layoff', 'market_regime_30d', 'log_funds_raised', 'has_funds']))""",
    "raw_cells": """
        SELECT event_id,
               unnest(['Intercept', 'C(industry_top15)[T.' || industry_top15 || ']',
                       'C(stage_clean)[T.' || stage_clean || ']', 'log_employees_laid_off', 'pct_laid_off_filled',
                       'has_pct', 'is_repeat', 'days_since_prior_layoff', 'market_regime_30d', 'log_funds_raised',
                       'has_funds']) AS term,
               unnest([1.0::DOUBLE, 1, 1, log_employees_laid_off, pct_laid_off_filled, has_pct, is_repeat,
                       days_since_prior_layoff, market_regime_30d, log_funds_raised, has_funds]) AS v
        FROM model""",
    "scales": "SELECT j, term, sqrt(sum(v * v)) AS scale FROM raw_cells JOIN terms USING (term) GROUP BY j, term",
    "cells": "SELECT event_id, j, v / scale AS v FROM raw_cells JOIN scales USING (term)",
    "tableau": """
        SELECT s.i, s.k, coalesce(g.v, 0) AS v FROM (SELECT a.j AS i, b.j AS k FROM scales a, scales b) s
        LEFT JOIN (SELECT a.j AS i, b.j AS k, sum(a.v * b.v) AS v
                   FROM cells a JOIN cells b USING (event_id) GROUP BY a.j, b.j) g USING (i, k)
        UNION ALL SELECT a.j, 1000 + b.j, CASE WHEN a.j = b.j THEN 1.0 ELSE 0.0 END FROM scales a, scales b""",
    "sweep": """
        SELECT 0 AS step, i, k, v FROM tableau
        UNION ALL
        SELECT s.step + 1, s.i, s.k,
               CASE WHEN s.i = s.step + 1 THEN s.v / pv.v ELSE s.v - cl.v * rw.v / pv.v END
        FROM sweep s JOIN sweep pv ON pv.i = s.step + 1 AND pv.k = s.step + 1
        JOIN sweep rw ON rw.i = s.step + 1 AND rw.k = s.k
        JOIN sweep cl ON cl.i = s.i AND cl.k = s.step + 1
        WHERE s.step < (SELECT max(j) FROM scales)""",
    "inverse": """
        SELECT i, k - 1000 AS k, v FROM sweep WHERE step = (SELECT max(j) FROM scales) AND k > 1000""",
    "solution": """
        SELECT n.i AS j, sum(n.v * x.v) AS b
        FROM inverse n JOIN (SELECT c.j, sum(c.v * m.y) AS v FROM cells c JOIN model m USING (event_id) GROUP BY c.j) x
          ON x.j = n.k
        GROUP BY n.i""",
    "influence": """
        SELECT c.event_id, n.i AS j, sum(n.v * c.v) AS v FROM cells c JOIN inverse n ON n.k = c.j
        GROUP BY c.event_id, n.i""",
    "errors": """
        SELECT m.event_id, m.company_id, m.announcement_date, m.y, m.y - f.fitted AS e, 1 - f.h < 1e-10 AS lost,
               CASE WHEN 1 - f.h < 1e-10 THEN 0 ELSE (m.y - f.fitted) / (1 - f.h) END AS u
        FROM model m JOIN (SELECT c.event_id, sum(c.v * s.b) AS fitted, sum(c.v * g.v) AS h
                           FROM cells c JOIN solution s USING (j) JOIN influence g USING (event_id, j)
                           GROUP BY c.event_id) f USING (event_id)""",
    "robust": """
        SELECT term, b / scale AS coef, CASE WHEN NOT undefined THEN sqrt(vv) / scale END AS std_err_hc3
        FROM scales JOIN solution USING (j) JOIN (
          SELECT j, sum(pow(u * v, 2)) AS vv, bool_or(lost AND abs(v) > 1e-6) AS undefined
          FROM influence JOIN errors USING (event_id) GROUP BY j) USING (j)""",
    # largest eigenvalues of the unscaled cross-products and of their inverse: squared until one direction is left
    "moments": """
        SELECT 'whole' AS side, t.i, t.k, t.v * a.scale * b.scale AS v
        FROM tableau t JOIN scales a ON a.j = t.i JOIN scales b ON b.j = t.k
        UNION ALL
        SELECT 'turned', n.i, n.k, n.v / (a.scale * b.scale)
        FROM inverse n JOIN scales a ON a.j = n.i JOIN scales b ON b.j = n.k""",
    "squares": """
        SELECT 0 AS turn, side, i, k, v / sum(CASE WHEN i = k THEN v ELSE 0 END) OVER (PARTITION BY side) AS v FROM moments
        UNION ALL
        SELECT turn + 1, side, i, k, v / sum(CASE WHEN i = k THEN v ELSE 0 END) OVER (PARTITION BY side)
        FROM (SELECT l.turn, l.side, l.i, r.k, sum(l.v * r.v) AS v
              FROM squares l JOIN squares r ON r.side = l.side AND r.i = l.k
              WHERE l.turn < 14 GROUP BY l.turn, l.side, l.i, r.k)""",
    "eigen": """
        SELECT side, sum(s.v * m.v) AS top FROM squares s JOIN moments m USING (side, i, k) WHERE turn = 14 GROUP BY side""",
    # the covariances of all slopes beside the slopes, eliminated once more: what is left is the joint test
    "slopes": """
        SELECT a.j AS i, b.j AS k, sum(u * u * a.v * b.v) AS v
        FROM influence a JOIN influence b USING (event_id) JOIN errors USING (event_id)
        WHERE a.j > 1 AND b.j > 1 GROUP BY a.j, b.j
        UNION ALL SELECT j, 1000, b FROM solution WHERE j > 1""",
    "pivots": """
        SELECT 1 AS step, i, k, v FROM slopes
        UNION ALL
        SELECT s.step + 1, s.i, s.k, CASE WHEN s.i = s.step + 1 THEN s.v / pv.v ELSE s.v - cl.v * rw.v / pv.v END
        FROM pivots s JOIN pivots pv ON pv.i = s.step + 1 AND pv.k = s.step + 1
        JOIN pivots rw ON rw.i = s.step + 1 AND rw.k = s.k
        JOIN pivots cl ON cl.i = s.i AND cl.k = s.step + 1
        WHERE s.step < (SELECT max(j) FROM scales)""",
    "joint": """
        SELECT CASE WHEN NOT (SELECT bool_or(std_err_hc3 IS NULL) FROM robust WHERE term <> 'Intercept')
                    THEN sum(p.v * s.b) / count(*) END AS f_robust
        FROM pivots p JOIN solution s ON s.j = p.i WHERE p.k = 1000 AND p.step = (SELECT max(j) FROM scales)""",
}


def recursive(body: str, extra: dict[str, str]) -> str:
    """As ``statement``, for steps that refer to themselves."""
    return statement(body, extra).replace("WITH ", "WITH RECURSIVE ", 1)
