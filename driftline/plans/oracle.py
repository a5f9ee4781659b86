"""DuckDB SQL for the registered queries (the driver's correctness oracle).

Written independently of the Spark code: order statistics come from
``row_number``, bins from list functions, the chi-square p-value from the
gamma series 1 - sum_n exp((a + n) ln x - x - lgamma(a + n + 1)). Tables are
the driver's pre-registered views. Derived fixtures (sides, injected nulls,
the noisy label) are written exactly as in ``queries.py``.
"""

from __future__ import annotations

BINS = 10
NA_TOKENS_SQL = ("'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', "
                 "'1.#IND', '1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', "
                 "'nan', 'null'")


def _union(parts):
    return "\n  UNION ALL ".join(parts)


def psi_ctes(cols, src="src", p="p"):
    """CTEs over ``src(side, cols...)`` ending in ``{p}_out(col, ordinal,
    n_base, n_new, psi)``, plus ``{p}_edges`` and ``{p}_coded``."""
    long = _union([f"SELECT side, '{c}' AS col, CAST({c} AS DOUBLE) AS value FROM {src}"
                   for c in cols])
    ords = _union([f"SELECT '{c}' AS col, {i} AS ordinal" for i, c in enumerate(cols)])
    return f"""
{p}_long AS ({long}),
{p}_valid AS (SELECT * FROM {p}_long WHERE value IS NOT NULL AND NOT isnan(value)),
{p}_ranked AS (
  SELECT col, value, row_number() OVER (PARTITION BY col ORDER BY value) - 1 AS rk
  FROM {p}_valid WHERE side = 'base'),
{p}_stats AS (SELECT col, count(*) AS n, min(value) AS mn, max(value) AS mx
              FROM {p}_ranked GROUP BY col),
{p}_probs AS (
  SELECT i, CASE WHEN i = {BINS} THEN CAST(1.0 AS DOUBLE)
                 ELSE CAST(i AS DOUBLE) * (CAST(1.0 AS DOUBLE) / CAST({BINS} AS DOUBLE))
                      + CAST(0.0 AS DOUBLE) END AS q
  FROM range(0, {BINS + 1}) t(i)),
{p}_pos AS (SELECT s.col, q.i, s.n, CAST(s.n - 1 AS DOUBLE) * q.q AS pos
            FROM {p}_stats s CROSS JOIN {p}_probs q),
{p}_idx AS (
  SELECT col, i,
         CASE WHEN pos >= n - 1 THEN n - 1 ELSE CAST(floor(pos) AS BIGINT) END AS lo,
         CASE WHEN pos >= n - 1 THEN n - 1 ELSE CAST(floor(pos) AS BIGINT) + 1 END AS hi,
         CASE WHEN pos >= n - 1 THEN CAST(0.0 AS DOUBLE) ELSE pos - floor(pos) END AS t
  FROM {p}_pos),
{p}_qv AS (
  SELECT x.col, x.i,
         CASE WHEN x.t >= 0.5 THEN h.value - (h.value - l.value) * (1 - x.t)
              ELSE l.value + (h.value - l.value) * x.t END AS q
  FROM {p}_idx x
  JOIN {p}_ranked l ON l.col = x.col AND l.rk = x.lo
  JOIN {p}_ranked h ON h.col = x.col AND h.rk = x.hi),
{p}_uq AS (SELECT col, list_sort(list_distinct(list(q))) AS u FROM {p}_qv GROUP BY col),
{p}_edges AS (
  SELECT u.col,
         CASE WHEN len(u.u) < 3 THEN list_concat(
                list_transform(range(0, {BINS}), lambda i: CAST(i AS DOUBLE)
                               * ((s.mx - s.mn) / CAST({BINS} AS DOUBLE)) + s.mn),
                [s.mx])
              ELSE u.u END AS e
  FROM {p}_uq u JOIN {p}_stats s ON s.col = u.col),
{p}_coded AS (
  SELECT v.side, v.col, v.value,
         CAST(CASE WHEN g.e IS NULL THEN -1
                   WHEN v.value >= g.e[1] AND v.value <= g.e[len(g.e)]
                   THEN least(len(list_filter(g.e[2:], lambda x: v.value >= x)), len(g.e) - 2)
                   ELSE -1 END AS INTEGER) AS code
  FROM {p}_valid v LEFT JOIN {p}_edges g ON g.col = v.col),
{p}_hist AS (
  SELECT col, code, count(*) FILTER (WHERE side = 'base') AS e_cnt,
         count(*) FILTER (WHERE side = 'new') AS a_cnt
  FROM {p}_coded GROUP BY col, code),
{p}_tot AS (
  SELECT col, sum(e_cnt) FILTER (WHERE code >= 0) AS e_in,
         sum(a_cnt) FILTER (WHERE code >= 0) AS a_in
  FROM {p}_hist GROUP BY col),
{p}_shares AS (
  SELECT h.col,
         least(greatest(CAST(h.e_cnt AS DOUBLE) / CAST(greatest(coalesce(t.e_in, 0), 1) AS DOUBLE),
                        CAST(1e-6 AS DOUBLE)), CAST(1.0 AS DOUBLE)) AS e,
         least(greatest(CAST(h.a_cnt AS DOUBLE) / CAST(greatest(coalesce(t.a_in, 0), 1) AS DOUBLE),
                        CAST(1e-6 AS DOUBLE)), CAST(1.0 AS DOUBLE)) AS a
  FROM {p}_hist h JOIN {p}_tot t ON t.col = h.col WHERE h.code >= 0),
{p}_agg AS (SELECT col, sum((a - e) * ln(a / e)) AS psi_raw FROM {p}_shares GROUP BY col),
{p}_nn AS (
  SELECT col, count(*) FILTER (WHERE side = 'base') AS n_base,
         count(*) FILTER (WHERE side = 'new') AS n_new
  FROM {p}_valid GROUP BY col),
{p}_ords AS ({ords}),
{p}_out AS (
  SELECT o.col, o.ordinal,
         CAST(coalesce(nn.n_base, 0) AS BIGINT) AS n_base,
         CAST(coalesce(nn.n_new, 0) AS BIGINT) AS n_new,
         CASE WHEN coalesce(nn.n_base, 0) > 0 AND coalesce(nn.n_new, 0) > 0
              THEN coalesce(a.psi_raw, CAST(0.0 AS DOUBLE)) END AS psi
  FROM {p}_ords o LEFT JOIN {p}_nn nn ON nn.col = o.col LEFT JOIN {p}_agg a ON a.col = o.col)"""


PSI_STATUS = ("CASE WHEN psi IS NULL OR isnan(psi) THEN 'insufficient_data' "
              "WHEN psi > 0.25 THEN 'drift' ELSE 'ok' END")


def chi2_sf_sql(stat: str, dof: str) -> str:
    """Upper tail of chi-square(dof) at stat by the series of P(a, x)."""
    a = f"(CAST({dof} AS DOUBLE) / CAST(2.0 AS DOUBLE))"
    x = f"({stat} / CAST(2.0 AS DOUBLE))"
    n_terms = f"CAST(ceil({x} + 20 * sqrt({x}) + 100) AS BIGINT)"
    series = (f"list_sum(list_transform(range(0, {n_terms}), lambda n: "
              f"exp(({a} + n) * ln({x}) - {x} - lgamma({a} + n + 1))))")
    return (f"CASE WHEN {stat} IS NULL THEN NULL WHEN {stat} <= 0 THEN CAST(1.0 AS DOUBLE) "
            f"ELSE greatest(CAST(0.0 AS DOUBLE), least(CAST(1.0 AS DOUBLE), 1 - {series})) END")


def chi_ctes(cols, src="src", p="c"):
    """CTEs over ``src(side, cols...)`` ending in ``{p}_out(col, ordinal, k,
    dof, statistic, p_value, n_base, n_new)``."""
    long = _union([f"SELECT side, '{c}' AS col, coalesce(CAST({c} AS VARCHAR), 'nan') AS category "
                   f"FROM {src}" for c in cols])
    ords = _union([f"SELECT '{c}' AS col, {i} AS ordinal" for i, c in enumerate(cols)])
    cell = ("pow(abs(CAST({o} AS DOUBLE) - CAST({r} AS DOUBLE) * cat_total / total) - "
            "CASE WHEN k = 2 THEN least(CAST(0.5 AS DOUBLE), abs(CAST({o} AS DOUBLE) - "
            "CAST({r} AS DOUBLE) * cat_total / total)) ELSE CAST(0.0 AS DOUBLE) END, 2) / "
            "(CAST({r} AS DOUBLE) * cat_total / total)")
    term = cell.format(o="n_base", r="r_base") + " + " + cell.format(o="n_new", r="r_new")
    return f"""
{p}_long AS ({long}),
{p}_ct AS (
  SELECT col, category, count(*) FILTER (WHERE side = 'base') AS n_base,
         count(*) FILTER (WHERE side = 'new') AS n_new
  FROM {p}_long GROUP BY col, category),
{p}_tot AS (SELECT col, sum(n_base) AS r_base, sum(n_new) AS r_new, count(*) AS k
            FROM {p}_ct GROUP BY col),
{p}_cells AS (
  SELECT c.col, c.n_base, c.n_new, t.r_base, t.r_new, t.k,
         CAST(t.r_base + t.r_new AS DOUBLE) AS total,
         CAST(c.n_base + c.n_new AS DOUBLE) AS cat_total
  FROM {p}_ct c JOIN {p}_tot t ON t.col = c.col),
{p}_stat AS (
  SELECT col, any_value(k) AS k, any_value(r_base) AS r_base, any_value(r_new) AS r_new,
         sum(CASE WHEN r_base > 0 AND r_new > 0 THEN {term} END) AS statistic
  FROM {p}_cells GROUP BY col),
{p}_ords AS ({ords}),
{p}_pre AS (
  SELECT o.col, o.ordinal, CAST(coalesce(s.k, 0) AS INTEGER) AS k,
         CAST(greatest(coalesce(s.k, 0) - 1, 0) AS INTEGER) AS dof,
         CASE WHEN coalesce(s.k, 0) < 2 THEN CAST(0.0 AS DOUBLE)
              WHEN coalesce(s.r_base, 0) > 0 AND coalesce(s.r_new, 0) > 0 THEN s.statistic END
              AS statistic,
         CAST(coalesce(s.r_base, 0) AS BIGINT) AS n_base,
         CAST(coalesce(s.r_new, 0) AS BIGINT) AS n_new
  FROM {p}_ords o LEFT JOIN {p}_stat s ON s.col = o.col),
{p}_out AS (
  SELECT *, CASE WHEN k < 2 THEN CAST(1.0 AS DOUBLE) ELSE {chi2_sf_sql('statistic', 'dof')} END
            AS p_value
  FROM {p}_pre)"""


P_STATUS = ("CASE WHEN p_value IS NULL THEN 'insufficient_data' WHEN p_value < 0.01 "
            "THEN 'drift' ELSE 'ok' END")

LINEITEM_PSI_SRC = """src AS (
  SELECT CASE WHEN year(l_shipdate) <= 1998 THEN 'base' ELSE 'new' END AS side,
         l_quantity, l_extendedprice, l_discount, l_tax,
         l_quantity * 0.0 + 1.0 AS const_one,
         CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS flag_r
  FROM lineitem)"""
LINEITEM_PSI_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "const_one",
                     "flag_r"]

PSI_NUMERIC = f"""WITH {LINEITEM_PSI_SRC},{psi_ctes(LINEITEM_PSI_COLS)}
SELECT col AS "column", n_base, n_new, round(psi, 6) AS psi, {PSI_STATUS} AS status
FROM p_out"""

BIN_EDGES = f"""WITH {LINEITEM_PSI_SRC},{psi_ctes(LINEITEM_PSI_COLS)}
SELECT col AS "column", CAST(unnest(range(0, len(e))) AS INTEGER) AS edge_index,
       round(unnest(e), 6) AS edge
FROM p_edges"""

HISTOGRAM = f"""WITH {LINEITEM_PSI_SRC},{psi_ctes(LINEITEM_PSI_COLS)}
SELECT col AS "column", side, code AS bin, CAST(count(*) AS BIGINT) AS cnt
FROM p_coded GROUP BY col, side, code"""


def _chi_block(src_sql, cols, source, p):
    return src_sql, chi_ctes(cols, src=f"{p}_src", p=p), (
        f"SELECT '{source}' AS source, col AS \"column\", k, dof, round(statistic, 6) AS statistic, "
        f"round(p_value, 6) AS p_value, {P_STATUS} AS status FROM {p}_out")


def _chi_square_categorical():
    blocks = [
        ("ev_src AS (SELECT CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 'base' "
         "ELSE 'new' END AS side, event_type FROM events)", ["event_type"], "events", "ev"),
        ("od_src AS (SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-01-01 00:00:00' THEN 'base' "
         "ELSE 'new' END AS side, o_orderstatus, o_orderpriority FROM orders)",
         ["o_orderstatus", "o_orderpriority"], "orders", "od"),
        ("li_src AS (SELECT CASE WHEN year(l_shipdate) <= 1998 THEN 'base' ELSE 'new' END "
         "AS side, l_linestatus, l_returnflag FROM lineitem)",
         ["l_linestatus", "l_returnflag"], "lineitem", "li"),
    ]
    ctes, selects = [], []
    for src_sql, cols, source, p in blocks:
        s, c, sel = _chi_block(src_sql, cols, source, p)
        ctes += [s, c]
        selects.append(sel)
    return "WITH " + ",".join(ctes) + "\n" + "\nUNION ALL\n".join(selects)


CHI_SQUARE_CATEGORICAL = _chi_square_categorical()

ORDERS_REPORT_CTES = f"""src AS (
  SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-01-01 00:00:00' THEN 'base' ELSE 'new' END
         AS side, o_totalprice, o_orderstatus, o_orderpriority
  FROM orders WHERE o_orderdate IS NOT NULL),{psi_ctes(["o_totalprice"])},{chi_ctes(
    ["o_orderstatus", "o_orderpriority"])},
report AS (
  SELECT col AS "column", 'numeric' AS kind, round(psi, 4) AS psi,
         CAST(NULL AS DOUBLE) AS statistic, CAST(NULL AS INTEGER) AS dof,
         CAST(NULL AS DOUBLE) AS p_value, {PSI_STATUS} AS status
  FROM p_out
  UNION ALL
  SELECT col, 'categorical', CAST(NULL AS DOUBLE), round(statistic, 6), dof,
         round(p_value, 6), {P_STATUS}
  FROM c_out)"""

DRIFT_REPORT = f"WITH {ORDERS_REPORT_CTES}\nSELECT * FROM report"
DRIFT_REPORT_FILE = (f"WITH {ORDERS_REPORT_CTES}\nSELECT kind AS section, \"column\", "
                     "coalesce(psi, p_value) AS value, status FROM report")
DRIFT_ANY = (f"WITH {ORDERS_REPORT_CTES}\nSELECT coalesce(bool_or(status = 'drift'), false) "
             "AS drift FROM report")

DRIFT_REPORT_MISMATCH = f"""WITH src AS (
  SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-01-01 00:00:00' THEN 'base' ELSE 'new' END
         AS side, o_orderstatus, o_orderpriority
  FROM orders WHERE o_orderdate IS NOT NULL),{chi_ctes(["o_orderstatus", "o_orderpriority"])}
SELECT 'o_totalprice' AS "column", 'numeric' AS kind, CAST(NULL AS DOUBLE) AS psi,
       CAST(NULL AS DOUBLE) AS statistic, CAST(NULL AS INTEGER) AS dof,
       CAST(NULL AS DOUBLE) AS p_value, 'type_mismatch' AS status
UNION ALL
SELECT col, 'categorical', CAST(NULL AS DOUBLE), round(statistic, 6), dof, round(p_value, 6),
       {P_STATUS}
FROM c_out"""

FAMILY_FEATURES = """SELECT l_orderkey, l_linenumber,
       1 + (l_linenumber - 1) + CAST(round(l_tax * 100) AS INTEGER) % 3 AS FamilySize,
       CASE WHEN (l_linenumber - 1) + CAST(round(l_tax * 100) AS INTEGER) % 3 = 0 THEN 1 ELSE 0 END
         AS IsAlone
FROM lineitem"""

DRIFT_BY_WINDOW = f"""WITH src AS (
  SELECT 'base' AS side, value FROM events WHERE ts < TIMESTAMP '2024-01-08 00:00:00'),
{psi_ctes(["value"])},
ev AS (
  SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS window_day, 'value' AS col,
         CAST(value AS DOUBLE) AS value
  FROM events WHERE value IS NOT NULL AND NOT isnan(value)),
evc AS (
  SELECT v.window_day, v.col,
         CAST(CASE WHEN g.e IS NULL THEN -1
                   WHEN v.value >= g.e[1] AND v.value <= g.e[len(g.e)]
                   THEN least(len(list_filter(g.e[2:], lambda x: v.value >= x)), len(g.e) - 2)
                   ELSE -1 END AS INTEGER) AS code
  FROM ev v LEFT JOIN p_edges g ON g.col = v.col),
wc AS (SELECT window_day, col, code, count(*) AS a_cnt FROM evc GROUP BY ALL),
bc AS (SELECT col, code, count(*) AS e_cnt FROM p_coded WHERE code >= 0 GROUP BY ALL),
nw AS (SELECT window_day, col, sum(a_cnt) AS n_new FROM wc GROUP BY ALL),
grid AS (SELECT nw.window_day, nw.col, bc.code, bc.e_cnt FROM nw JOIN bc ON bc.col = nw.col),
cells AS (
  SELECT coalesce(g.window_day, w.window_day) AS window_day, coalesce(g.col, w.col) AS col,
         coalesce(g.e_cnt, 0) AS e_cnt, coalesce(w.a_cnt, 0) AS a_cnt
  FROM grid g FULL OUTER JOIN (SELECT * FROM wc WHERE code >= 0) w
    ON g.window_day = w.window_day AND g.col = w.col AND g.code = w.code),
tot AS (SELECT window_day, col, sum(e_cnt) AS e_in, sum(a_cnt) AS a_in FROM cells GROUP BY ALL),
sh AS (
  SELECT c.window_day, c.col, c.e_cnt,
         least(greatest(CAST(c.e_cnt AS DOUBLE) / CAST(greatest(t.e_in, 1) AS DOUBLE),
                        CAST(1e-6 AS DOUBLE)), CAST(1.0 AS DOUBLE)) AS e,
         least(greatest(CAST(c.a_cnt AS DOUBLE) / CAST(greatest(t.a_in, 1) AS DOUBLE),
                        CAST(1e-6 AS DOUBLE)), CAST(1.0 AS DOUBLE)) AS a
  FROM cells c JOIN tot t ON t.window_day = c.window_day AND t.col = c.col),
agg AS (SELECT window_day, col, sum((a - e) * ln(a / e)) AS psi, sum(e_cnt) AS n_base
        FROM sh GROUP BY ALL),
fin AS (
  SELECT nw.window_day, nw.col, CAST(nw.n_new AS BIGINT) AS n_new,
         CASE WHEN nw.n_new > 0 AND coalesce(agg.n_base, 0) > 0
              THEN coalesce(agg.psi, CAST(0.0 AS DOUBLE)) END AS psi
  FROM nw LEFT JOIN agg ON agg.window_day = nw.window_day AND agg.col = nw.col)
SELECT window_day, col AS "column", n_new, round(psi, 6) AS psi, {PSI_STATUS} AS status
FROM fin"""

_ALL_DAYS = """nw AS (SELECT d.window_day, 'value' AS col, coalesce(sum(w.a_cnt), 0) AS n_new
       FROM (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS window_day FROM nulled) d
       LEFT JOIN wc w ON w.window_day = d.window_day GROUP BY ALL)"""
DRIFT_BY_WINDOW_NULLS = DRIFT_BY_WINDOW.replace("FROM events", "FROM nulled").replace(
    "WITH src AS", """WITH nulled AS (SELECT ts, CASE WHEN strftime(ts, '%Y-%m-%d')
    NOT IN ('2024-01-10', '2024-01-20') THEN value END AS value FROM events), src AS""", 1).replace(
    "nw AS (SELECT window_day, col, sum(a_cnt) AS n_new FROM wc GROUP BY ALL)", _ALL_DAYS)

DRIFT_BY_WINDOW_MISMATCH = DRIFT_BY_WINDOW.replace("FROM events", "FROM nulled").replace(
    "WITH src AS", """WITH nulled AS (SELECT ts, bad, CASE WHEN NOT bad THEN value END AS value FROM (
    SELECT *, (strftime(ts, '%Y-%m-%d') = '2024-01-12' AND event_id % 10 = 0)
              OR strftime(ts, '%Y-%m-%d') = '2024-01-22' AS bad FROM events)),
misfits AS (SELECT strftime(ts, '%Y-%m-%d') AS window_day, count(*) FILTER (WHERE bad) AS n_misfit FROM nulled GROUP BY 1),
src AS""", 1).replace(
    "nw AS (SELECT window_day, col, sum(a_cnt) AS n_new FROM wc GROUP BY ALL)", _ALL_DAYS).replace(
    f"""SELECT window_day, col AS "column", n_new, round(psi, 6) AS psi, {PSI_STATUS} AS status
FROM fin""", f"""SELECT window_day, col AS "column", n_new, CAST(n_misfit AS BIGINT) AS n_misfit,
       CASE WHEN n_misfit = 0 THEN round(psi, 6) END AS psi,
       CASE WHEN n_misfit > 0 THEN 'type_mismatch' ELSE {PSI_STATUS} END AS status
FROM fin JOIN misfits USING (window_day)""")

OPEN_WINDOWS = DRIFT_BY_WINDOW.replace("WITH src AS", """WITH arrived AS (
  SELECT ts, value, date_trunc('day', ts) + INTERVAL 1 DAY AS w_end,
         CASE WHEN day(ts) <= 9 AND event_id % 25 = 0 THEN 1 WHEN day(ts) <= 15 AND event_id % 25 = 1 THEN 2
              WHEN day(ts) <= 10 THEN 0 WHEN day(ts) <= 20 THEN 1 ELSE 2 END AS arrival FROM events),
marks AS (SELECT b, (SELECT max(ts) FROM arrived WHERE arrival < b) - INTERVAL 1 HOUR AS mark FROM range(0, 4) r(b)),
timed AS (SELECT a.*, coalesce(a.w_end <= m.mark, false) AS late FROM arrived a JOIN marks m ON m.b = a.arrival),
counts AS (SELECT strftime(ts, '%Y-%m-%d') AS window_day, any_value(w_end) AS w_end,
                  count(*) FILTER (WHERE NOT late) AS rows, count(*) FILTER (WHERE late) AS late_rows FROM timed GROUP BY 1),
src AS""", 1).replace("FROM events WHERE value IS NOT NULL", "FROM timed WHERE NOT late AND value IS NOT NULL").replace(
    f"""SELECT window_day, col AS "column", n_new, round(psi, 6) AS psi, {PSI_STATUS} AS status
FROM fin""", f"""SELECT window_day, col AS "column", CAST(rows AS BIGINT) AS rows, CAST(late_rows AS BIGINT) AS late_rows,
       CASE WHEN w_end <= (SELECT mark FROM marks WHERE b = 3) THEN 'closed' ELSE 'open' END AS phase,
       round(psi, 4) AS psi, {PSI_STATUS} AS status
FROM fin JOIN counts USING (window_day)""")


def _chi_square_by_window():
    cell = ("pow(abs(CAST({o} AS DOUBLE) - CAST({r} AS DOUBLE) * cat_total / total) - "
            "CASE WHEN k = 2 THEN least(CAST(0.5 AS DOUBLE), abs(CAST({o} AS DOUBLE) - "
            "CAST({r} AS DOUBLE) * cat_total / total)) ELSE CAST(0.0 AS DOUBLE) END, 2) / "
            "(CAST({r} AS DOUBLE) * cat_total / total)")
    term = cell.format(o="n_base", r="r_base") + " + " + cell.format(o="n_new", r="r_new")
    return f"""WITH b AS (
  SELECT 'event_type' AS col, coalesce(CAST(event_type AS VARCHAR), 'nan') AS category,
         count(*) AS e_cnt
  FROM events WHERE ts < TIMESTAMP '2024-01-08 00:00:00' GROUP BY ALL),
w AS (
  SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS window_day, 'event_type' AS col,
         coalesce(CAST(event_type AS VARCHAR), 'nan') AS category, count(*) AS a_cnt
  FROM events GROUP BY ALL),
wins AS (SELECT DISTINCT window_day, col FROM w),
grid AS (SELECT wins.window_day, wins.col, b.category, b.e_cnt FROM wins JOIN b ON b.col = wins.col),
t AS (
  SELECT coalesce(g.window_day, w.window_day) AS window_day, coalesce(g.col, w.col) AS col,
         coalesce(g.e_cnt, 0) AS n_base, coalesce(w.a_cnt, 0) AS n_new
  FROM grid g FULL OUTER JOIN w
    ON g.window_day = w.window_day AND g.col = w.col AND g.category = w.category),
tot AS (SELECT window_day, col, sum(n_base) AS r_base, sum(n_new) AS r_new, count(*) AS k
        FROM t GROUP BY ALL),
cells AS (
  SELECT t.*, tot.r_base, tot.r_new, tot.k, CAST(tot.r_base + tot.r_new AS DOUBLE) AS total,
         CAST(t.n_base + t.n_new AS DOUBLE) AS cat_total
  FROM t JOIN tot ON tot.window_day = t.window_day AND tot.col = t.col),
st AS (
  SELECT window_day, col, any_value(k) AS k, any_value(r_base) AS r_base,
         any_value(r_new) AS r_new,
         sum(CASE WHEN r_base > 0 AND r_new > 0 THEN {term} END) AS statistic
  FROM cells GROUP BY ALL),
pre AS (
  SELECT window_day, col, CAST(k AS INTEGER) AS k, CAST(greatest(k - 1, 0) AS INTEGER) AS dof,
         CASE WHEN k < 2 THEN CAST(0.0 AS DOUBLE)
              WHEN r_base > 0 AND r_new > 0 THEN statistic END AS statistic
  FROM st),
fin AS (
  SELECT *, CASE WHEN k < 2 THEN CAST(1.0 AS DOUBLE) ELSE {chi2_sf_sql('statistic', 'dof')} END
            AS p_value
  FROM pre)
SELECT window_day, col AS "column", k, dof, round(statistic, 6) AS statistic,
       round(p_value, 6) AS p_value, {P_STATUS} AS status
FROM fin"""


CHI_SQUARE_BY_WINDOW = _chi_square_by_window()

def _report_by_window():
    psi_part = DRIFT_BY_WINDOW.replace(
        'SELECT window_day, col AS "column", n_new, round(psi, 6) AS psi, ' + PSI_STATUS
        + ' AS status\nFROM fin',
        'SELECT window_day, col AS "column", \'numeric\' AS kind, round(psi, 4) AS psi, '
        'CAST(NULL AS DOUBLE) AS statistic, CAST(NULL AS INTEGER) AS dof, '
        'CAST(NULL AS DOUBLE) AS p_value, ' + PSI_STATUS + ' AS status\nFROM fin')
    chi_part = CHI_SQUARE_BY_WINDOW.replace(
        'SELECT window_day, col AS "column", k, dof, round(statistic, 6) AS statistic,',
        'SELECT window_day, col AS "column", \'categorical\' AS kind, '
        'CAST(NULL AS DOUBLE) AS psi, round(statistic, 6) AS statistic, dof,')
    assert psi_part != DRIFT_BY_WINDOW and chi_part != CHI_SQUARE_BY_WINDOW
    return f"SELECT * FROM ({psi_part}) UNION ALL SELECT * FROM ({chi_part})"


REPORT_BY_WINDOW = _report_by_window()

LINEITEM_NULLS = """src AS (
  SELECT l_orderkey,
         CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_linenumber END AS l_linenumber,
         CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
         CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_discount END AS l_discount,
         l_tax,
         CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag,
         l_linestatus
  FROM lineitem)"""

PREP_FILL_CONSTANT = f"""WITH {LINEITEM_NULLS}
SELECT l_orderkey, l_linenumber,
       coalesce(l_quantity, CAST(0.0 AS DOUBLE)) AS l_quantity,
       coalesce(l_discount, CAST(0.0 AS DOUBLE)) AS l_discount,
       coalesce(l_returnflag, 'S') AS l_returnflag
FROM src"""


def _lower_median(c):
    return (f"med_{c} AS (SELECT value FROM (SELECT CAST({c} AS DOUBLE) AS value, "
            f"row_number() OVER (ORDER BY {c}) - 1 AS rk, count(*) OVER () AS n "
            f"FROM src WHERE {c} IS NOT NULL) WHERE rk = CAST(ceil(0.5 * n) AS BIGINT) - 1)")


BASELINE_MEDIAN_UNKNOWN = f"""WITH {LINEITEM_NULLS},
{",".join(_lower_median(c) for c in ["l_quantity", "l_discount", "l_tax", "l_linenumber"])}
SELECT l_orderkey,
       coalesce(l_quantity, (SELECT value FROM med_l_quantity)) AS l_quantity,
       coalesce(l_discount, (SELECT value FROM med_l_discount)) AS l_discount,
       coalesce(l_tax, (SELECT value FROM med_l_tax)) AS l_tax,
       coalesce(l_linenumber, CAST(trunc((SELECT value FROM med_l_linenumber)) AS INTEGER))
         AS l_linenumber,
       coalesce(l_returnflag, 'Unknown') AS l_returnflag,
       coalesce(l_linestatus, 'Unknown') AS l_linestatus
FROM src"""

CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"

NA_TOKENS_CAST = f"""WITH t AS (
  SELECT event_id,
         CASE WHEN event_id % 11 = 0 THEN 'NA' WHEN event_id % 13 = 0 THEN 'n/a'
              WHEN event_id % 17 = 0 THEN 'oops'
              ELSE regexp_extract(props, '([0-9]+)', 1) END AS txt
  FROM events),
c AS (SELECT event_id, CASE WHEN txt IN ({NA_TOKENS_SQL}) THEN NULL ELSE txt END AS txt FROM t)
SELECT CAST(event_id AS BIGINT) AS event_id, txt IS NULL AS txt_is_null,
       coalesce(TRY_CAST(txt AS DOUBLE), CAST(0.0 AS DOUBLE)) AS parsed
FROM c"""


def _rank_cte(name, col, tbl):
    return (f"{name} AS (SELECT {col} AS v, row_number() OVER (ORDER BY count(*) DESC, {col}) - 1 "
            f"AS idx, count(*) OVER () AS k FROM {tbl} GROUP BY {col})")


CATEGORY_INDEX = f"""WITH {_rank_cte("p", "o_orderpriority", "orders")},
{_rank_cte("s", "o_orderstatus", "orders")}
SELECT o.o_orderkey, CAST(p.idx AS DOUBLE) AS o_orderpriority_idx,
       CAST(s.idx AS DOUBLE) AS o_orderstatus_idx
FROM orders o JOIN p ON p.v = o.o_orderpriority JOIN s ON s.v = o.o_orderstatus"""

ONE_HOT = f"""WITH {_rank_cte("p", "o_orderpriority", "orders")},
{_rank_cte("s", "o_orderstatus", "orders")}
SELECT o.o_orderkey,
       CAST(CASE WHEN p.idx < p.k THEN p.idx END AS INTEGER) AS priority_slot,
       CAST(p.k AS INTEGER) AS priority_size,
       CAST(CASE WHEN s.idx < s.k THEN s.idx END AS INTEGER) AS status_slot,
       CAST(s.k AS INTEGER) AS status_size
FROM orders o JOIN p ON p.v = o.o_orderpriority JOIN s ON s.v = o.o_orderstatus"""

ASSEMBLED = f"""WITH {_rank_cte("rf", "l_returnflag", "lineitem")},
{_rank_cte("ls", "l_linestatus", "lineitem")},
b AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_discount, l.l_tax,
         rf.idx AS rfi, rf.k AS rfk, ls.idx AS lsi
  FROM lineitem l JOIN rf ON rf.v = l.l_returnflag JOIN ls ON ls.v = l.l_linestatus)
SELECT l_orderkey, l_linenumber, 0 AS slot, l_quantity AS value FROM b WHERE l_quantity <> 0
UNION ALL SELECT l_orderkey, l_linenumber, 1, l_discount FROM b WHERE l_discount <> 0
UNION ALL SELECT l_orderkey, l_linenumber, 2, l_tax FROM b WHERE l_tax <> 0
UNION ALL SELECT l_orderkey, l_linenumber, CAST(3 + rfi AS INTEGER), CAST(1.0 AS DOUBLE) FROM b
UNION ALL SELECT l_orderkey, l_linenumber, CAST(3 + rfk + lsi AS INTEGER), CAST(1.0 AS DOUBLE)
  FROM b"""

HASH_BUCKET = ("CAST(CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || ':42'), 1, 8) "
               "AS UBIGINT) % 1000 AS INTEGER)")
HASH_SPLIT = f"""SELECT o_orderkey, {HASH_BUCKET} AS bucket, {HASH_BUCKET} < 800 AS is_train
FROM orders"""

SCORED_RULE = """s AS (
  SELECT CAST(l_quantity + (l_orderkey * 7 + l_linenumber * 13) % 41 - 20 > 25 AS DOUBLE)
           AS label,
         l_quantity AS score,
         CAST(l_quantity > 25 AS DOUBLE) AS prediction
  FROM lineitem)"""

ACCURACY = f"""WITH {SCORED_RULE}
SELECT round(avg(CASE WHEN label = prediction THEN CAST(1.0 AS DOUBLE)
                      ELSE CAST(0.0 AS DOUBLE) END), 6) AS accuracy,
       CAST(count(*) AS BIGINT) AS n
FROM s"""

AUC_EXACT = f"""WITH {SCORED_RULE},
g AS (SELECT score, sum(CASE WHEN label > 0.5 THEN 1 ELSE 0 END) AS pos,
             sum(CASE WHEN label > 0.5 THEN 0 ELSE 1 END) AS neg
      FROM s WHERE score IS NOT NULL GROUP BY score),
c AS (SELECT pos, neg, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING
                                      AND CURRENT ROW) - neg AS below FROM g)
SELECT round(sum(CAST(pos AS DOUBLE) * (CAST(below AS DOUBLE) + CAST(neg AS DOUBLE) / 2.0))
             / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 6) AS auc,
       CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives
FROM c"""

CONFUSION = f"""WITH {SCORED_RULE}
SELECT label, CAST(count(*) FILTER (WHERE prediction = 0.0) AS BIGINT) AS pred_0,
       CAST(count(*) FILTER (WHERE prediction = 1.0) AS BIGINT) AS pred_1
FROM s GROUP BY label"""

RETRAIN_DECISION = f"""WITH src AS (
  SELECT CASE WHEN year(l_shipdate) <= 1998 THEN 'base' ELSE 'new' END AS side,
         l_quantity, l_extendedprice, l_discount, l_tax
  FROM lineitem),{psi_ctes(["l_quantity", "l_extendedprice", "l_discount", "l_tax"])}
SELECT coalesce(bool_or(psi > 0.25), false) AS drift, false AS check_failed, false AS forced,
       coalesce(bool_or(psi > 0.25), false) AS retrained
FROM p_out"""

RETRAIN_JOB = f"""SELECT d.drift, true AS retrained, count(*) AS scored, CAST(1 AS BIGINT) AS runs,
       count(*) AS dataset_rows, 4 AS reported
FROM lineitem, ({RETRAIN_DECISION}) d GROUP BY d.drift"""

SCORE_STREAM_VS_BATCH = "SELECT count(*) AS scored, CAST(0 AS BIGINT) AS different FROM lineitem"

_TRAIN_ROWS = """t AS (SELECT *, CAST(l_quantity + (l_orderkey * 7 + l_linenumber * 13) % 41 - 20 > 25 AS DOUBLE) AS y
  FROM lineitem WHERE CAST(CAST('0x' || substr(md5((l_orderkey * 8 + l_linenumber) || ':42'), 1, 8)
       AS BIGINT) % 1000 AS INTEGER) < 800)"""
TRAIN_LOGREG_MOMENTS = f"WITH {_TRAIN_ROWS}\n" + " UNION ALL ".join(
    f"SELECT '{n}' AS feature, round(avg({x} * y), 6) AS moment, true AS fit_within_0_1_percent FROM t" for n, x in [
        ("(intercept)", "1.0"), ("l_quantity", "l_quantity"), ("l_discount", "l_discount"), ("l_tax", "l_tax"),
        *((f"l_returnflag={v}", f"CAST(l_returnflag = '{v}' AS DOUBLE)") for v in "ANR")])

RUN_SERIES = """WITH r AS (
  SELECT o_orderpriority AS experiment,
         strftime(o_orderdate + to_seconds(o_orderkey), '%Y-%m-%dT%H:%M:%SZ') AS timestamp,
         CASE WHEN o_orderkey % 13 = 0 THEN CAST(0.0 AS DOUBLE)
              ELSE o_totalprice / 600000.0 END AS accuracy,
         o_totalprice / 1000.0 AS fit_time_sec,
         CAST(CASE WHEN o_orderkey % 17 = 0 THEN 0 ELSE o_orderkey % 8 END AS INTEGER)
           AS shuffle_partitions,
         o_orderkey
  FROM orders)
SELECT experiment,
       CAST(row_number() OVER (PARTITION BY experiment ORDER BY timestamp, o_orderkey) AS INTEGER)
         AS run_index,
       timestamp, accuracy, fit_time_sec, shuffle_partitions
FROM r"""

_PASSENGERS = "(SELECT *, CAST(l_linenumber % 3 + 1 AS VARCHAR) AS pclass FROM lineitem)"
TRAINING_LAYOUT = f"""WITH {_rank_cte("rf", "l_returnflag", "lineitem")},
{_rank_cte("ls", "l_linestatus", "lineitem")}, {_rank_cte("pc", "pclass", _PASSENGERS)},
b AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, pc.idx AS pci, pc.k AS pck, rf.idx AS rfi, rf.k AS rfk, ls.idx AS lsi,
         CAST(l_quantity + (l_orderkey * 7 + l_linenumber * 13) % 41 - 20 > 25 AS DOUBLE) AS label
  FROM {_PASSENGERS} l JOIN rf ON rf.v = l.l_returnflag JOIN ls ON ls.v = l.l_linestatus JOIN pc ON pc.v = l.pclass),
s AS (SELECT l_orderkey, l_linenumber, label, unnest([0, 1, 2, 3, 4, 5 + pci, 5 + pck + rfi, 5 + pck + rfk + lsi]) AS slot,
             unnest([l_linenumber % 3 + 1, l_quantity, l_linenumber - 1, l_orderkey % 2, l_extendedprice, 1, 1, 1]) AS value FROM b)
SELECT l_orderkey, l_linenumber, label, CAST(slot AS INTEGER) AS slot, CAST(value AS DOUBLE) AS value FROM s WHERE value <> 0"""

CONTINGENCY_SORTED = """WITH s AS (SELECT o_orderdate < TIMESTAMP '1998-01-01 00:00:00' AS base,
  unnest(['o_orderstatus', 'o_orderpriority']) AS "column", unnest([o_orderstatus, o_orderpriority]) AS category FROM orders)
SELECT "column", category, count(*) FILTER (WHERE base) AS n_base, count(*) FILTER (WHERE NOT base) AS n_new,
       row_number() OVER (ORDER BY "column", category) AS place FROM s GROUP BY "column", category"""

MODEL_CHOICE = """SELECT v.model_type, v.stage, CAST(3 + f.n AS INTEGER) AS features
FROM (SELECT count(DISTINCT l_returnflag) + count(DISTINCT l_linestatus) AS n FROM lineitem) f,
     (VALUES ('logreg', 'LogisticRegressionModel'), ('random_forest', 'RandomForestClassificationModel')) v(model_type, stage)"""

SCORE_SEPARABLE = """SELECT CAST(l_quantity > 25 AS INTEGER) AS prediction, count(*) AS rows, count(*) AS right
FROM lineitem GROUP BY 1"""

CSV_MISFITS = """WITH t AS (SELECT event_id, event_id % 13 = 0 AND event_id % 11 <> 0 AS bad_amount, event_id % 7 = 0 AS bad_qty FROM events)
SELECT event_id, CAST(NULL AS VARCHAR) AS "column", CAST(NULL AS VARCHAR) AS text,
       CASE WHEN event_id % 11 <> 0 THEN event_id / 4 END AS amount,
       CAST(CASE WHEN event_id % 17 <> 0 THEN event_id % 5 END AS INTEGER) AS qty FROM t WHERE NOT bad_amount AND NOT bad_qty
UNION ALL SELECT event_id, 'amount', 'oops', NULL, NULL FROM t WHERE bad_amount
UNION ALL SELECT event_id, 'qty', '3.5', NULL, NULL FROM t WHERE bad_qty"""

# The true ranks are counted by the query; here stands that all of them are near enough.
SKETCH_EDGE_RANKS = """SELECT c AS "column", CAST(i AS INTEGER) AS edge_index, n, true AS within
FROM (SELECT count(*) AS n FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01 00:00:00'), range(11) r(i),
     (VALUES ('l_quantity'), ('l_extendedprice'), ('l_discount'), ('l_tax'), ('const_one'), ('flag_r')) v(c)"""

SKETCH_PSI = f"SELECT \"column\", n_base, n_new, status, true AS near FROM ({PSI_NUMERIC})"

AUC_BY = """WITH s AS (SELECT l_returnflag, score_name, score,
  l_quantity + (l_orderkey * 7 + l_linenumber * 13) % 41 - 20 > 25 AS y
  FROM (SELECT *, unnest(['l_quantity', 'l_discount']) AS score_name, unnest([l_quantity, l_discount]) AS score FROM lineitem)),
g AS (SELECT l_returnflag, score_name, score, count(*) FILTER (WHERE y) AS pos, count(*) FILTER (WHERE NOT y) AS neg FROM s GROUP BY ALL),
c AS (SELECT *, sum(neg) OVER (PARTITION BY l_returnflag, score_name ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - neg AS below FROM g)
SELECT l_returnflag, score_name, round(sum(CAST(pos AS DOUBLE) * (CAST(below AS DOUBLE) + CAST(neg AS DOUBLE) / 2.0))
             / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 6) AS auc,
       CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives
FROM c GROUP BY l_returnflag, score_name"""

CONFUSION_OTHER = """WITH s AS (SELECT l_quantity AS q,
  CAST(l_quantity + (l_orderkey * 7 + l_linenumber * 13) % 41 - 20 > 25 AS DOUBLE) AS label FROM lineitem)
SELECT label, count(*) FILTER (WHERE q > 5 AND q <= 25) AS pred_0, count(*) FILTER (WHERE q > 25 AND q <= 40) AS pred_1,
       count(*) FILTER (WHERE q > 40 OR q <= 5) AS pred_other FROM s GROUP BY label"""

FOREST_LAYOUTS = "SELECT CAST(3 AS INTEGER) AS layouts, CAST(0.0 AS DOUBLE) AS max_difference"

SCORE_QUARANTINE = """WITH t AS (SELECT l_orderkey % 7 = 0 AS q, l_orderkey % 11 = 0 AS x FROM lineitem)
SELECT 'scored' AS what, count(*) FILTER (WHERE NOT q AND NOT x) AS rows FROM t
UNION ALL SELECT 'set aside', count(*) FILTER (WHERE q OR x) FROM t
UNION ALL SELECT 'l_quantity', count(*) FILTER (WHERE q) FROM t
UNION ALL SELECT 'l_tax', count(*) FILTER (WHERE x) FROM t"""

MODEL_BY_EPOCH = """SELECT l_orderkey % 3 AS epoch, l_orderkey % 3 + 1 AS model_version, count(*) AS rows
FROM lineitem GROUP BY ALL"""

RETRAIN_COMMITTED = f"""SELECT count(*) AS scored, CAST(1 AS BIGINT) AS runs, count(*) AS dataset_rows,
       CAST(1 AS BIGINT) AS version, true AS same, d.drift, true AS retrained
FROM lineitem, ({RETRAIN_DECISION}) d GROUP BY d.drift"""

ORACLE_SQL = {
    "training_layout": TRAINING_LAYOUT,
    "contingency_sorted": CONTINGENCY_SORTED,
    "model_choice": MODEL_CHOICE,
    "score_separable": SCORE_SEPARABLE,
    "windows_open": OPEN_WINDOWS,
    "drift_by_window_mismatch": DRIFT_BY_WINDOW_MISMATCH,
    "csv_misfits": CSV_MISFITS,
    "sketch_edge_ranks": SKETCH_EDGE_RANKS,
    "sketch_psi": SKETCH_PSI,
    "auc_by": AUC_BY,
    "confusion_other": CONFUSION_OTHER,
    "forest_layouts": FOREST_LAYOUTS,
    "score_quarantine": SCORE_QUARANTINE,
    "model_by_epoch": MODEL_BY_EPOCH,
    "retrain_committed": RETRAIN_COMMITTED,
    "psi_numeric": PSI_NUMERIC,
    "bin_edges": BIN_EDGES,
    "histogram": HISTOGRAM,
    "chi_square_categorical": CHI_SQUARE_CATEGORICAL,
    "drift_report": DRIFT_REPORT,
    "drift_any": DRIFT_ANY,
    "drift_report_mismatch": DRIFT_REPORT_MISMATCH,
    "drift_by_window": DRIFT_BY_WINDOW,
    "chi_square_by_window": CHI_SQUARE_BY_WINDOW,
    "report_by_window": REPORT_BY_WINDOW,
    "drift_by_window_nulls": DRIFT_BY_WINDOW_NULLS,
    "drift_report_file": DRIFT_REPORT_FILE,
    "score_stream_vs_batch": SCORE_STREAM_VS_BATCH,
    "train_logreg_moments": TRAIN_LOGREG_MOMENTS,
    "retrain_job": RETRAIN_JOB,
    "prep_fill_constant": PREP_FILL_CONSTANT,
    "baseline_median_unknown": BASELINE_MEDIAN_UNKNOWN,
    "baseline_csv": BASELINE_MEDIAN_UNKNOWN,
    "parquet_roundtrip": CUSTOMER,
    "csv_roundtrip": CUSTOMER,
    "na_tokens_cast": NA_TOKENS_CAST,
    "category_index": CATEGORY_INDEX,
    "one_hot": ONE_HOT,
    "assembled": ASSEMBLED,
    "family_features": FAMILY_FEATURES,
    "hash_split": HASH_SPLIT,
    "accuracy": ACCURACY,
    "auc_exact": AUC_EXACT,
    "confusion": CONFUSION,
    "retrain_decision": RETRAIN_DECISION,
    "run_series": RUN_SERIES,
}
