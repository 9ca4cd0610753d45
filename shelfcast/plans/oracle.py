"""Independent DuckDB SQL for every exactly checkable query.

The base CTEs rebuild the panel view from the raw tables in plain SQL (grid
by cross join, fills by window functions), independently of the Spark
operators, so that the comparison checks the operators, not a copy of them.
Conventions: doubles that are not sums of integers are rounded to 6 places
on both sides; DuckDB ``isodow`` is 1..7, so weekday (Monday = 0) is
``isodow - 1``.
"""

from __future__ import annotations

import re

BASE = """
fact AS MATERIALIZED (
  SELECT CAST(s.s_nationkey AS INTEGER) AS store_nbr, p.p_type AS family,
         CAST(l.l_shipdate AS DATE) AS date, SUM(l.l_quantity) AS sales,
         CAST(COUNT(*) FILTER (WHERE l.l_discount >= CAST(0.09 AS DOUBLE)) AS INTEGER) AS onpromotion
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  GROUP BY 1, 2, 3),
bounds AS (
  SELECT (SELECT MIN(CAST(l_shipdate AS DATE)) FROM lineitem) AS d0,
         (SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders) AS train_end),
days AS (
  SELECT CAST(b.d0 + CAST(t.i AS INTEGER) AS DATE) AS date
  FROM bounds b, LATERAL generate_series(0, (b.train_end - b.d0) + 16) AS t(i)),
series AS (SELECT DISTINCT store_nbr, family FROM fact, bounds WHERE date <= train_end + 16),
panel AS MATERIALIZED (
  SELECT s.store_nbr, s.family, d.date,
         CASE WHEN d.date <= b.train_end THEN COALESCE(f.sales, CAST(0 AS DOUBLE)) END AS sales,
         COALESCE(f.onpromotion, 0) AS onpromotion
  FROM series s CROSS JOIN days d CROSS JOIN bounds b
  LEFT JOIN fact f ON f.store_nbr = s.store_nbr AND f.family = s.family AND f.date = d.date),
train AS (SELECT p.* FROM panel p, bounds b WHERE p.date <= b.train_end),
families AS (
  SELECT family, CAST(DENSE_RANK() OVER (ORDER BY family) - 1 AS BIGINT) AS family_code
  FROM (SELECT DISTINCT family FROM fact)),
stores AS (
  SELECT CAST(n.n_nationkey AS INTEGER) AS store_nbr, n.n_name AS city, r.r_name AS state,
         substr('ABCDE', CAST(floor(n.n_nationkey / 5) AS INTEGER) + 1, 1) AS store_type,
         CAST(n.n_regionkey AS INTEGER) AS cluster
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
transactions AS (
  SELECT CAST(o.o_orderdate AS DATE) AS date, CAST(c.c_nationkey AS INTEGER) AS store_nbr,
         CAST(COUNT(*) AS BIGINT) AS transactions
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2),
oil AS (
  SELECT CAST(o_orderdate AS DATE) AS date,
         CASE WHEN isodow(CAST(o_orderdate AS DATE)) <= 5 THEN MAX(o_totalprice) END AS dcoilwtico
  FROM orders GROUP BY 1),
years AS (
  SELECT CAST(y AS INTEGER) AS year FROM bounds b,
  LATERAL generate_series(year(b.d0), year(b.train_end + 16)) AS t(y)),
nat_rules(rule, type, month, day, transferred, description) AS (VALUES
  (0, 'Holiday', 1, 1, false, 'Primer dia del ano'),
  (1, 'Bridge', 12, 24, false, 'Puente Navidad'),
  (2, 'Holiday', 12, 25, false, 'Navidad'),
  (3, 'Additional', 12, 26, false, 'Navidad+1'),
  (4, 'Work Day', 12, 29, false, 'Recupero puente Navidad'),
  (5, 'Holiday', 8, 10, true, 'Primer Grito de Independencia'),
  (6, 'Transfer', 8, 11, false, 'Traslado Primer Grito de Independencia'),
  (7, 'Event', 5, 14, false, 'Dia de la Madre')),
holidays AS (
  SELECT make_date(y.year, r.month, r.day) AS date, r.type, 'National' AS locale,
         'Ecuador' AS locale_name, r.description, r.transferred, CAST(r.rule AS BIGINT) AS h_seq
  FROM years y CROSS JOIN nat_rules r
  UNION ALL
  SELECT make_date(y.year, g.r_regionkey + 3, 10), 'Holiday', 'Regional', g.r_name,
         'Fundacion de ' || g.r_name, false, CAST(g.r_regionkey + 100 AS BIGINT)
  FROM years y CROSS JOIN region g
  UNION ALL
  SELECT make_date(y.year, (n.n_nationkey % 12) + 1, n.n_nationkey + 1), 'Holiday', 'Local',
         n.n_name, 'Fiesta de ' || n.n_name, false, CAST(n.n_nationkey + 200 AS BIGINT)
  FROM years y CROSS JOIN nation n),
cal AS (SELECT date FROM days),
oil_cal AS (
  SELECT c.date, o.dcoilwtico FROM cal c LEFT JOIN oil o ON o.date = c.date),
oil_dense AS (
  SELECT date, COALESCE(
           last_value(dcoilwtico IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           first_value(dcoilwtico IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
         ) AS dcoilwtico
  FROM oil_cal),
oil_file_filled AS (
  SELECT date, COALESCE(
           last_value(dcoilwtico IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           first_value(dcoilwtico IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
         ) AS dcoilwtico
  FROM oil)
"""


def _decimal_rounding(text: str) -> str:
    """Rewrite ``ROUND(x, 6)`` to round the decimal value half away from zero.

    DuckDB rounds a double by scaling it in floating point, so exact ties such
    as 1.0171875 come out as 1.017187; Spark rounds the decimal value
    (1.017188). Casting to DECIMAL first gives Spark's rounding.
    """
    out, i, key = [], 0, "ROUND("
    while True:
        j = text.find(key, i)
        if j < 0:
            out.append(text[i:])
            return "".join(out)
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(text[k], 0)
            k += 1
        inner = text[j + len(key):k - 1]
        arg, sep, digits = inner.rpartition(",")
        if sep and digits.strip() == "6":
            arg = _decimal_rounding(arg)
            out.append(text[i:j] + f"CAST(ROUND(CAST(({arg}) AS DECIMAL(38,12)), 6) AS DOUBLE)")
        else:
            out.append(text[i:k])
        i = k


def _evaluated_once(text: str) -> str:
    """Every CTE is evaluated once, whatever the optimiser estimates: inlined
    into several joins, a statistic would be planned anew in each of them."""
    return re.sub(r"(?<=\w) AS \((?=\s*(?:SELECT|WITH)\b)", " AS MATERIALIZED (", text)


def sql(body: str) -> str:
    """Prefix a query body with the base CTEs (the body may add its own
    CTEs after a leading comma: ``sql(", x AS (...) SELECT ...")``)."""
    body = _decimal_rounding(body.strip())
    return _evaluated_once("WITH " + BASE.strip() + ("" if body.startswith(",") else "\n") + body)


def sub(body: str) -> str:
    """A query body (as passed to ``sql``) as a parenthesised subquery that can
    be joined inside another oracle query (the base CTEs stay at the top)."""
    body = _decimal_rounding(body.strip())
    if body.startswith(","):
        body = "WITH " + body[1:].lstrip()
    return "(" + body + ")"
