"""DuckDB SQL for the fixture views and shared CTEs of the oracle checks.

These strings are the independent statement of each registered query's
result, run by the correctness gate on the same parquet tables.
"""

from __future__ import annotations

from math import exp, factorial

# Fixed values, stated here and not taken from the code under test: the normal quantile of a
# two-sided 95 % interval, edges of equal bins, cumulative Poisson(1) probabilities.
Z_95 = 1.959963984540054


def linspace_edges(n_bins: int) -> list[float]:
    return [1.0 if i == n_bins else i * (1.0 / n_bins) for i in range(n_bins + 1)]


def poisson_cut_points(largest: int = 16) -> list[float]:
    return [sum(exp(-1.0) / factorial(j) for j in range(k + 1)) for k in range(largest + 1)]


# Python's Unicode whitespace for DuckDB's RE2 (its \s lacks \v and U+001C-1F).
WS_DUCK = (r"[\s\x0b\x1c-\x1f\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}"
           r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+")


def dbl(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def collapse(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '{WS_DUCK}', ' ', 'g'))"


def normalized(expr: str) -> str:
    return f"lower({collapse(expr)})"


def narratives(label: str = "lang") -> str:
    return f"""SELECT lpad(CAST(doc_id AS VARCHAR), 12, '0') AS complaint_id,
        CAST(DATE '2024-01-01' + CAST(doc_id % 91 AS INTEGER) AS DATE) AS date_received,
        source AS issue, {label} AS label, text
      FROM documents"""


ORDERS_CLS = """SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS complaint_id,
        CAST(o_orderdate AS DATE) AS date_received, o_orderstatus AS issue,
        o_orderpriority AS label
      FROM orders"""

SCORED_LINES = """SELECT id, label_id, pred_b, split,
        [CASE WHEN pc = 0 THEN m ELSE 0.0::DOUBLE END,
         CASE WHEN pc = 1 THEN m ELSE 0.0::DOUBLE END,
         CASE WHEN pc = 2 THEN m ELSE 0.0::DOUBLE END] AS logits
      FROM (
        SELECT id, label_id,
          CASE WHEN u < 0.55::DOUBLE + 0.43::DOUBLE * v THEN label_id ELSE (label_id + 1) % 3 END AS pc,
          CAST(CASE WHEN u < 0.60::DOUBLE + 0.40::DOUBLE * v THEN label_id ELSE (label_id + 1) % 3 END AS INTEGER) AS pred_b,
          0.2::DOUBLE + 3.0::DOUBLE * v AS m,
          CASE WHEN substr(id, 1, 2) < '80' THEN 'calibration' ELSE 'test' END AS split
        FROM (
          SELECT md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                   CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
                   CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR),
                   strftime(l_shipdate, '%Y-%m-%d'))) AS id,
            CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS INTEGER) AS label_id,
            CAST((l_orderkey * 31 + l_partkey * 17 + l_suppkey * 7 + l_linenumber * 3) % 1000 AS DOUBLE) / 1000 AS u,
            CAST((l_partkey * 13 + l_orderkey * 101 + l_linenumber * 37) % 1000 AS DOUBLE) / 1000 AS v
          FROM lineitem))"""


def scored(temperature: float | str, source: str = "sl") -> str:
    """Temperature softmax over the 3-logit fixture, written out per class.
    The temperature is a number or a SQL expression."""
    t = temperature if isinstance(temperature, str) else dbl(temperature)
    return f"""SELECT *, round(greatest(p0, p1, p2), 12) AS confidence,
          CAST(CASE WHEN p0 = greatest(p0, p1, p2) THEN 0
               WHEN p1 = greatest(p0, p1, p2) THEN 1 ELSE 2 END AS INTEGER) AS pred_id,
          coalesce(CASE WHEN p0 = greatest(p0, p1, p2) THEN 0
               WHEN p1 = greatest(p0, p1, p2) THEN 1 ELSE 2 END = label_id, false) AS correct
      FROM (SELECT *, e0 / (e0 + e1 + e2) AS p0, e1 / (e0 + e1 + e2) AS p1, e2 / (e0 + e1 + e2) AS p2
        FROM (SELECT *, exp(x0 - greatest(x0, x1, x2)) AS e0, exp(x1 - greatest(x0, x1, x2)) AS e1,
                 exp(x2 - greatest(x0, x1, x2)) AS e2
          FROM (SELECT *, logits[1] / {t} AS x0, logits[2] / {t} AS x1, logits[3] / {t} AS x2
                FROM {source})))"""


def bin_case(conf: str, n_bins: int) -> str:
    edges = linspace_edges(n_bins)
    parts = [f"WHEN {conf} IS NULL OR isnan({conf}) OR {conf} < {dbl(edges[0])} THEN NULL"]
    for i in range(n_bins):
        parts.append(f"WHEN {conf} <= {dbl(edges[i + 1])} THEN {i}")
    return "CAST(CASE " + " ".join(parts) + " ELSE NULL END AS INTEGER)"


def bin_centre_case(bin_expr: str, n_bins: int) -> str:
    edges = linspace_edges(n_bins)
    parts = [f"WHEN {bin_expr} = {i} THEN {dbl((edges[i] + edges[i + 1]) / 2)}"
             for i in range(n_bins)]
    return "CASE " + " ".join(parts) + " END"


def wilson_sql(k: str, n: str) -> tuple[str, str]:
    z = dbl(Z_95)
    p = f"(CAST({k} AS DOUBLE) / {n})"
    denom = f"(1.0::DOUBLE + {z} * {z} / {n})"
    center = f"(({p} + {z} * {z} / (2.0::DOUBLE * {n})) / {denom})"
    margin = (f"({z} * sqrt({p} * (1.0::DOUBLE - {p}) / {n} + {z} * {z} / (4.0::DOUBLE * {n} * {n}))"
              f" / {denom})")
    return f"greatest(0.0::DOUBLE, {center} - {margin})", f"least(1.0::DOUBLE, {center} + {margin})"


def poisson_case(u: str) -> str:
    cuts = poisson_cut_points()
    parts = [f"WHEN {u} < {dbl(c)} THEN {k}" for k, c in enumerate(cuts)]
    return "CASE " + " ".join(parts) + f" ELSE {len(cuts)} END"
