"""SQL for each kind of check: one SELECT per check, written without the package's own checks."""

from __future__ import annotations

ERROR = "n_failed > 0"
ROWS = "count(*)"


def line(name, layer, kind, dimension, source, total, failed, error=ERROR, warn=None) -> str:
    severity = "warn" if warn else "error"
    arms = f"WHEN {error} THEN 'error'" + (f" WHEN {warn} THEN 'warn'" if warn else "")
    return f"""SELECT '{name}' AS "check", '{layer}' AS layer, '{kind}' AS kind, '{dimension}' AS dimension,
  '{severity}' AS severity, n_total, n_failed,
  CASE WHEN n_total > 0 THEN round(n_failed * CAST(100 AS DOUBLE) / n_total, 3) ELSE CAST(0 AS DOUBLE) END
    AS pct_failed,
  CASE {arms} ELSE 'pass' END AS verdict
FROM (SELECT CAST({total} AS BIGINT) AS n_total, CAST({failed} AS BIGINT) AS n_failed FROM {source})"""


def over(n: int) -> dict[str, str]:
    return {"error": f"n_failed > {n}", "warn": "n_failed > 0"}


def share_limit(share: str) -> dict[str, str]:
    return {"error": f"n_failed > n_total * CAST({share} AS DECIMAL(9,6))"}


def not_null(layer, tab, col, instead="NULL", **limit) -> str:
    return line(f"not_null_{tab}_{col}", layer, "not_null", "completeness", tab, ROWS,
                 f"count(*) FILTER ({col} IS NULL AND {instead} IS NULL)", **limit)


def unique(layer, tab, col, failed="count(*) FILTER (n > 1)") -> str:
    groups = f"(SELECT {col}, count(*) AS n FROM {tab} WHERE {col} IS NOT NULL GROUP BY {col})"
    return line(f"unique_{tab}_{col}", layer, "unique", "uniqueness", groups,
                 "coalesce(sum(n), 0)", failed)


def unique_combination(layer, tab, *cols, name=None) -> str:
    groups = f"(SELECT count(*) AS n FROM {tab} GROUP BY {', '.join(cols)})"
    return line(name or f"unique_{tab}_{'_'.join(cols)}", layer, "unique_combination", "uniqueness", groups,
                 "coalesce(sum(n), 0)", "count(*) FILTER (n > 1)")


def accepted(layer, tab, col, allowed) -> str:
    listed = ", ".join(f"'{v}'" for v in allowed)
    return line(f"accepted_values_{tab}_{col}", layer, "accepted_values", "validity", tab, ROWS,
                 f"count(DISTINCT {col}) FILTER ({col} NOT IN ({listed}))")


def told() -> dict[str, str]:
    """Never an error."""
    return {"error": "false", "warn": "n_failed > 0"}


def expression(layer, tab, name, holds, label=None, **limit) -> str:
    return line(label or f"expression_{tab}_{name}", layer, "expression_is_true", "validity", tab, ROWS,
                 f"count(*) FILTER (NOT ({holds}))", **limit)


def relationship(layer, tab, col, parent, parent_col, nulls=False, name=None) -> str:
    scope = "" if nulls else f" WHERE c.{col} IS NOT NULL"
    joined = (
        f"(SELECT p.k FROM {tab} c LEFT JOIN (SELECT DISTINCT {parent_col} AS k FROM {parent}) p"
        f" ON c.{col} = p.k{scope})"
    )
    return line(name or f"relationship_{tab}_{col}", layer, "relationship", "consistency", joined, ROWS,
                 "count(*) FILTER (k IS NULL)")


def between(name, layer, tab, scope, col, low, high, instead="NULL", **limit) -> str:
    return line(name, layer, "value_between", "validity", f"(SELECT * FROM {tab} WHERE {scope})", ROWS,
                 f"count(*) FILTER ({col} < {low} OR {col} > {high} OR {instead} < {low} OR {instead} > {high})",
                 **limit)


def component_sum(layer, tab, key, name, amount, parts, bound, **limit) -> str:
    listed = ", ".join(f"'{v}'" for v in parts)
    pivoted = (
        f"(SELECT sum({amount}) FILTER ({name} IN ({listed})) AS s,"
        f" count(DISTINCT {name}) FILTER ({name} IN ({listed})) AS k FROM {tab} GROUP BY {key})"
    )
    return line(f"component_sum_{tab}_{amount}", layer, "component_sum", "consistency", pivoted,
                 f"count(*) FILTER (k = {len(parts)})",
                 f"count(*) FILTER (k = {len(parts)} AND s > {bound})", **limit)


def ratio(layer, tab, key, name, amount, whole, part, ratio, relative, absolute, **limit) -> str:
    pivoted = (
        f"(SELECT max({amount}) FILTER ({name} = '{whole}') AS a, max({amount}) FILTER ({name} = '{part}') AS b"
        f" FROM {tab} GROUP BY {key})"
    )
    bad = f"abs(a - b * {ratio}) > greatest({relative} * a, {absolute})"
    return line(f"ratio_{tab}_{whole}_{part}", layer, "ratio", "consistency", pivoted,
                 "count(*) FILTER (a IS NOT NULL AND b IS NOT NULL)",
                 f"count(*) FILTER (a IS NOT NULL AND b IS NOT NULL AND {bad})", **limit)


def complete(layer, tab, col, missing, share) -> str:
    return line(f"complete_{tab}_{col}", layer, "complete", "completeness", tab, ROWS,
                 f"count(*) FILTER ({missing})", **share_limit(share))


def union_all(lines: list[str]) -> str:
    return "\nUNION ALL\n".join(lines)
