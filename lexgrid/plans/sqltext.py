"""Helpers that write the DuckDB twin of a registered query."""

from __future__ import annotations

from collections.abc import Sequence


def sql_str(s: str) -> str:
    """A DuckDB string literal; newlines become ``chr(10)`` so no escape syntax is needed."""
    parts = s.replace("'", "''").split("\n")
    quoted = [f"'{p}'" for p in parts]
    return " || chr(10) || ".join(quoted) if len(quoted) > 1 else quoted[0]


def macro_report_sql(source: str, y: str, p: str, by: Sequence[str] = ()) -> str:
    """SQL twin of ``operators.metrics.macro_report`` over a subquery ``source``."""
    g = list(by)
    gsel = "".join(f"{c}, " for c in g)
    gby = ", ".join(g)
    group = f"GROUP BY {gby}" if g else ""
    join = f"JOIN acc USING ({gby})" if g else "CROSS JOIN acc"
    return f"""
WITH src AS ({source}),
conf AS (SELECT {gsel}{y} AS y, {p} AS p, count(*) AS n FROM src GROUP BY {gsel}{y}, {p}),
cells AS (
  SELECT {gsel}y AS cls, CASE WHEN y = p THEN n ELSE 0 END AS tp, n AS t, 0 AS pr FROM conf
  UNION ALL
  SELECT {gsel}p AS cls, 0 AS tp, 0 AS t, n AS pr FROM conf),
per AS (SELECT {gsel}cls, sum(tp) AS tp, sum(t) AS t, sum(pr) AS pr
        FROM cells WHERE cls IS NOT NULL GROUP BY {gsel}cls),
cm AS (SELECT {gsel}
          CASE WHEN pr > 0 THEN tp / pr ELSE 0.0 END AS pc,
          CASE WHEN t > 0 THEN tp / t ELSE 0.0 END AS rc,
          CASE WHEN pr + t > 0 THEN 2 * tp / (pr + t) ELSE 0.0 END AS fc
       FROM per),
macro AS (SELECT {gsel}avg(pc) AS mp, avg(rc) AS mr, avg(fc) AS mf FROM cm {group}),
acc AS (SELECT {gsel}sum(CASE WHEN y = p THEN n ELSE 0 END) / sum(n) AS a,
               CAST(sum(n) AS BIGINT) AS rows FROM conf {group})
SELECT {gsel}round(mp, 6) AS precision, round(mr, 6) AS recall, round(mf, 6) AS f1,
       round(a, 6) AS accuracy, rows
FROM macro {join}
"""


def argmax_sql(lst: str) -> str:
    return f"CAST(list_position({lst}, list_max({lst})) - 1 AS INTEGER)"


def length_logits_sql(text: str) -> str:
    return (f"[CAST(length({text}) % 7 AS DOUBLE), CAST(length({text}) % 5 AS DOUBLE), "
            f"CAST(length({text}) % 3 AS DOUBLE)]")


def hash_sql(key: str, seed: int = 42) -> str:
    return f"md5('{seed}:' || CAST({key} AS VARCHAR))"


def ids_str_sql(lst: str, sep: str = " ") -> str:
    return f"array_to_string(list_transform({lst}, lambda x: CAST(x AS VARCHAR)), '{sep}')"
