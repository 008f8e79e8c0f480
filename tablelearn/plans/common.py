"""Helpers shared by the registered queries and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 6
#: Width of the embeddings table.
WIDE = 64


def rnd(c: Column | str, digits: int = DIGITS) -> Column:
    """Round a float output so engines that sum in another order agree.

    ``+ 0.0`` turns a rounded ``-0.0`` into ``0.0``.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, digits) + F.lit(0.0)


def sql_rnd(expr: str, digits: int = DIGITS) -> str:
    return f"(round(({expr}), {digits}) + 0.0)"


def sql_emb(p: int, name: str = "emb") -> str:
    """SQL form of the emb_d{p} feature view (DuckDB lists are 1-based)."""
    cols = ", ".join(f"embedding[{i + 1}]::DOUBLE AS x{i + 1}" for i in range(p))
    return f"{name} AS (SELECT vec_id, {cols}, label FROM embeddings)"


def xs(p: int, prefix: str = "x") -> list[str]:
    return [f"{prefix}{i + 1}" for i in range(p)]


def sql_inverse(name: str, cells: str, p: int, key: str = "grp") -> list[str]:
    """CTEs (of a WITH RECURSIVE) inverting the positive definite matrices in ``cells`` ({key},
    i, j, v; 0-based) by Gauss-Jordan steps: {name}({key}, i, j, v) and {name}_det({key}, logdet)."""
    return [f"""{name}_gj AS (
        SELECT 0 AS step, {key}, i, j, v, NULL::DOUBLE AS piv FROM {cells}
        UNION ALL SELECT 0, {key}, i, i + {p}, 1.0::DOUBLE, NULL FROM {cells} WHERE i = j
        UNION ALL SELECT 0, a.{key}, a.i, b.i + {p}, 0.0::DOUBLE, NULL FROM {cells} a JOIN {cells} b
            ON a.{key} = b.{key} AND a.i <> b.i AND a.i = a.j AND b.i = b.j
        )""", f"""{name}_run AS (
        SELECT * FROM {name}_gj
        UNION ALL
        SELECT t.step + 1, t.{key}, t.i, t.j, CASE WHEN t.i = t.step THEN t.v / d.v ELSE t.v - c.v * r.v / d.v END, d.v
        FROM {name}_run t
        JOIN {name}_run d ON d.{key} = t.{key} AND d.i = t.step AND d.j = t.step
        JOIN {name}_run r ON r.{key} = t.{key} AND r.i = t.step AND r.j = t.j
        JOIN {name}_run c ON c.{key} = t.{key} AND c.i = t.i AND c.j = t.step
        WHERE t.step < {p})""",
            f"{name} AS (SELECT {key}, i, j - {p} AS j, v FROM {name}_run WHERE step = {p} AND j >= {p})",
            f"{name}_det AS (SELECT {key}, sum(ln(piv)) AS logdet FROM {name}_run WHERE i = 0 AND j = 0 AND step > 0 GROUP BY {key})"]
