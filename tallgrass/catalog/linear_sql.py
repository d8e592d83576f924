"""SQL text for small linear-algebra steps on matrices kept as (i, j, v) tables."""

from __future__ import annotations


def gauss_jordan(start: str, size: int, prefix: str = "g") -> str:
    """CTEs that reduce the first ``size`` columns of ``start`` to the identity: prefix0 .. prefix{size}."""
    steps = [f"{prefix}0 AS (SELECT i, j, v FROM {start})"]
    for k in range(size):
        now = f"{prefix}{k}"
        steps.append(
            f"{prefix}{k + 1} AS (SELECT a.i, a.j, CASE WHEN a.i = {k} THEN a.v / p.v ELSE a.v - c.v * r.v / p.v END AS v "
            f"FROM {now} a JOIN {now} r ON r.i = {k} AND r.j = a.j JOIN {now} c ON c.i = a.i AND c.j = {k} "
            f"JOIN {now} p ON p.i = {k} AND p.j = {k})"
        )
    return ",\n".join(steps)


def leading_vector(matrix: str, squarings: int, prefix: str) -> str:
    """CTEs ending in ``{prefix}v`` (i, x): the unit vector a symmetric matrix stretches most.

    The matrix is squared again and again; its column of the largest diagonal entry then points
    that way.  The sign is set so that the largest component is positive.
    """
    steps = [f"{prefix}0 AS (SELECT i, j, v / (SELECT sum(v) FROM {matrix} WHERE i = j) AS v FROM {matrix})"]
    for k in range(squarings):
        steps.append(f"{prefix}s{k} AS (SELECT a.i, b.j, sum(a.v * b.v) AS v FROM {prefix}{k} a JOIN {prefix}{k} b ON a.j = b.i GROUP BY ALL)")
        steps.append(f"{prefix}{k + 1} AS (SELECT i, j, v / (SELECT sum(v) FROM {prefix}s{k} WHERE i = j) AS v FROM {prefix}s{k})")
    last = f"{prefix}{squarings}"
    steps.append(
        f"{prefix}c AS (SELECT i, v FROM {last} WHERE j = (SELECT i FROM {last} WHERE i = j ORDER BY v DESC LIMIT 1))"
    )
    steps.append(
        f"{prefix}v AS (SELECT i, v / (SELECT sqrt(sum(v * v)) * sign(arg_max(v, abs(v))) FROM {prefix}c) AS x FROM {prefix}c)"
    )
    return ",\n".join(steps)


def two_directions(points: str, squarings: int = 13) -> str:
    """CTEs ending in ``d1v`` and ``d2v``: the first two principal directions of (id, pos, x) rows."""
    return f"""scatter AS (
  SELECT a.pos AS i, b.pos AS j, sum(a.x * b.x) AS v
  FROM (SELECT id, pos, x - avg(x) OVER (PARTITION BY pos) AS x FROM {points}) a
  JOIN (SELECT id, pos, x - avg(x) OVER (PARTITION BY pos) AS x FROM {points}) b ON a.id = b.id GROUP BY ALL),
{leading_vector('scatter', squarings, 'd1')},
stretch AS (SELECT sum(s.v * a.x * b.x) AS l FROM scatter s JOIN d1v a ON a.i = s.i JOIN d1v b ON b.i = s.j),
rest AS (SELECT s.i, s.j, s.v - l * a.x * b.x AS v FROM scatter s JOIN d1v a ON a.i = s.i JOIN d1v b ON b.i = s.j, stretch),
{leading_vector('rest', squarings, 'd2')}"""
