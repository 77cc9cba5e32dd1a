"""The detector in SQL, built from the long survey table."""

from __future__ import annotations

from tidemark.registry.standins import LONG


def detector(source: str, metric: str, total_metric: str, min_size: int = 2, contamination: float = 0.05) -> str:
    """CTEs `base`, `series`, `depths` and `scored` over `source(day, nps, segment, grp)` and `survey(day, nps)`."""
    key = "segment, grp"
    w = f"PARTITION BY {key} ORDER BY day"
    ahead = "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
    roll = f"OVER ({w} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
    return f"""base0 AS (SELECT day, {total_metric} AS metric, count(*) AS total_count FROM survey GROUP BY day),
base1 AS (SELECT *, metric - lag(metric) OVER (ORDER BY day) AS d FROM base0),
base AS (SELECT day, metric, total_count, first_value(d IGNORE NULLS) OVER (ORDER BY day {ahead}) AS delta_all FROM base1),
g0 AS (SELECT segment, grp, day, {metric} AS metric, count(*) AS n_rows, count(nps) AS n_values
  FROM {source} WHERE grp IS NOT NULL GROUP BY segment, grp, day),
g1 AS (SELECT *, sum(n_rows) OVER (PARTITION BY {key}) AS size, metric - lag(metric) OVER ({w}) AS d FROM g0),
g2 AS (SELECT *, first_value(d IGNORE NULLS) OVER ({w} {ahead}) AS delta,
    avg(metric) {roll} AS rm, stddev_samp(metric) {roll} AS rs FROM g1 WHERE size >= {min_size}),
series AS (SELECT *, (delta - rm) / (rs + 1e-6) AS z_score, round(delta, 9) AS x FROM g2),
points AS (SELECT DISTINCT {key}, x FROM series WHERE x IS NOT NULL),
gaps AS (SELECT {key}, x AS lo, lead(x) OVER (PARTITION BY {key} ORDER BY x) AS hi FROM points),
depths AS (SELECT p.segment, p.grp, p.x, round(coalesce(sum((g.hi - g.lo) / CASE WHEN g.lo >= p.x THEN g.hi - p.x ELSE p.x - g.lo END), 0), 9) AS depth
  FROM points p LEFT JOIN gaps g ON p.segment = g.segment AND p.grp = g.grp AND g.hi IS NOT NULL GROUP BY p.segment, p.grp, p.x),
deep AS (SELECT s.*, e.depth FROM series s LEFT JOIN depths e ON s.segment = e.segment AND s.grp = e.grp AND s.x = e.x),
limits AS (SELECT {key}, quantile_cont(depth, {contamination}) AS lim FROM deep WHERE depth IS NOT NULL GROUP BY {key}),
scored AS (SELECT e.*, coalesce(e.depth < l.lim, false) AS ml_anomaly,
    CASE WHEN abs(b.delta_all) <= 1e-8 THEN 0
      ELSE greatest(-1.0, least(1.0, e.delta * (e.n_values / b.total_count) / b.delta_all)) END AS contribution
  FROM deep e JOIN base b ON e.day = b.day LEFT JOIN limits l ON e.segment = l.segment AND e.grp = l.grp)"""


DETECTOR = f"{LONG}, {detector('long', 'avg(nps)', 'avg(nps)')}"

_RANK = "ORDER BY round(abs(contribution), 9) DESC, grp"
WINNERS = f"""ml AS (SELECT day, segment, grp FROM (SELECT *, row_number() OVER (PARTITION BY day, segment {_RANK}) AS k
    FROM scored WHERE ml_anomaly AND contribution IS NOT NULL) WHERE k = 1),
zs AS (SELECT day, segment, grp FROM (SELECT *, row_number() OVER (PARTITION BY day, segment {_RANK}) AS k
    FROM scored WHERE abs(z_score) > 3 AND contribution IS NOT NULL) WHERE k = 1),
winners AS (SELECT d.day, d.segment, ml.grp AS ml_group, zs.grp AS z_group
  FROM (SELECT DISTINCT day, segment FROM scored) d
  LEFT JOIN ml ON d.day = ml.day AND d.segment = ml.segment LEFT JOIN zs ON d.day = zs.day AND d.segment = zs.segment)"""
