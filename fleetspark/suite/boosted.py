"""SQL that trains the boosted models again, from their definition, for judging the engine's.

One recursive query grows all trees of all models of a set at once: each step either splits the
nodes of one level for every model, or closes a tree and moves the scores. All sums are of whole
numbers (see ``plans.trees``), so both sides meet the same trees.
"""

from __future__ import annotations

from dataclasses import dataclass

from fleetspark.plans.features import MACHINE_COLUMNS, sensor_feature_names
from fleetspark.plans.trees import SCALE, Setting
from fleetspark.suite.blocks import COMPS, ERRORS, P, U, W
from fleetspark.suite.registry import block

FEATURES = [
    *sensor_feature_names(P),
    *[f"{e}_count_{W}{U}" for e in ERRORS],
    f"errors_total_{W}{U}",
    *[f"hours_since_{c}_replaced" for c in COMPS],
    *[c for c in MACHINE_COLUMNS if c not in P.exclude_features],
]


@dataclass(frozen=True)
class Judged:
    """A model: its label column and setting."""

    label: str
    setting: Setting


def boosted_blocks(name: str, learn: str, other: str, models: dict[str, Judged], chosen: str = "true", source: str = "parts_e") -> None:
    """Block ``scores_<name>``: (m, machine_id, timestamp, score) of the rows of part ``other``, learned from ``learn``.

    ``m`` is the place of a model in ``models``; only models with ``chosen`` (a condition on ``m``) are trained. ``source`` has the columns of ``parts_e`` and the labels.
    """
    one = next(iter(models.values())).setting
    deepest = max(j.setting.depth for j in models.values())
    penalty = repr(one.l2 * SCALE)
    code = "CASE WHEN model IS NOT NULL THEN (SELECT count(DISTINCT model) FROM parts_e AS o WHERE o.model <= parts_e.model) END"
    inputs = ", ".join(f"CAST({code if f == 'model' else f} AS DOUBLE)" for f in FEATURES)
    block(
        f"rows_{name}",
        f"SELECT row_number() OVER () AS r, part = '{learn}' AS learn, * FROM {source} WHERE part IN ('{learn}', '{other}')",
    )
    block(
        f"cells_{name}",
        f"SELECT r, learn, unnest(range({len(FEATURES)})) AS f, unnest([{inputs.replace('parts_e.model', f'rows_{name}.model')}]) AS v FROM rows_{name}",
    )
    block(
        f"cuts_{name}",
        f"""SELECT f, list(DISTINCT v) AS cuts FROM (
  SELECT f, v, row_number() OVER (PARTITION BY f ORDER BY v) - 1 AS i, count(*) OVER (PARTITION BY f) AS n
  FROM cells_{name} WHERE learn AND v IS NOT NULL) JOIN range(1, {one.bins}) AS k(k) ON i = k * n // {one.bins} GROUP BY f""",
    )
    block(
        f"bins_{name}",
        f"""SELECT r, f, CASE WHEN v IS NULL THEN 0 ELSE 1 + len(list_filter(coalesce(cuts, []), lambda x: x < v)) END AS b
FROM cells_{name} LEFT JOIN cuts_{name} USING (f)""",
    )
    rows = "\nUNION ALL ".join(
        f"SELECT {m} AS m, r, learn, CAST({j.label} AS BIGINT) AS y, {j.setting.depth} AS depth, {-j.setting.rate * SCALE!r}::DOUBLE AS step_size FROM rows_{name}"
        for m, j in enumerate(models.values())
    )
    block(f"taught_{name}", f"SELECT * FROM ({rows}) WHERE {chosen}")
    total = one.rounds * (deepest + 1)
    level = f"(step % {deepest + 1})"
    block(
        f"grown_{name}",
        f"""SELECT 0 AS step, m, r, learn, y, depth, step_size, 1 AS node,
  CAST(floor(ln((2 * sum(y) FILTER (WHERE learn) OVER w + 1)::DOUBLE / (2 * sum(1 - y) FILTER (WHERE learn) OVER w + 1)) * {SCALE} + 0.5) AS BIGINT) AS score
FROM taught_{name} WINDOW w AS (PARTITION BY m)
UNION ALL
(WITH chances AS (
  SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + exp(-score / {float(SCALE)}::DOUBLE)) AS p FROM grown_{name} WHERE step < {total}),
slopes AS (
  SELECT *, CAST(floor((p - y) * {float(SCALE)}::DOUBLE + 0.5) AS BIGINT) AS g, CAST(floor(p * (1 - p) * {float(SCALE)}::DOUBLE + 0.5) AS BIGINT) AS h FROM chances),
cells AS (
  SELECT m, node, f, b, sum(g)::BIGINT AS g, sum(h)::BIGINT AS h, count(*) AS n FROM slopes JOIN bins_{name} USING (r)
  WHERE learn AND {level} < depth AND node >= (1 << {level}) GROUP BY ALL),
sides AS (
  SELECT m, node, f, b, sum(g) OVER l AS gl, sum(h) OVER l AS hl, sum(n) OVER l AS nl, sum(g) OVER a AS ga, sum(h) OVER a AS ha, sum(n) OVER a AS na
  FROM cells WINDOW l AS (PARTITION BY m, node, f ORDER BY b), a AS (PARTITION BY m, node, f)),
gains AS (
  SELECT m, node, f, b, gl::DOUBLE * gl::DOUBLE / (hl::DOUBLE + {penalty}) + (ga - gl)::DOUBLE * (ga - gl)::DOUBLE / ((ha - hl)::DOUBLE + {penalty})
    - ga::DOUBLE * ga::DOUBLE / (ha::DOUBLE + {penalty}) AS gain FROM sides WHERE nl >= {one.least} AND na - nl >= {one.least}),
splits AS (SELECT m, node, f, b FROM gains WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY m, node ORDER BY gain DESC, f, b) = 1),
leaves AS (
  SELECT m, node, CAST(floor(step_size * sum(g)::DOUBLE / (sum(h)::DOUBLE + {penalty}) + 0.5) AS BIGINT) AS gain
  FROM slopes WHERE learn AND {level} = {deepest} GROUP BY m, node, step_size)
SELECT s.step + 1, s.m, s.r, s.learn, s.y, s.depth, s.step_size,
  CASE WHEN s.{level[1:-1].replace('step', 'step', 1)} = {deepest} THEN 1 WHEN t.f IS NOT NULL THEN 2 * s.node + CAST(c.b > t.b AS INTEGER) ELSE s.node END,
  s.score + coalesce(v.gain, 0)
FROM slopes AS s LEFT JOIN splits AS t ON t.m = s.m AND t.node = s.node LEFT JOIN bins_{name} AS c ON c.r = s.r AND c.f = t.f
LEFT JOIN leaves AS v ON v.m = s.m AND v.node = s.node)""",
        recursive=True,
    )
    block(
        f"scores_{name}",
        f"""SELECT m, machine_id, timestamp, 1.0::DOUBLE / (1.0::DOUBLE + exp(-score / {float(SCALE)}::DOUBLE)) AS score
FROM grown_{name} JOIN rows_{name} USING (r) WHERE step = {total} AND part = '{other}'""",
    )
