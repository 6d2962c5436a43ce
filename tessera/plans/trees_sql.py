"""Oracle SQL that grows a classification tree on its own: candidate thresholds at equal strides of
the sorted values, the split of the largest Gini gain (of equal ones the first feature, then the
smallest threshold), level by level, then subtrees of one prediction merged."""

from __future__ import annotations


def grow_sql(rows: str, features: int, classes: int, depth: int, bins: int = 32) -> str:
    """CTEs over ``rows`` (doc_id, pos, x: list); ``tree`` (node, feature, threshold, n, pos, leaf) has the
    nodes of the merged tree."""
    cls = range(classes)
    counts = ", ".join(f"count(*) FILTER (pos = {c}) AS c{c}" for c in cls)
    left = ", ".join(f"sum(c{c}) OVER w AS l{c}" for c in cls)
    every = ", ".join(f"sum(c{c}) OVER a AS t{c}" for c in cls)

    def total(p):
        return "(" + " + ".join(f"{p}{c}" for c in cls) + ")"

    def gini(p, minus=None):
        value = [f"({p}{c} - {minus}{c})" if minus else f"{p}{c}" for c in cls]
        n = "(" + " + ".join(value) + ")::DOUBLE"
        return "(1.0" + "".join(f" - ({v} / {n}) * ({v} / {n})" for v in value) + ")"

    best_class = "CASE " + " ".join(
        f"WHEN c{c} = greatest({', '.join(f'c{k}' for k in cls)}) THEN {c}" for c in cls) + " END"
    parts = [f"""
  xl AS (SELECT doc_id, pos, j, x[j + 1] AS v FROM {rows}, range({features}) r(j)),
  vc AS (SELECT j, v, row_number() OVER (PARTITION BY j ORDER BY v) AS i, count(*)::DOUBLE AS c,
                sum(count(*)) OVER (PARTITION BY j ORDER BY v)::DOUBLE AS upto FROM xl GROUP BY j, v),
  nn AS (SELECT count(*)::DOUBLE / {bins} AS stride FROM {rows}),
  walk AS (
    SELECT vc.j, vc.i, vc.v, vc.upto, stride AS target, NULL::DOUBLE AS threshold, stride FROM vc, nn WHERE vc.i = 1
    UNION ALL
    SELECT j, i, v, upto, CASE WHEN cut THEN target + stride ELSE target END, CASE WHEN cut THEN (was + v) / 2.0 END, stride
    FROM (SELECT vc.j, vc.i, vc.v, vc.upto, w.target, w.stride, w.v AS was, abs(w.upto - w.target) < abs(vc.upto - w.target) AS cut
          FROM walk w JOIN vc ON vc.j = w.j AND vc.i = w.i + 1)),
  few AS (SELECT j, count(*) - 1 <= {bins - 1} AS all_cuts FROM vc GROUP BY j),
  cuts AS (
    SELECT j, threshold, row_number() OVER (PARTITION BY j ORDER BY threshold) - 1 AS s FROM (
      SELECT j, threshold FROM walk JOIN few USING (j) WHERE threshold IS NOT NULL AND NOT all_cuts
      UNION ALL SELECT j, (lag(v) OVER (PARTITION BY j ORDER BY v) + v) / 2.0 FROM vc JOIN few USING (j)
                WHERE all_cuts QUALIFY i > 1)),
  b AS (SELECT doc_id, pos, j, (SELECT count(*) FROM cuts WHERE cuts.j = xl.j AND cuts.threshold < xl.v) AS bin FROM xl),
  a0 AS (SELECT DISTINCT doc_id, pos, 1::BIGINT AS node FROM xl)"""]
    for level in range(depth):
        parts.append(f"""
  g{level} AS (
    SELECT node, j, bin, {gini("t")} - {total("l")} / {total("t")}::DOUBLE * {gini("l")}
             - ({total("t")} - {total("l")}) / {total("t")}::DOUBLE * {gini("t", "l")} AS gain
    FROM (SELECT node, j, bin, {left}, {every}
          FROM (SELECT node, j, bin, {counts} FROM a{level} JOIN b USING (doc_id, pos) GROUP BY node, j, bin)
          WINDOW w AS (PARTITION BY node, j ORDER BY bin), a AS (PARTITION BY node, j))
    WHERE {total("l")} < {total("t")} AND {gini("t")} > 1e-15),
  s{level} AS (SELECT node, g.j, g.bin, threshold FROM g{level} g JOIN cuts ON cuts.j = g.j AND cuts.s = g.bin WHERE gain > 0
               QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, g.j, g.bin) = 1),
  a{level + 1} AS (SELECT doc_id, pos, 2 * node + (b.bin > s.bin)::INT AS node
                   FROM a{level} JOIN s{level} s USING (node) JOIN b USING (doc_id, pos) WHERE b.j = s.j)""")
    spread = " UNION ALL ".join(f"SELECT * FROM a{level}" for level in range(depth + 1))
    splits = " UNION ALL ".join(f"SELECT node, j, threshold FROM s{level}" for level in range(depth))
    parts.append(f"""
  nodes AS (SELECT node, n, j, threshold, {best_class} AS pos FROM (
              SELECT node, count(*) AS n, {counts} FROM ({spread}) GROUP BY node) LEFT JOIN ({splits}) USING (node)),
  under AS (SELECT a.node, min(l.pos) < max(l.pos) AS inner_node FROM nodes a JOIN nodes l
              ON l.j IS NULL AND (l.node >> ((length(bin(l.node)) - length(bin(a.node)))::INT)) = a.node
                 AND l.node >= a.node GROUP BY a.node),
  shown AS (SELECT node FROM nodes WHERE NOT EXISTS (
              SELECT 1 FROM under u WHERE NOT u.inner_node AND u.node < nodes.node
                AND (nodes.node >> ((length(bin(nodes.node)) - length(bin(u.node)))::INT)) = u.node)),
  tree AS (SELECT node, CASE WHEN inner_node THEN j END AS feature, CASE WHEN inner_node THEN threshold END AS threshold,
                  n, pos, NOT inner_node AS leaf
           FROM nodes JOIN shown USING (node) JOIN under USING (node))""")
    return ",".join(parts)
