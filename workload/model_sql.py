"""What the registered models learn, in SQL: means of cells, stumps, normal equations, gradient steps."""

from __future__ import annotations

import math
from collections.abc import Sequence

from marquee.plans import modeling as ml
from workload.encode_queries import BUCKET_SQL, fold_sql

# The model frame's numeric features, with both parts marked.  ``second_half`` is a second 0/1 feature.
FRAME_SQL = f""", frame AS (
  SELECT id, vote_average, rating_category, vote_count, release_year, release_month, release_day,
    normalized_popularity, coalesce(overview_length, 0) AS overview_length,
    CAST(is_remake AS INTEGER) AS is_remake, movie_age, CAST(release_month > 6 AS INTEGER) AS second_half,
    {BUCKET_SQL} AS is_train
  FROM processed WHERE release_year IS NOT NULL AND release_month IS NOT NULL
    AND release_day IS NOT NULL AND movie_age IS NOT NULL),
buckets AS (
  SELECT rating_category, row_number() OVER (ORDER BY count(*) DESC, rating_category) - 1 AS i
  FROM frame WHERE is_train GROUP BY rating_category),
indexed AS (
  SELECT frame.*, CAST(i AS DOUBLE) AS rating_category_index
  FROM frame JOIN buckets USING (rating_category))"""

# Two 0/1 features: all that a model can learn from them is in four cells.
TWO = ["is_remake", "second_half"]

def errors_sql(digits: int = 6) -> str:
    return (
        f"round(sqrt(avg((y - p) ** 2)), {digits}) AS rmse, round(avg(abs(y - p)), {digits}) AS mae,"
        f" round(avg((y - p) ** 2), {digits}) AS mse,"
        f" round(1 - sum((y - p) ** 2) / (count(*) * var_pop(y)), {digits}) AS r2"
    )


ERRORS = errors_sql()


def rows_sql(folds: int = 0) -> str:
    """``fits`` and ``held`` (part, a, b, y): one part, or one for each fold of a search."""
    one = "is_remake AS a, second_half AS b, vote_average AS y"
    if not folds:
        return f"""{FRAME_SQL},
fits AS (SELECT 0 AS part, {one} FROM frame WHERE is_train),
held AS (SELECT 0 AS part, id, {one} FROM frame WHERE NOT is_train)"""
    return f"""{FRAME_SQL},
held AS (SELECT {fold_sql(folds)} AS part, id, {one} FROM frame WHERE is_train),
fits AS (SELECT i AS part, a, b, y FROM held JOIN range({folds}) r(i) ON held.part <> i)"""


CELLS_SQL = """
cells AS (
  SELECT part, a, b, count(y) AS n, coalesce(sum(y), 0) AS s
  FROM (SELECT DISTINCT part FROM fits) JOIN (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS v(a, b) ON true
  LEFT JOIN fits USING (part, a, b) GROUP BY part, a, b)"""


def tree_sql(name: str, points: str, cells: str = "cells") -> str:
    """``name`` (part, point, a, b, p): a tree's leaves over ``points`` (point, depth, least)."""
    return f"""
{name}_sums AS (
  SELECT *, sum(n) OVER w AS tn, sum(s) OVER w AS ts, sum(n) OVER wa AS an, sum(s) OVER wa AS ats,
    sum(n) OVER wb AS bn, sum(s) OVER wb AS bts, min(n) OVER wa AS least_a, min(n) OVER wb AS least_b
  FROM {cells}
  WINDOW w AS (PARTITION BY part), wa AS (PARTITION BY part, a), wb AS (PARTITION BY part, b)),
{name}_gains AS (
  SELECT part, min(an) AS small_a, min(bn) AS small_b,
    sum(CASE WHEN an > 0 THEN n * ats * ats / an / an ELSE 0 END) AS gain_a,
    sum(CASE WHEN bn > 0 THEN n * bts * bts / bn / bn ELSE 0 END) AS gain_b
  FROM {name}_sums GROUP BY part),
{name}_cuts AS (
  SELECT g.part, point, depth, least, depth > 0 AND small_a >= least AND (small_b < least OR gain_a >= gain_b) AS by_a,
    depth > 0 AND small_b >= least AND (small_a < least OR gain_a < gain_b) AS by_b
  FROM {name}_gains g CROSS JOIN ({points}) AS grid(point, depth, least)),
{name} AS (
  SELECT part, point, a, b, CASE
    WHEN by_a AND depth > 1 AND least_a >= least THEN s / n WHEN by_a THEN ats / an
    WHEN by_b AND depth > 1 AND least_b >= least THEN s / n WHEN by_b THEN bts / bn
    ELSE ts / tn END AS p
  FROM {name}_sums JOIN {name}_cuts USING (part))"""


def boosted_sql(points: str) -> str:
    """``leaves``: a stump and a second one on twice its residuals, times the step of ``points`` (point, step)."""
    stump = "SELECT 'stump', 1, 1"
    return f"""{tree_sql("first_tree", stump)},
residuals AS (
  SELECT cells.part, cells.a, cells.b, n, 2 * (s - n * p) AS s FROM cells JOIN first_tree f
  ON cells.part = f.part AND cells.a = f.a AND cells.b = f.b),
{tree_sql("second_tree", stump, "residuals")},
leaves AS (
  SELECT f.part, steps.point, f.a, f.b, f.p + step * t.p AS p
  FROM first_tree f JOIN second_tree t ON f.part = t.part AND f.a = t.a AND f.b = t.b
  CROSS JOIN ({points}) AS steps(point, step))"""


def gaussians(seed: int, count: int) -> list[float]:
    """The first normal numbers of the JVM's generator for a seed: where a factorization machine starts."""
    state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def bits(n: int) -> int:
        nonlocal state
        state = (state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
        return state >> (48 - n)

    def uniform() -> float:
        return ((bits(26) << 27) + bits(27)) / (1 << 53)

    made: list[float] = []
    while len(made) < count:
        x, y = 2 * uniform() - 1, 2 * uniform() - 1
        if 0 < (s := x * x + y * y) < 1:
            scale = math.sqrt(-2 * math.log(s) / s)
            made += [x * scale, y * scale]
    return made[:count]


def machine_sql(points: Sequence[tuple[str, float, int]], steps: int, spread: float) -> str:
    """``machines``: a factorization machine on both features, scaled, after full-batch gradient steps.

    ``points`` has (point, step size, factors).  The prediction is linear in 1, a, b and a * b, so
    the gradient needs only their moments.
    """
    grid = []
    for point, step, factors in points:
        start = [spread * g for g in gaussians(ml.SEED, 2 * factors)]
        grid.append(f"('{point}', {step!r}, {start[:factors]!r}::DOUBLE[], {start[factors:]!r}::DOUBLE[])")
    return f"""
spreads AS (SELECT part, coalesce(1 / nullif(stddev_samp(a), 0), 0) AS ka, coalesce(1 / nullif(stddev_samp(b), 0), 0) AS kb
  FROM fits GROUP BY part),
moments AS (
  SELECT part, ka, kb, avg(x) AS x, avg(z) AS z, avg(x * x) AS xx, avg(z * z) AS zz, avg(x * z) AS xz,
    avg(x * x * z) AS xxz, avg(x * z * z) AS xzz, avg(x * x * z * z) AS xxzz, avg(y) AS y, avg(x * y) AS xy,
    avg(z * y) AS zy, avg(x * z * y) AS xzy
  FROM (SELECT part, ka, kb, a * ka AS x, b * kb AS z, y FROM fits JOIN spreads USING (part)) GROUP BY part, ka, kb),
paths AS (WITH RECURSIVE paths AS (
  SELECT part, point, step, 0 AS i, CAST(0 AS DOUBLE) AS w, CAST(0 AS DOUBLE) AS wx, CAST(0 AS DOUBLE) AS wz, vx, vz
  FROM moments CROSS JOIN (VALUES {", ".join(grid)}) AS grid(point, step, vx, vz)
  UNION ALL
  SELECT part, point, step, i, w - h * 2 * (w + wx * x + wz * z + c * xz - y),
    wx - h * 2 * (w * x + wx * xx + wz * xz + c * xxz - xy), wz - h * 2 * (w * z + wx * xz + wz * zz + c * xzz - zy),
    list_transform(vx, lambda v, j: v - h * g * vz[j]), list_transform(vz, lambda v, j: v - h * g * vx[j])
  FROM (SELECT *, 2 * (w * xz + wx * xxz + wz * xzz + c * xxzz - xzy) AS g FROM (
    SELECT p.part, point, step, i + 1 AS i, w, wx, wz, vx, vz, step / sqrt(i + 1) AS h,
      list_inner_product(vx, vz) AS c, m.* EXCLUDE (part)
    FROM paths p JOIN moments m ON p.part = m.part WHERE i < {steps})))
  SELECT * FROM paths),
machines AS (
  SELECT part, point, ka, kb, w, wx, wz, list_inner_product(vx, vz) AS c FROM paths JOIN moments USING (part)
  WHERE i = {steps})"""


MACHINE = "w + wx * a * ka + wz * b * kb + c * a * ka * b * kb"


def solved_sql(name: str, features: Sequence[str], rows: str) -> str:
    """``name`` (x, means, spreads, mean): least-squares weights of ``features`` over ``rows``, centred and scaled.

    Normal equations, solved by elimination, one column at a step.
    """
    size = len(features)
    xs = ", ".join(f"(CAST({f} AS DOUBLE) - means[{i + 1}]) / spreads[{i + 1}] AS x{i}" for i, f in enumerate(features))
    sums = ", ".join(
        "[" + ", ".join([*(f"sum(x{i} * x{j})" for j in range(size)), f"sum(x{i} * y)"]) + "]" for i in range(size)
    )
    each = ["[" + ", ".join(f"{f}({c})" for c in features) + "]" for f in ("avg", "stddev_samp")]
    return f"""
{name}_scale AS (SELECT {each[0]} AS means, {each[1]} AS spreads, avg(vote_average) AS mean FROM {rows}),
{name}_rows AS (SELECT {xs}, vote_average - mean AS y FROM {rows} CROSS JOIN {name}_scale),
{name} AS (
  WITH RECURSIVE steps AS (
    SELECT 1 AS k, [{sums}] AS m FROM {name}_rows
    UNION ALL
    SELECT k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / m[k][k])
      ELSE list_transform(r, lambda v, j: v - r[k] * m[k][j] / m[k][k]) END)
    FROM steps WHERE k <= {size})
  SELECT list_transform(m, lambda r: r[{size + 1}]) AS x, means, spreads, mean
  FROM steps CROSS JOIN {name}_scale WHERE k = {size + 1})"""


def linear(features: Sequence[str]) -> str:
    """The prediction of ``solved_sql``'s weights."""
    return "mean + " + " + ".join(
        f"x[{i + 1}] * ({f} - means[{i + 1}]) / spreads[{i + 1}]" for i, f in enumerate(features)
    )


# --- searches on all features ---------------------------------------------

def _kept_sql(column: str) -> str:
    """The values of ``column`` that have an indicator, in rank order: none for NULL, which is ranked like any."""
    return f"""
kept_{column} AS (
  SELECT coalesce(list({column} ORDER BY r) FILTER ({column} IS NOT NULL), []) AS kept_{column} FROM (
    SELECT {column}, row_number() OVER (ORDER BY count(*) DESC, {column} NULLS LAST) AS r
    FROM processed GROUP BY {column}) WHERE r <= 5)"""


def whole_sql(folds: int, label: str = "vote_average") -> str:
    """``scaled`` (part, fit, rid, y, x): the prepared rows of each fold, those held out not ``fit``; ``places`` its entries.

    Each fold's indexer and scaler learn from its fitted rows.
    """
    numeric = ", ".join(
        "coalesce(i, kinds)" if c == ml.CATEGORY_INDEX
        else f"coalesce({c}, 0)" if c == "overview_length" else f"CAST({c} AS INTEGER)" if c == "is_remake" else c
        for c in ml.NUMERIC_FEATURES
    )
    flags = " || ".join(
        f"list_transform(kept_{c}, lambda k: CAST(coalesce({c} = k, false) AS DOUBLE))"
        f" || [CAST({c} IS NOT NULL AND NOT list_contains(kept_{c}, {c}) AS DOUBLE)]"
        for c in ml.ENCODED
    )
    return f""",{",".join(_kept_sql(c) for c in ml.ENCODED)},
known AS (
  SELECT *, row_number() OVER (ORDER BY id) AS rid, {fold_sql(folds)} AS fold, {label} AS y
  FROM processed WHERE release_year IS NOT NULL AND release_month IS NOT NULL
    AND release_day IS NOT NULL AND movie_age IS NOT NULL AND {BUCKET_SQL}),
sided AS (SELECT i AS part, fold <> i AS fit, known.* FROM known CROSS JOIN range({folds}) r(i)),
ranks AS (
  SELECT part, rating_category, row_number() OVER (PARTITION BY part ORDER BY count(*) DESC, rating_category) - 1 AS i
  FROM sided WHERE fit GROUP BY part, rating_category),
kinds AS (SELECT part, count(*) AS kinds FROM ranks GROUP BY part),
assembled AS (
  SELECT part, fit, rid, y, CAST([{numeric}] AS DOUBLE[]) || {flags} AS x
  FROM sided JOIN kinds USING (part) LEFT JOIN ranks USING (part, rating_category)
    CROSS JOIN {" CROSS JOIN ".join(f"kept_{c}" for c in ml.ENCODED)}),
entries AS MATERIALIZED (
  SELECT part, fit, rid, y, unnest(range(1, len(x) + 1)) AS j, unnest(x) AS v FROM assembled),
scales AS (SELECT part, j, coalesce(1 / nullif(stddev_samp(v), 0), 0) AS k FROM entries WHERE fit GROUP BY part, j),
places AS MATERIALIZED (SELECT part, fit, rid, y, j, v * k AS v FROM entries JOIN scales USING (part, j)),
scaled AS MATERIALIZED (SELECT part, fit, rid, y, list(v ORDER BY j) AS x FROM places GROUP BY part, fit, rid, y)"""


def machines_sql(points: Sequence[tuple[str, float, int]], steps: int, spread: float, folds: int) -> str:
    """``errors`` (part, point, rmse): machines on all features after full-batch AdamW steps.

    The prediction is linear in ``phi``: 1, the features and their products, whose sums of products are taken once.
    """
    most = max(k for _, _, k in points) * (len(ml.NUMERIC_FEATURES) + 6 * len(ml.ENCODED))
    start = [spread * g for g in gaussians(ml.SEED, most)]
    grid = ", ".join(f"('{point}', {step!r}, {k})" for point, step, k in points)
    return f"""{whole_sql(folds)},
pairs AS (
  SELECT d, list(struct_pack(a := a, b := b) ORDER BY a, b) AS pairs
  FROM (SELECT max(j) AS d FROM places) CROSS JOIN range(1, 100) a(a) CROSS JOIN range(1, 100) b(b)
  WHERE a < b AND b <= d GROUP BY d),
columns_of AS MATERIALIZED (
  SELECT part, j, list(v ORDER BY rid) AS c, list(y ORDER BY rid) AS ys FROM places WHERE fit GROUP BY part, j),
phis AS MATERIALIZED (
  SELECT part, 0 AS a, 0 AS b, list_transform(c, lambda v: CAST(1 AS DOUBLE)) AS c, ys FROM columns_of WHERE j = 1
  UNION ALL SELECT part, 0, j, c, ys FROM columns_of
  UNION ALL SELECT l.part, l.j, r.j, list_transform(list_zip(l.c, r.c), lambda z: z[1] * z[2]), l.ys
  FROM columns_of l JOIN columns_of r ON l.part = r.part AND l.j < r.j),
sums AS (
  SELECT l.part, l.a, l.b, list(list_inner_product(l.c, r.c) / len(l.c) ORDER BY r.a, r.b) AS m,
    any_value(list_inner_product(l.c, l.ys) / len(l.c)) AS my
  FROM phis l JOIN phis r ON l.part = r.part GROUP BY l.part, l.a, l.b),
moments AS MATERIALIZED (SELECT part, list(m ORDER BY a, b) AS m, list(my ORDER BY a, b) AS my FROM sums GROUP BY part),
paths AS (WITH RECURSIVE paths AS (
  SELECT part, point, step, k, 0 AS i, list_transform(range(1, k * d + d + 2),
      lambda q: CASE WHEN q <= k * d THEN CAST({start!r} AS DOUBLE[])[q] ELSE CAST(0 AS DOUBLE) END) AS w,
    list_transform(range(1, k * d + d + 2), lambda q: CAST(0 AS DOUBLE)) AS mean,
    list_transform(range(1, k * d + d + 2), lambda q: CAST(0 AS DOUBLE)) AS square,
    CAST(1 AS DOUBLE) AS rest, CAST(1 AS DOUBLE) AS rest2
  FROM moments CROSS JOIN pairs CROSS JOIN (VALUES {grid}) AS grid(point, step, k)
  UNION ALL
  SELECT part, point, step, k, i,
    list_transform(w, lambda v, q: v - step * (mean[q] / (1 - rest)) / (sqrt(square[q] / (1 - rest2)) + 1e-8)),
    mean, square, rest, rest2
  FROM (SELECT part, point, step, k, i, w, list_transform(mean, lambda v, q: 0.9::DOUBLE * v + (1 - 0.9::DOUBLE) * g[q]) AS mean,
      list_transform(square, lambda v, q: 0.999::DOUBLE * v + (1 - 0.999::DOUBLE) * (g[q] * g[q])) AS square, rest, rest2
    FROM (SELECT *, flatten(list_transform(range(1, d + 1), lambda a: list_transform(vt, lambda col:
          list_inner_product(list_transform(range(1, d + 1), lambda b: CASE WHEN a = b THEN CAST(0 AS DOUBLE)
            ELSE s[1 + d + (least(a, b) - 1) * d - (least(a, b) - 1) * least(a, b) // 2 + abs(a - b)] END), col))))
          || s[2:d + 1] || s[1:1] AS g
      FROM (SELECT *, list_transform(m, lambda r, q: 2 * (list_inner_product(r, phi) - my[q])) AS s
        FROM (SELECT *, w[len(w):len(w)] || w[k * d + 1:k * d + d]
            || list_transform(pairs, lambda p: list_inner_product(vs[p.a], vs[p.b])) AS phi,
            list_transform(range(1, k + 1), lambda f: list_transform(vs, lambda r: r[f])) AS vt
          FROM (SELECT p.part, point, step, k, i + 1 AS i, w, mean, square, rest * 0.9::DOUBLE AS rest,
              rest2 * 0.999::DOUBLE AS rest2, m, my, d, pairs,
              list_transform(range(1, d + 1), lambda a: w[(a - 1) * k + 1:a * k]) AS vs
            FROM paths p JOIN moments ON p.part = moments.part CROSS JOIN pairs WHERE i < {steps}))))))
  SELECT * FROM paths),
machines AS (
  SELECT part, point, w[len(w):len(w)] || w[k * d + 1:k * d + d] || list_transform(pairs, lambda p:
    list_inner_product(w[(p.a - 1) * k + 1:p.a * k], w[(p.b - 1) * k + 1:p.b * k])) AS phi
  FROM paths CROSS JOIN pairs WHERE i = {steps}),
errors AS (
  SELECT part, point, sqrt(avg((y - list_inner_product(phi,
    [CAST(1 AS DOUBLE)] || x || list_transform(pairs, lambda p: x[p.a] * x[p.b]))) ** 2)) AS rmse
  FROM scaled JOIN machines USING (part) CROSS JOIN pairs WHERE NOT fit GROUP BY part, point)"""


def trees_sql(points: Sequence[tuple[str, int, int]], folds: int, label: str, bins: int = 32) -> str:
    """``errors`` (part, point, rmse) of ``points`` (point, depth, least): trees on all features, level by level.

    Splits lie between values near every ``bins``-th part of a fold's rows.  Gains are reckoned as the library does;
    of equal ones the first feature's lowest split is taken.
    """
    spread = "({ss} - {s} * {s} / {n}) / {n}".format
    least = ", ".join(f"({n})" for n in sorted({n for _, _, n in points}))
    levels = []
    for k in range(max(depth for _, depth, _ in points)):
        levels.append(f"""
sums{k} AS (
  SELECT part, least, node, j, b, CAST(count(*) AS DOUBLE) AS n, sum(y) AS s, sum(y * y) AS ss
  FROM level{k} JOIN bins USING (part, rid) WHERE fit AND open GROUP BY part, least, node, j, b),
runs{k} AS (
  SELECT part, least, node, j, b, sum(n) OVER l AS ln, sum(s) OVER l AS ls, sum(ss) OVER l AS lss,
    sum(n) OVER t AS n, sum(s) OVER t AS s, sum(ss) OVER t AS ss
  FROM sums{k} WINDOW l AS (PARTITION BY part, least, node, j ORDER BY b), t AS (PARTITION BY part, least, node, j)),
sides{k} AS (
  SELECT *, n - ln AS rn, s - ls AS rs, {spread(n="n", s="s", ss="ss")} AS whole, {spread(n="ln", s="ls", ss="lss")} AS low,
    {spread(n="(n - ln)", s="(s - ls)", ss="(ss - lss)")} AS high
  FROM runs{k} WHERE ln >= least AND n - ln >= least),
cuts{k} AS MATERIALIZED (
  SELECT part, least, node, j, b AS cut, ls / ln AS lp, rs / rn AS rp, abs(low) >= 2.220446049250313e-16 AS lopen,
    abs(high) >= 2.220446049250313e-16 AS ropen
  FROM (SELECT *, whole - ln / n * low - rn / n * high AS gain FROM sides{k}) WHERE gain > 0
  QUALIFY row_number() OVER (PARTITION BY part, least, node ORDER BY gain DESC, j, b) = 1),
level{k + 1} AS MATERIALIZED (
  SELECT l.part, l.least, l.rid, fit, y, CASE WHEN cut IS NULL THEN l.node ELSE 2 * l.node + CAST(b > cut AS INTEGER) END AS node,
    cut IS NOT NULL AND CASE WHEN b > cut THEN ropen ELSE lopen END AS open,
    CASE WHEN cut IS NULL THEN p WHEN b > cut THEN rp ELSE lp END AS p
  FROM level{k} l LEFT JOIN cuts{k} c ON l.part = c.part AND l.least = c.least AND l.node = c.node
    LEFT JOIN bins ON bins.part = l.part AND bins.rid = l.rid AND bins.j = c.j)""")
    errors = " UNION ALL ".join(
        f"SELECT part, '{point}' AS point, sqrt(avg((y - p) ** 2)) AS rmse FROM level{depth}"
        f" WHERE NOT fit AND least = {least} GROUP BY part"
        for point, depth, least in points
    )
    return f"""{whole_sql(folds, label)},
counted AS MATERIALIZED (
  SELECT part, j, v, n, lag(v) OVER w AS before, sum(n) OVER w AS upto, row_number() OVER w - 1 AS i,
    count(*) OVER (PARTITION BY part, j) AS kinds, sum(n) OVER (PARTITION BY part, j) AS total
  FROM (SELECT part, j, v, count(*) AS n FROM places WHERE fit GROUP BY part, j, v)
  WINDOW w AS (PARTITION BY part, j ORDER BY v)),
-- A split where the count before a value is nearer to the target than that with it.
strides AS (WITH RECURSIVE strides AS (
  SELECT DISTINCT part, j, CAST(0 AS BIGINT) AS i, total / least({bins}, total) AS target, total / least({bins}, total) AS stride
  FROM counted WHERE kinds > least({bins}, total)
  UNION ALL
  SELECT s.part, s.j, min(c.i), any_value(target + stride), any_value(stride)
  FROM strides s JOIN counted c ON s.part = c.part AND s.j = c.j AND c.i > s.i AND (c.upto - c.n + c.upto) / 2 > target
  GROUP BY s.part, s.j)
  SELECT * FROM strides),
thresholds AS (
  SELECT part, j, list((before + v) / 2 ORDER BY v) AS t FROM (
    SELECT part, j, before, v FROM counted WHERE i > 0 AND kinds <= least({bins}, total)
    UNION ALL SELECT part, j, before, v FROM counted JOIN strides USING (part, j, i) WHERE i > 0)
  GROUP BY part, j),
bins AS MATERIALIZED (
  SELECT part, rid, j, len(list_filter(t, lambda q: q < v)) AS b FROM places JOIN thresholds USING (part, j)),
level0 AS MATERIALIZED (
  SELECT part, least, rid, fit, y, CAST(1 AS BIGINT) AS node, true AS open, avg(y) FILTER (fit) OVER (PARTITION BY part, least) AS p
  FROM scaled CROSS JOIN (VALUES {least}) AS v(least)),{",".join(levels)},
errors AS ({errors})"""
