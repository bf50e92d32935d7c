"""Linear regression in SQL: scaled features, sums per fold, normal equations by elimination."""

from __future__ import annotations

from cargolith.catalog.sqlbase import SHIP, VARIANCE

# Features of the delivery models, in their order, over the columns of ``shipments``.
FEATURES = [
    "TotalWeight", "TotalVolume", "TotalPackages", "ShipmentValue", "month(ShipmentDate)", "quarter(ShipmentDate)", "isodow(ShipmentDate) - 1",
    "year(ShipmentDate)", "OriginLocationKey", "DestinationLocationKey", "EquipmentKey", "FreightTypeKey", "TotalWeight / (TotalVolume + 1e-6)",
    "ShipmentValue / (TotalWeight + 1e-6)",
]
P = len(FEATURES)


def digest(seed: int, key: str = "ShipmentID") -> str:
    return f"(('0x' || left(md5('{seed}:' || {key}), 8))::BIGINT / 4294967296.0)"


def ridge(seed: int, folds: int) -> str:
    """CTEs up to ``coef(id, alpha, fold, w, b)``; fold -1 is the fit on all training rows. ``z`` holds the scaled rows."""
    raw = ", ".join(f"coalesce(({f})::DOUBLE, 0) AS f{i}" for i, f in enumerate(FEATURES))
    marks = ", ".join(f"quantile_cont(f{i}, [0.25, 0.5, 0.75]) AS q{i}" for i in range(P))
    scaled = ", ".join(f"(f{i} - q{i}[2]) / CASE WHEN q{i}[3] = q{i}[1] THEN 1 ELSE q{i}[3] - q{i}[1] END AS x{i}" for i in range(P))
    sums = ", ".join([f"sum(x{i} * x{j}) AS s{i}_{j}" for i in range(P) for j in range(i, P)] + [f"sum(x{i}) AS s{i}, sum(x{i} * y) AS t{i}" for i in range(P)])
    names = [f"s{i}_{j}" for i in range(P) for j in range(i, P)] + [f"s{i}" for i in range(P)] + [f"t{i}" for i in range(P)] + ["n", "sy", "syy"]
    total = ", ".join(f"sum({c}) AS {c}" for c in names)
    rest = ", ".join(f"t.{c} - f.{c} AS {c}" for c in names)
    rows = []
    for i in range(P):
        cells = [f"s{min(i, j)}_{max(i, j)} - s{i} * s{j} / n" + (" + alpha" if i == j else "") for j in range(P)]
        rows.append(f"[{', '.join([*cells, f't{i} - s{i} * sy / n'])}]")
    mean = " + ".join(f"w[{i + 1}] * s{i}" for i in range(P))
    return f"""{SHIP},
raw AS (SELECT ShipmentID, {VARIANCE}::DOUBLE AS y, {raw} FROM shipments WHERE {VARIANCE} IS NOT NULL),
part AS (SELECT *, {digest(seed)} < 0.2 AS test, floor({digest(seed + 1)} * {folds})::INTEGER AS fold FROM raw),
q AS (SELECT {marks} FROM part WHERE NOT test),
z AS (SELECT ShipmentID, y, test, fold, {scaled} FROM part, q),
f AS (SELECT fold, count(*)::DOUBLE AS n, sum(y) AS sy, sum(y * y) AS syy, {sums} FROM z WHERE NOT test GROUP BY fold),
t AS (SELECT {total} FROM f),
m AS (SELECT f.fold, {rest} FROM f, t UNION ALL BY NAME SELECT -1 AS fold, * FROM t),
start AS (SELECT fold, alpha, [{', '.join(rows)}] AS a FROM m, (SELECT unnest([0.1::DOUBLE, 1, 10, 100]) AS alpha)),
gj(fold, alpha, k, a) AS (SELECT fold, alpha, 0, a FROM start UNION ALL
  SELECT fold, alpha, k + 1, list_transform(a, lambda r, i: CASE WHEN i = k + 1 THEN list_transform(r, lambda v: v / r[k + 1])
    ELSE list_transform(r, lambda v, j: v - r[k + 1] * a[k + 1][j] / a[k + 1][k + 1]) END) FROM gj WHERE k < {P}),
solved AS (SELECT fold, alpha, list_transform(a, lambda r: r[{P + 1}]) AS w FROM gj WHERE k = {P}),
coef AS (SELECT fold, alpha, w, (sy - ({mean})) / n AS b FROM solved JOIN m USING (fold))"""


PREDICTED = "b + " + " + ".join(f"w[{i + 1}] * x{i}" for i in range(P))
