"""Small text helpers that spell out the oracle SQL (DuckDB dialect) for the
views and the sequential imputation levels.  They only assemble SQL text for
the reference side of the correctness check."""

from __future__ import annotations

SPEND = ["RoomService", "FoodCourt", "ShoppingMall", "Spa", "VRDeck"]

LABEL_SQL = "((o.o_orderstatus = 'F' AND o.o_totalprice > 100000) OR (o.o_orderstatus <> 'F' AND o.o_totalprice > 400000))"

MANIFEST_CTE = f"""
spend AS (
  SELECT l_orderkey,
    {", ".join(f"CAST(sum(CASE WHEN (l_linenumber - 1) % 5 = {i} THEN CAST(l_extendedprice AS DECIMAL(18, 2)) END) AS DOUBLE) AS _s{i}" for i in range(5))}
  FROM lineitem GROUP BY l_orderkey
),
manifest AS (
  SELECT
    concat(CAST(o.o_custkey AS VARCHAR), '_', CAST(o.o_orderkey AS VARCHAR)) AS PassengerId,
    CASE WHEN o.o_orderkey % 7 <> 0 THEN r.r_name END AS HomePlanet,
    CASE WHEN o.o_orderkey % 9 <> 0 THEN o.o_orderstatus = 'F' END AS CryoSleep,
    CASE WHEN o.o_orderkey % 5 <> 0 THEN concat(substr(c.c_mktsegment, 1, 1), '/', CAST(o.o_orderkey % 500 AS VARCHAR), '/',
         CASE WHEN o.o_orderkey % 2 = 0 THEN 'P' ELSE 'S' END) END AS Cabin,
    CASE WHEN o.o_orderkey % 11 <> 0 THEN o.o_orderpriority END AS Destination,
    CASE WHEN o.o_orderkey % 6 <> 0 THEN CAST((c.c_custkey % 60) + (o.o_orderkey % 20) AS DOUBLE) END AS Age,
    CASE WHEN o.o_orderkey % 8 <> 0 THEN c.c_acctbal > 8000 END AS VIP,
    {", ".join(f"CASE WHEN s._s{i} IS NOT NULL AND o.o_orderkey % 4 = 0 THEN CAST(0.0 AS DOUBLE) ELSE s._s{i} END AS {n}" for i, n in enumerate(SPEND))},
    CASE WHEN o.o_orderkey % 13 = 0 THEN NULL
         WHEN o.o_orderkey % 17 = 0 THEN concat('F', CAST(o.o_orderkey % 97 AS VARCHAR))
         ELSE concat('F', CAST(o.o_orderkey % 97 AS VARCHAR), ' ', n.n_name) END AS Name,
    CASE WHEN o.o_orderkey % 5 <> 3 THEN {LABEL_SQL} END AS Transported,
    o.o_orderkey % 5 <> 3 AS is_train
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN spend s ON o.o_orderkey = s.l_orderkey
)"""


def _p(mult: int, add: int, shift: int) -> str:
    return f"CAST(least((o.o_orderkey * {mult} + {add}) % 1009 + CAST({LABEL_SQL} AS INTEGER) * {shift}, 1008) AS DOUBLE) / 1009.0"


SCORES_CTE = f"""
scores AS (
  SELECT
    concat(CAST(o.o_custkey AS VARCHAR), '_', CAST(o.o_orderkey AS VARCHAR)) AS PassengerId,
    CASE WHEN o.o_orderkey % 5 <> 3 THEN {LABEL_SQL} END AS Transported,
    {_p(37, 11, 300)} AS p_a,
    {_p(101, 7, 200)} AS p_b,
    {_p(211, 3, 120)} AS p_c,
    CASE WHEN o.o_orderkey % 5 <> 3 THEN 'oof' ELSE 'test' END AS split
  FROM orders o
),
long_scores AS (
  SELECT PassengerId AS id, CAST(Transported AS INTEGER) AS y, model, p FROM (
    SELECT PassengerId, Transported, 'a' AS model, p_a AS p FROM scores WHERE split = 'oof'
    UNION ALL SELECT PassengerId, Transported, 'b', p_b FROM scores WHERE split = 'oof'
    UNION ALL SELECT PassengerId, Transported, 'c', p_c FROM scores WHERE split = 'oof')
)"""


def with_views(body: str, *extra_ctes: str, scores: bool = False) -> str:
    ctes = [MANIFEST_CTE]
    if scores:
        ctes.append(SCORES_CTE)
    ctes.extend(extra_ctes)
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body


def _on(prev: str, stat: str, keys: list[str]) -> str:
    return " AND ".join(f"{prev}.{k} IS NOT DISTINCT FROM {stat}.{k}" for k in keys)


def level(name: str, prev: str, keys: list[str], modes: list[str] = (), medians: list[str] = ()) -> str:
    """CTEs for one sequential level: per-column statistics + fill."""
    ctes = []
    joins = []
    repl = []
    kl = ", ".join(keys)
    for i, c in enumerate(list(modes) + list(medians)):
        s = f"{name}_s{i}"
        if c in modes:
            if keys:
                body = (f"SELECT {kl}, v AS s FROM (SELECT {kl}, {c} AS v, row_number() OVER (PARTITION BY {kl} "
                        f"ORDER BY count(*) DESC, {c}) AS rn FROM {prev} WHERE {c} IS NOT NULL GROUP BY {kl}, {c}) WHERE rn = 1")
            else:
                body = (f"SELECT v AS s FROM (SELECT {c} AS v, count(*) AS n FROM {prev} WHERE {c} IS NOT NULL "
                        f"GROUP BY {c} ORDER BY n DESC, v LIMIT 1)")
        else:
            body = f"SELECT {kl + ', ' if keys else ''}median({c}) AS s FROM {prev}" + (f" GROUP BY {kl}" if keys else "")
        ctes.append(f"{s} AS MATERIALIZED ({body})")
        if keys:
            joins.append(f"LEFT JOIN {s} ON {_on(prev, s, keys)}")
        else:
            joins.append(f"LEFT JOIN {s} ON TRUE")
        repl.append(f"coalesce({prev}.{c}, {s}.s) AS {c}")
    ctes.append(f"{name} AS MATERIALIZED (SELECT {prev}.* REPLACE ({', '.join(repl)}) FROM {prev} {' '.join(joins)})")
    return ",\n".join(ctes)


def as_float(cols: list[str]) -> str:
    return ", ".join(f"CAST({c} AS FLOAT) AS {c}" for c in cols)
