"""SQL twins of :mod:`matchday.plans.views` (DuckDB dialect), used to build
the oracle queries.  Keep both files in step."""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "player_match": """
SELECT 't' || CAST(user_id % 20 AS VARCHAR) AS team,
       'n' || CAST(user_id % 7 AS VARCHAR) AS name,
       's' || CAST(user_id AS VARCHAR) AS surname,
       CASE user_id % 4 WHEN 0 THEN 'P' WHEN 1 THEN 'D' WHEN 2 THEN 'C' ELSE 'A' END AS role,
       season, round_no, voto, fantavoto, gol, ammonizione, assist, rigore, rig_sbagliato, autogol, espulsione
FROM (
  SELECT user_id, CAST(extract(year FROM ts) AS INT) AS season,
         CAST(extract(day FROM ts) AS INT) AS round_no,
         ROUND(AVG(CASE WHEN event_type = 'view' THEN value END) / 10, 6) AS voto,
         ROUND(MAX(CASE WHEN event_type = 'click' THEN value END) / 10, 6) AS fantavoto,
         COUNT(CASE WHEN event_type = 'purchase' THEN 1 END) AS gol,
         CAST(SUM(CASE WHEN event_type = 'error' THEN 1 END) AS BIGINT) AS ammonizione,
         COUNT(CASE WHEN event_type = 'click' THEN 1 END) AS assist,
         COUNT(CASE WHEN event_type = 'purchase' AND value >= 40 THEN 1 END) AS rigore,
         COUNT(CASE WHEN event_type = 'signup' AND value < 10 THEN 1 END) AS rig_sbagliato,
         CAST(SUM(CASE WHEN event_type = 'view' AND value >= 100 THEN 1 END) AS BIGINT) AS autogol,
         CAST(SUM(CASE WHEN event_type = 'error' AND value >= 80 THEN 1 END) AS BIGINT) AS espulsione
  FROM events
  GROUP BY user_id, extract(year FROM ts), extract(day FROM ts)
) g""",
    "fixture": """
SELECT o_orderkey AS fixture_id,
       CAST(extract(year FROM o_orderdate) AS INT) AS league_id,
       CAST(extract(week FROM o_orderdate) AS INT) AS round_no,
       o_orderdate AS event_date,
       CASE o_orderstatus WHEN 'F' THEN 'FT' WHEN 'O' THEN 'NS' ELSE 'PST' END AS status_short,
       c_nationkey AS home_team_id,
       CAST((c_nationkey + 1 + o_orderkey % 24) % 25 AS INT) AS away_team_id,
       CAST(o_orderkey % 3 AS INT) AS home_ht_goal,
       CAST(floor(o_totalprice) AS BIGINT) % 2 AS away_ht_goal,
       CAST(o_orderkey % 3 AS INT) + CAST(o_custkey % 2 AS INT) AS home_ft_goal,
       CAST(floor(o_totalprice) AS BIGINT) % 2 + o_orderkey % 2 AS away_ft_goal
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "fixture_master": """
SELECT f.*, h.n_name AS home_team_name, a.n_name AS away_team_name
FROM fixture f
LEFT JOIN nation h ON h.n_nationkey = f.home_team_id
LEFT JOIN nation a ON a.n_nationkey = f.away_team_id
WHERE f.status_short = 'FT'""",
    "calendar": """
SELECT o_orderkey AS fixture_id,
       CAST(extract(year FROM o_orderdate) AS INT) AS league_id,
       o_orderdate AS event_date,
       CAST(extract(week FROM o_orderdate) AS INT) AS round_no,
       CASE o_orderstatus WHEN 'F' THEN 'FT' WHEN 'O' THEN 'NS' ELSE 'PST' END AS status_short
FROM orders""",
    "fixture_stats": """
SELECT l_orderkey AS fixture_id,
       CASE l_returnflag WHEN 'A' THEN 'Ball Possession' WHEN 'N' THEN 'Shots on Goal' ELSE 'Fouls' END AS fixture_stat,
       CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS VARCHAR) || '%' ELSE CAST(l_quantity AS VARCHAR) END AS home,
       CAST(l_linenumber AS VARCHAR) AS away
FROM lineitem""",
    "team_map": """
SELECT n_name AS team_name, 't' || CAST(n_nationkey AS VARCHAR) AS team_marks
FROM nation WHERE n_nationkey <= 18""",
    "league_season": """
SELECT DISTINCT league_id, league_id + 23 AS season FROM calendar""",
    "name_fix": """
SELECT DISTINCT * FROM (
  SELECT name, surname, upper(name) AS name_correct, surname || ' jr' AS surname_correct
  FROM player_match WHERE role = 'P'
  UNION ALL
  SELECT name, surname, CAST(NULL AS VARCHAR) AS name_correct, surname || 'x' AS surname_correct
  FROM player_match WHERE team = 't1'
) u""",
}

# dependencies between views (a view may only use views listed before it)
_ORDER = [
    "player_match",
    "fixture",
    "fixture_master",
    "calendar",
    "fixture_stats",
    "team_map",
    "league_season",
    "name_fix",
]


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with a WITH clause defining ``names`` (and the views
    they depend on, in dependency order).  ``body`` may start with more CTEs
    written as ``, x AS (...)`` by passing it through :func:`ctes`."""
    needed = set(names)
    deps = {
        "fixture_master": {"fixture"},
        "league_season": {"calendar"},
        "name_fix": {"player_match"},
    }
    changed = True
    while changed:
        changed = False
        for n in list(needed):
            for d in deps.get(n, ()):
                if d not in needed:
                    needed.add(d)
                    changed = True
    parts = [f"{n} AS ({VIEWS[n]}\n)" for n in _ORDER if n in needed]
    body = body.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
