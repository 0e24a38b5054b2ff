"""DuckDB oracle SQL for every registered query that SQL can express.

Computed doubles are rounded to 6 places on both sides; every window has a
total order.
"""

from __future__ import annotations

from matchday.operators.features import FeatureWindows, PlayerColumns, player_feature_names
from matchday.plans.oracle_views import with_views


def _q01_body() -> str:
    cols, win = PlayerColumns(), FeatureWindows()
    part = "PARTITION BY name, surname ORDER BY season, round_no, team"
    exprs = []
    lens = sorted(set(win.sum_wind) | set(win.sd_wind) | set(win.mean_wind) | {win.count_wind})
    for c in cols.count_stats:
        for n in win.sum_wind:
            exprs.append(f"CASE WHEN count({c}) OVER w{n} >= 2 THEN sum({c}) OVER w{n} END AS {c}_s{n}")
        for n in win.sd_wind:
            exprs.append(
                f"CASE WHEN count({c}) OVER w{n} >= 2 THEN stddev_samp({c}) OVER w{n} END AS {c}_sd{n}"
            )
    exprs.append(f"sum(presenza) OVER w{win.count_wind} AS presenza_cnt{win.count_wind}")
    for c in cols.marks:
        for n in win.mean_wind:
            exprs.append(f"avg({c}) OVER w{n} AS {c}_m{n}")
    windows = ", ".join(f"w{n} AS ({part} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in lens)
    names = player_feature_names(cols, win)
    counts = ", ".join(f"COALESCE(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in cols.count_stats)
    keys = "team, role, name, surname, season, round_no"
    outs = ", ".join(f"ROUND(AVG({n}), 6) AS {n}" for n in names)
    return f"""
WITH base AS (
  SELECT team, name, surname, role, season, round_no,
         {counts},
         COALESCE(voto - 6.0, 0.0) AS voto,
         COALESCE(fantavoto - 6.0, 0.0) AS fantavoto,
         CASE WHEN voto IS NOT NULL THEN 1.0 ELSE 0.0 END AS presenza
  FROM player_match
), rolled AS (
  SELECT {keys}, {", ".join(exprs)}
  FROM base
  WINDOW {windows}
)
SELECT {keys}, {outs} FROM rolled GROUP BY {keys}
"""


def _q01() -> str:
    return with_views(_q01_body(), "player_match")


def _q03_body() -> str:
    return """
WITH sk AS (SELECT DISTINCT name, surname, season FROM player_match),
grid AS (SELECT name, surname, season, CAST(unnest(range(1, 39)) AS INT) AS round_no FROM sk),
j AS (
  SELECT g.name, g.surname, g.season, g.round_no, p.team, p.fantavoto
  FROM grid g LEFT JOIN player_match p
    ON g.name = p.name AND g.surname = p.surname AND g.season = p.season AND g.round_no = p.round_no
)
SELECT season, round_no,
  COALESCE(
    last_value(team IGNORE NULLS) OVER (PARTITION BY name, surname, season ORDER BY round_no
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(team IGNORE NULLS) OVER (PARTITION BY name, surname, season ORDER BY round_no
                                         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS team,
  name, surname,
  lead(fantavoto) OVER (PARTITION BY name, surname, season ORDER BY round_no) AS fwd_fantavoto
FROM j"""


_STATS_PARSED = """
, parsed AS (
  SELECT fixture_id, fixture_stat,
         TRY_CAST(replace(home, '%', '') AS DOUBLE) AS home,
         TRY_CAST(replace(away, '%', '') AS DOUBLE) AS away
  FROM fixture_stats
), counted AS (
  SELECT *, count(home) OVER (PARTITION BY fixture_id, fixture_stat) AS n FROM parsed
), collapsed AS (
  SELECT fixture_id, fixture_stat, home, away FROM counted WHERE n <= 1
  UNION ALL
  SELECT fixture_id, fixture_stat, max(home) AS home, max(away) AS away
  FROM counted WHERE n > 1 GROUP BY fixture_id, fixture_stat
)"""

_GOALS = """
, goals_long AS (
  SELECT fixture_id, 'home' AS team_side, 'ht_goal' AS fixture_stat, CAST(home_ht_goal AS DOUBLE) AS v FROM fixture_master
  UNION ALL SELECT fixture_id, 'away', 'ht_goal', CAST(away_ht_goal AS DOUBLE) FROM fixture_master
  UNION ALL SELECT fixture_id, 'home', 'ft_goal', CAST(home_ft_goal AS DOUBLE) FROM fixture_master
  UNION ALL SELECT fixture_id, 'away', 'ft_goal', CAST(away_ft_goal AS DOUBLE) FROM fixture_master
), goals AS (
  SELECT fixture_id, fixture_stat,
         AVG(CASE WHEN team_side = 'away' THEN v END) AS away,
         AVG(CASE WHEN team_side = 'home' THEN v END) AS home
  FROM goals_long GROUP BY fixture_id, fixture_stat
)"""


def _team_feat_ctes() -> str:
    stats = ["Ball Possession", "Fouls", "Shots on Goal"]
    goals = ["ht_goal", "ft_goal"]
    outs = []
    for s in stats:
        base = s.replace(" ", "_").lower()
        for k in ("m3", "m7", "sd10"):
            outs.append(f"ROUND(AVG(CASE WHEN fixture_stat = '{s}' THEN {k} END), 6) AS {base}_{k}")
    for s in goals:
        for k in ("s3", "s7"):
            outs.append(f"ROUND(AVG(CASE WHEN fixture_stat = '{s}' THEN {k} END), 6) AS {s}_{k}")
    part = "PARTITION BY team_id, team_name, fixture_stat ORDER BY league_id, event_date, fixture_id"
    return (
        _STATS_PARSED
        + _GOALS
        + f"""
, combo AS (
  SELECT DISTINCT s.fixture_id, m.event_date, m.league_id, m.home_team_id, m.home_team_name,
         m.away_team_id, m.away_team_name, s.fixture_stat, s.home, s.away
  FROM (SELECT fixture_id, fixture_stat, home, away FROM collapsed
        UNION ALL SELECT fixture_id, fixture_stat, home, away FROM goals) s
  JOIN fixture_master m ON s.fixture_id = m.fixture_id
), team_rows AS (
  SELECT DISTINCT * FROM (
    SELECT fixture_id, event_date, league_id, fixture_stat, home_team_id AS team_id, home_team_name AS team_name, home AS val FROM combo
    UNION ALL
    SELECT fixture_id, event_date, league_id, fixture_stat, away_team_id, away_team_name, away FROM combo)
), cut AS (
  SELECT fixture_id, event_date, league_id, team_id, team_name, fixture_stat, COALESCE(val, 0.0) AS val
  FROM team_rows WHERE event_date <= TIMESTAMP '2024-02-01 00:00:00'
), rolled AS (
  SELECT *,
    CASE WHEN count(val) OVER w3 >= 2 THEN avg(val) OVER w3 END AS m3,
    CASE WHEN count(val) OVER w7 >= 2 THEN avg(val) OVER w7 END AS m7,
    CASE WHEN count(val) OVER w10 >= 2 THEN stddev_samp(val) OVER w10 END AS sd10,
    CASE WHEN count(val) OVER w3 >= 2 THEN sum(val) OVER w3 END AS s3,
    CASE WHEN count(val) OVER w7 >= 2 THEN sum(val) OVER w7 END AS s7
  FROM cut
  WINDOW w3 AS ({part} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
         w7 AS ({part} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
         w10 AS ({part} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)
), wide AS (
  SELECT team_id, team_name, event_date, fixture_id, league_id, {", ".join(outs)}
  FROM rolled GROUP BY team_id, team_name, event_date, fixture_id, league_id
), team_feat AS (
  SELECT w.*, c.round_no
  FROM wide w LEFT JOIN (SELECT DISTINCT league_id, fixture_id, round_no FROM calendar) c
    ON w.league_id = c.league_id AND w.fixture_id = c.fixture_id
)"""
    )


_TEAM_VIEWS = ("fixture_stats", "fixture_master", "calendar")


def _q07() -> str:
    return with_views(_team_feat_ctes() + "\nSELECT * FROM team_feat", *_TEAM_VIEWS)


def _team_opp_ctes() -> str:
    from matchday.plans.queries import TEAM_FEATURES as tf

    feats = ", ".join(tf)
    op_sel = ", ".join(f"{c} AS op_{c}" for c in tf)
    op_cols = ", ".join("op_" + c for c in tf)
    return _team_feat_ctes() + f"""
, tfs AS (
  SELECT t.*, s.season FROM team_feat t JOIN league_season s ON t.league_id = s.league_id
  WHERE EXISTS (SELECT 1 FROM fixture_master m WHERE m.league_id = t.league_id AND m.fixture_id = t.fixture_id)
), sched AS (
  SELECT fixture_id, league_id, event_date, season, home_team_id AS core_team_id, away_team_id AS opponent_team_id
  FROM fixture_master f JOIN league_season s USING (league_id)
  UNION ALL
  SELECT fixture_id, league_id, event_date, season, away_team_id, home_team_id
  FROM fixture_master f JOIN league_season s USING (league_id)
), sched_f AS (
  SELECT * FROM sched x WHERE EXISTS (SELECT 1 FROM tfs t WHERE t.team_id = x.core_team_id
                                      AND t.league_id = x.league_id AND t.fixture_id = x.fixture_id)
), nxt AS (
  SELECT core_team_id AS team_id, league_id, fixture_id,
         lead(opponent_team_id) OVER (PARTITION BY core_team_id, season ORDER BY league_id, event_date, fixture_id) AS opponent_id
  FROM sched_f
), tfn AS (
  SELECT t.*, n.opponent_id FROM tfs t LEFT JOIN nxt n
    ON t.team_id = n.team_id AND t.league_id = n.league_id AND t.fixture_id = n.fixture_id
), opp AS (
  SELECT team_id AS opp_team_id, league_id AS opp_league_id, season AS opp_season, round_no AS opp_round_no, {op_sel}
  FROM (SELECT *, row_number() OVER (PARTITION BY team_id, league_id, season, round_no
                                     ORDER BY event_date DESC, fixture_id DESC) AS rk FROM tfn) z
  WHERE rk = 1
), team_opp AS (
  SELECT t.team_id, m.team_marks AS team_name, t.event_date, t.fixture_id, t.league_id, t.season, t.round_no,
         t.opponent_id, {", ".join("t." + c for c in tf)}, {op_cols}
  FROM tfn t
  LEFT JOIN opp o ON t.opponent_id = o.opp_team_id AND t.league_id = o.opp_league_id
                 AND t.season = o.opp_season AND t.round_no = o.opp_round_no
  JOIN team_map m ON t.team_name = m.team_name
)"""


_OPP_VIEWS = _TEAM_VIEWS + ("league_season", "team_map")


def _q11() -> str:
    from matchday.plans.queries import TEAM_FEATURES as tf

    cols = ", ".join([*tf, *["op_" + c for c in tf]])
    rounded = ", ".join(f"ROUND({c}, 6) AS {c}" for c in [*tf, *["op_" + c for c in tf]])
    del cols
    return with_views(
        _team_opp_ctes()
        + f"""
SELECT team_id, team_name, event_date, fixture_id, league_id, season, round_no, opponent_id, {rounded}
FROM team_opp""",
        *_OPP_VIEWS,
    )


def _training_cols() -> list[str]:
    from matchday.plans.queries import PLAYER_FEATURES as pfs, TEAM_FEATURES as tf

    return ["name", "surname", "season", "round_no", "role", "fwd_fantavoto", "fwd_fv_scaled",
            *pfs, *tf, *["op_" + c for c in tf]]


_DUMMIES = ["role_A", "role_C", "role_D", "role_P"]


def _training_ctes() -> str:
    """CTE chain ending in ``ts``: the unrounded training table."""
    from matchday.plans.queries import PLAYER_FEATURES as pfs, TEAM_FEATURES as tf

    tcols = [*tf, *["op_" + c for c in tf]]
    pw = "PARTITION BY name, surname, season ORDER BY round_no"
    pfill = ", ".join(
        f"last_value({c} IGNORE NULLS) OVER ({pw} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
        for c in pfs
    )
    tw = "PARTITION BY team, season ORDER BY round_no"
    tfill = ", ".join(
        f"CASE WHEN team IS NOT NULL THEN last_value({c} IGNORE NULLS) OVER ({tw} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS {c}"
        for c in tcols
    )
    return _team_opp_ctes() + f"""
, pf AS ({_q01_body()}), tgt AS ({_q03_body()}),
t AS (SELECT DISTINCT name, surname, season, round_no, team, fwd_fantavoto, fwd_fantavoto - 6.0 AS fwd_fv_scaled FROM tgt),
j1 AS (
  SELECT t.*, pf.role, {", ".join("pf." + c for c in pfs)}
  FROM t LEFT JOIN pf ON t.name IS NOT DISTINCT FROM pf.name AND t.surname IS NOT DISTINCT FROM pf.surname
                     AND t.season = pf.season AND t.round_no = pf.round_no
), j2 AS (
  SELECT name, surname, season, round_no, team, fwd_fantavoto, fwd_fv_scaled,
    COALESCE(last_value(role IGNORE NULLS) OVER ({pw} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             first_value(role IGNORE NULLS) OVER ({pw} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS role,
    {pfill}
  FROM j1
), tr AS (
  SELECT team_name, season, round_no, {", ".join(tcols)} FROM (
    SELECT *, row_number() OVER (PARTITION BY team_name, season, round_no ORDER BY event_date DESC, fixture_id DESC) AS rk
    FROM team_opp) z WHERE rk = 1
), j3 AS (
  SELECT j2.*, {", ".join("tr." + c for c in tcols)}
  FROM j2 LEFT JOIN tr ON j2.team = tr.team_name AND j2.season = tr.season AND j2.round_no = tr.round_no
), j4 AS (
  SELECT name, surname, season, round_no, role, fwd_fantavoto, fwd_fv_scaled, {", ".join(pfs)}, {tfill}
  FROM j3
), ts AS (SELECT * FROM j4)"""


_TRAIN_VIEWS = _OPP_VIEWS + ("player_match",)


def _rounded(cols, doubles) -> str:
    return ", ".join(f"ROUND({c}, 6) AS {c}" if c in doubles else c for c in cols)


def _q12() -> str:
    cols = _training_cols()
    doubles = set(cols[5:])
    dummies = ", ".join(f"CAST(role = '{d[-1]}' AS DOUBLE) AS {d}" for d in _DUMMIES)
    return with_views(_training_ctes() + f"\nSELECT {_rounded(cols, doubles)}, {dummies} FROM ts", *_TRAIN_VIEWS)


def _q13() -> str:
    cols = _training_cols()
    keep = ["name", "surname", "season", "round_no", "fwd_fantavoto", "fwd_fv_scaled"]
    avgs = ", ".join(f'AVG(CASE WHEN "{c}" IS NULL THEN 1.0 ELSE 0.0 END) AS "{c}"' for c in cols)
    keep_list = ", ".join(f"'{c}'" for c in keep)
    return with_views(
        _training_ctes()
        + f"""
, shares AS (
  UNPIVOT (SELECT {avgs} FROM ts) ON COLUMNS(*) INTO NAME column_name VALUE null_share
)
SELECT column_name, ROUND(null_share, 6) AS null_share,
       (null_share > 0.25 AND column_name NOT IN ({keep_list})) AS dropped
FROM shares""",
        *_TRAIN_VIEWS,
    )


def _pruned_ctes() -> str:
    """``rs``: the training rows with the share of NULL fields among the
    columns whose own NULL share is at most 0.25 (keys and targets always)."""
    cols = _training_cols()
    always = {"name", "surname", "season", "round_no", "role", "fwd_fantavoto", "fwd_fv_scaled"}
    flags = ", ".join(
        "1" + f' AS "k_{c}"' if c in always
        else f'CAST(AVG(CASE WHEN "{c}" IS NULL THEN 1.0 ELSE 0.0 END) <= 0.25 AS INT) AS "k_{c}"' for c in cols
    )
    nulls = " + ".join(f'CAST("{c}" IS NULL AS INT) * "k_{c}"' for c in cols)
    total = " + ".join(f'"k_{c}"' for c in cols)
    return _training_ctes() + f"""
, kept_cols AS (SELECT {flags} FROM ts),
rs AS (SELECT ts.*, ({nulls}) / CAST(({total}) AS DOUBLE) AS row_null_share FROM ts, kept_cols)"""


def _q14() -> str:
    return with_views(
        _pruned_ctes()
        + """
SELECT name, surname, season, round_no, ROUND(fwd_fv_scaled, 6) AS fwd_fv_scaled,
       ROUND(row_null_share, 6) AS row_null_share
FROM rs WHERE row_null_share <= 0.3""",
        *_TRAIN_VIEWS,
    )


def _bin_case(v: str) -> tuple[str, str, str]:
    from matchday.functions.bins import BIN_EDGES, CLASS_WEIGHTS

    pairs = list(zip(BIN_EDGES[:-1], BIN_EDGES[1:]))
    b = "CASE " + " ".join(f"WHEN {v} >= {lo} AND {v} < {hi} THEN CAST({lo} AS DOUBLE)" for lo, hi in pairs) + " END"
    code = "CASE fv_bin " + " ".join(f"WHEN {lo} THEN {i}" for i, (lo, _) in enumerate(pairs)) + " END"
    w = "CASE fv_bin " + " ".join(f"WHEN {lo} THEN CAST({wt} AS DOUBLE)" for (lo, _), wt in zip(pairs, CLASS_WEIGHTS)) + " END"
    return b, code, w


def _labelled_ctes(pruned: bool = False) -> str:
    b, code, w = _bin_case("fwd_fv_scaled")
    rows = "(SELECT * FROM rs WHERE row_null_share <= 0.3)" if pruned else "ts"
    return (_pruned_ctes() if pruned else _training_ctes()) + f"""
, lb0 AS (
  SELECT *, {b} AS fv_bin,
         CAST(substr(surname, 2, 20) AS BIGINT) * 10000 + (season % 100) * 100 + round_no AS row_id
  FROM {rows} WHERE fwd_fv_scaled IS NOT NULL
), lb AS (SELECT *, {code} AS label, {w} AS weight FROM lb0)"""


def _bins_values() -> str:
    from matchday.functions.bins import BIN_EDGES, CLASS_WEIGHTS

    rows = ", ".join(
        f"(CAST({lo} AS DOUBLE), CAST({hi} AS DOUBLE), {i}, CAST({wt} AS DOUBLE))"
        for i, (lo, hi, wt) in enumerate(zip(BIN_EDGES[:-1], BIN_EDGES[1:], CLASS_WEIGHTS))
    )
    return f"(VALUES {rows}) AS b(fv_bin, bin_upper, code, weight)"


_SPLIT = """
, hs AS (SELECT name, surname, season, round_no, row_id, role, fv_bin,
                CAST((CAST(row_id AS HUGEINT) * 2654435761 + {seed}) % 4294967296 AS BIGINT) AS h FROM lb),
rk AS (SELECT *, row_number() OVER (PARTITION BY fv_bin, role ORDER BY h, row_id) AS r,
              count(*) OVER (PARTITION BY fv_bin, role) AS n FROM hs),
sp AS (SELECT name, surname, season, round_no, row_id, role, fv_bin,
              CASE WHEN r <= (n + 4) // 5 THEN 'test' ELSE 'train' END AS split FROM rk)"""


def _pairs() -> str:
    return "\n, pairs AS (SELECT vec_id, label AS truth, CAST(vec_id % 10 AS INT) AS pred FROM embeddings)"


_PER_CLASS = """
, conf AS (SELECT truth, pred, count(*) AS n FROM pairs GROUP BY truth, pred),
t AS (SELECT truth AS label, sum(n) AS support, sum(CASE WHEN truth = pred THEN n ELSE 0 END) AS tp FROM conf GROUP BY truth),
p AS (SELECT pred AS label, sum(n) AS predicted FROM conf GROUP BY pred),
pc AS (SELECT COALESCE(t.label, p.label) AS label, COALESCE(tp, 0) AS tp, COALESCE(support, 0) AS support,
              COALESCE(predicted, 0) AS predicted
       FROM t FULL OUTER JOIN p ON t.label = p.label)"""


_AMENDED = """
, landing AS (
  SELECT fixture_id, league_id,
         CASE WHEN round_no % 2 = 0 AND status_short = 'PST' THEN event_date + INTERVAL 7 DAY ELSE event_date END AS event_date,
         CASE WHEN round_no % 2 = 0 AND status_short = 'PST' THEN round_no + 1 ELSE round_no END AS round_no,
         CASE WHEN round_no % 2 = 0 AND status_short = 'NS' THEN 'FT'
              WHEN round_no % 2 = 0 AND status_short = 'PST' THEN 'NS' ELSE status_short END AS status_short
  FROM calendar
), amended AS (
  SELECT fixture_id, league_id, event_date, round_no, status_short FROM calendar
  UNION
  SELECT fixture_id, league_id, event_date, round_no, status_short FROM landing
)"""


_HTML = r"""
WITH pl AS (SELECT page_id, regexp_extract_all(html, '(?s)<ul>(.*?)</ul>', 1) AS lists FROM pages),
l AS (SELECT page_id, unnest(lists) AS body, unnest(range(len(lists))) AS list_pos FROM pl),
it AS (
  SELECT page_id, CAST(list_pos AS INT) AS list_pos,
         unnest(regexp_extract_all(body, '<li><a href="([^"]*)">([^<]*)</a></li>', 1)) AS href,
         unnest(regexp_extract_all(body, '<li><a href="([^"]*)">([^<]*)</a></li>', 2)) AS text,
         unnest(range(len(regexp_extract_all(body, '<li><a href="([^"]*)">([^<]*)</a></li>', 1)))) AS item_pos
  FROM l
), tk AS (
  SELECT *, regexp_split_to_array(trim(text), ' +') AS toks,
         regexp_replace(text, '[

	 ]', '', 'g') AS stripped
  FROM it
)
SELECT page_id, list_pos, CAST(item_pos AS INT) AS item_pos, href, text,
       CASE WHEN len(toks) <= 1 THEN '' ELSE toks[1] END AS name,
       CASE WHEN len(toks) <= 1 THEN toks[1] ELSE array_to_string(toks[2:], ' ') END AS surname,
       CASE WHEN stripped IN ('-', '') THEN NULL
            WHEN regexp_full_match(stripped, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)') THEN TRY_CAST(stripped AS DOUBLE)
       END AS value
FROM tk"""


def oracle_sql() -> dict[str, str]:
    out = _base_sql()
    out["q29b_stream_calendar"] = out["q08_calendar_stale_drop"]
    out["q29c_stream_statistics"] = out["q04_stat_collapse"]
    out["q26b_team_worklist"] = with_views(
        f"""
, teams AS (SELECT league_id, CAST(home_team_id AS BIGINT) AS team_id FROM fixture
            UNION SELECT league_id, CAST(away_team_id AS BIGINT) FROM fixture),
pt AS (SELECT * FROM teams t WHERE NOT EXISTS (SELECT 1 FROM fixture f
         WHERE f.status_short = 'FT' AND f.league_id = t.league_id AND f.home_team_id = t.team_id)),
w AS ({out["q09_last_round"]}),
g AS (SELECT league_id, CAST(unnest(range(1, 39)) AS INT) AS round_no FROM (SELECT DISTINCT league_id FROM calendar)),
pr AS (SELECT g.* FROM g, w WHERE round_no >= start_round AND round_no < final_round)
SELECT 'team' AS kind, league_id, team_id, CAST(NULL AS INT) AS round_no,
       'leagueid-' || league_id || '_teamid-' || team_id || '_.json' AS file_name,
       'https://api.example.invalid/v2/fixtures/team/' || team_id || '/' || league_id AS url FROM pt
UNION ALL
SELECT 'round', league_id, CAST(NULL AS BIGINT), round_no, 'leagueid-' || league_id || '_round-' || round_no || '_.json',
       'https://api.example.invalid/v2/fixtures/league/' || league_id || '/round/' || round_no FROM pr""",
        "fixture",
        "calendar",
    )
    out["q10b_names_to_review"] = (
        f"SELECT DISTINCT name, surname FROM ({out['q10_name_fix']}) fixed WHERE len(string_split(surname, ' ')) > 1"
    )
    return out


_CELLS = (
    "voto", "gol", "assist", "rigore", "rig_sbagliato", "autogol", "ammonizione", "espulsione", "fantavoto"
)


def _base_sql() -> dict[str, str]:
    return {
        "q01_player_features": _q01(),
        "q02_player_master": with_views(
            """
SELECT team, name, surname, role, min(season) AS season_min, max(season) AS season_max,
       min(round_no) AS match_min, max(round_no) AS match_max
FROM player_match GROUP BY team, name, surname, role""",
            "player_match",
        ),
        "q03_player_target": with_views(_q03_body(), "player_match"),
        "q04_stat_collapse": with_views(
            _STATS_PARSED + "\nSELECT * FROM collapsed", "fixture_stats"
        ),
        "q05_goals_unpivot_pivot": with_views(
            _GOALS + "\nSELECT fixture_id, fixture_stat, ROUND(away, 6) AS away, ROUND(home, 6) AS home FROM goals",
            "fixture_master",
        ),
        "q06_team_schedule": with_views(
            """
, m AS (SELECT f.*, s.season FROM fixture_master f JOIN league_season s ON f.league_id = s.league_id),
rows AS (
  SELECT fixture_id, league_id, event_date, season, home_team_id AS core_team_id,
         away_team_id AS opponent_team_id, 'core' AS play_home FROM m
  UNION ALL
  SELECT fixture_id, league_id, event_date, season, away_team_id, home_team_id, 'oppo' FROM m
)
SELECT *, lead(opponent_team_id) OVER (PARTITION BY core_team_id, season
                                       ORDER BY league_id, event_date, fixture_id) AS next_opponent
FROM rows""",
            "fixture_master",
            "league_season",
        ),
        "q07_team_features": _q07(),
        "q08_calendar_stale_drop": with_views(
            _AMENDED
            + """
SELECT fixture_id, league_id, event_date, round_no, status_short FROM (
  SELECT *, count(status_short) OVER (PARTITION BY fixture_id, league_id) AS n FROM amended
) x WHERE NOT (n > 1 AND status_short = 'NS')""",
            "calendar",
        ),
        "q09_last_round": with_views(
            """
, firsts AS (SELECT league_id, min(event_date) AS first_date FROM calendar GROUP BY league_id),
recent AS (SELECT league_id FROM firsts WHERE first_date = (SELECT max(first_date) FROM firsts)),
status_counts AS (
  SELECT round_no, status_short, count(*) AS obs FROM calendar
  WHERE league_id IN (SELECT league_id FROM recent) AND status_short IS NOT NULL
  GROUP BY round_no, status_short
), shares AS (
  SELECT *, obs / sum(obs) OVER (PARTITION BY round_no) AS pct FROM status_counts
), last AS (
  SELECT max(CASE WHEN status_short = 'FT' AND pct > 0.5 THEN round_no END) AS last_round,
         count(DISTINCT round_no) AS rounds_seen
  FROM shares
)
SELECT last_round,
       CASE WHEN last_round >= 3 THEN last_round - 2 ELSE 1 END AS start_round,
       CASE WHEN last_round <= 36 THEN last_round + 2 ELSE 39 END AS final_round,
       rounds_seen
FROM last""",
            "calendar",
        ),
        "q11_opponent_join": _q11(),
        "q12_training_set": _q12(),
        "q13_sparse_columns": _q13(),
        "q14_sparse_rows": _q14(),
        "q15_bins": with_views(
            _labelled_ctes()
            + """
SELECT name, surname, season, round_no, role, ROUND(fwd_fv_scaled, 6) AS fwd_fv_scaled, fv_bin, label, weight
FROM lb""",
            *_TRAIN_VIEWS,
        ),
        "q16_class_weights": with_views(
            _labelled_ctes()
            + f"""
, cnt AS (SELECT fv_bin, count(*) AS n_rows FROM lb GROUP BY fv_bin)
SELECT b.fv_bin, b.bin_upper, b.code, b.weight, COALESCE(cnt.n_rows, 0) AS n_rows
FROM {_bins_values()} LEFT JOIN cnt ON b.fv_bin = cnt.fv_bin""",
            *_TRAIN_VIEWS,
        ),
        "q17_stratified_split": with_views(
            _labelled_ctes() + _SPLIT.format(seed=1298) + "\nSELECT * FROM sp", *_TRAIN_VIEWS
        ),
        "q18_folds": with_views(
            _labelled_ctes()
            + _SPLIT.format(seed=1298)
            + """
, trn AS (SELECT name, surname, season, round_no, row_id, role, fv_bin,
                CAST((CAST(row_id AS HUGEINT) * 2654435761 + 1299) % 4294967296 AS BIGINT) AS h FROM sp WHERE split = 'train'),
fr AS (SELECT *, row_number() OVER (PARTITION BY fv_bin ORDER BY h, row_id) AS r FROM trn)
SELECT name, surname, season, round_no, row_id, role, fv_bin, CAST((r - 1) % 5 AS INT) AS fold FROM fr""",
            *_TRAIN_VIEWS,
        ),
        "q24_html_extract": _HTML,
        "q24b_html_extract_parser": _HTML,
        "q25_json_unpack": """
SELECT event_id, user_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
        "q26_worklist": with_views(
            """
, grid AS (SELECT DISTINCT league_id FROM calendar),
g AS (SELECT league_id, CAST(unnest(range(1, 39)) AS INT) AS round_no FROM grid),
pr AS (SELECT * FROM g WHERE NOT EXISTS (
         SELECT 1 FROM calendar c WHERE c.league_id = g.league_id AND c.round_no = g.round_no)),
ps AS (SELECT DISTINCT fixture_id, league_id FROM fixture_master m WHERE NOT EXISTS (
         SELECT 1 FROM fixture_stats s WHERE s.fixture_id = m.fixture_id)),
work AS (
  SELECT 'calendar' AS kind, league_id, round_no, CAST(NULL AS BIGINT) AS fixture_id,
         'leagueid-' || league_id || '_round-' || round_no || '_.json' AS file_name,
         'https://api.example.invalid/v2/fixtures/league/' || league_id || '/round/' || round_no AS url
  FROM pr
  UNION ALL
  SELECT 'stats', league_id, CAST(NULL AS INT), fixture_id, 'fixtureid-' || fixture_id || '_.json',
         'https://api.example.invalid/v2/statistics/fixture/' || fixture_id
  FROM ps
)
SELECT * FROM work ORDER BY kind, league_id, COALESCE(round_no, 0), COALESCE(fixture_id, 0) LIMIT 100""",
            "calendar",
            "fixture_master",
            "fixture_stats",
        ),
        "q27_time_normalise": """
SELECT event_id,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_utc,
       strftime(timezone('Europe/London', timezone('UTC', ts)), '%Y-%m-%d %H:%M:%S') AS ts_london,
       CAST(floor(epoch(ts)) AS BIGINT) AS unix_s,
       strftime(ts + INTERVAL 5 DAY, '%Y-%m-%d %H:%M:%S') AS cutoff_utc
FROM events""",
        "q16b_class_count": with_views(
            _labelled_ctes() + "\nSELECT count(DISTINCT label) AS n_classes FROM lb", *_TRAIN_VIEWS
        ),
        "q28d_labelled_split": with_views(
            _labelled_ctes(pruned=True)
            + _SPLIT.format(seed=1298)
            + """
SELECT sp.name, sp.surname, sp.season, sp.round_no, lb.label, sp.split FROM sp JOIN lb
  ON sp.row_id = lb.row_id AND sp.name IS NOT DISTINCT FROM lb.name AND sp.surname IS NOT DISTINCT FROM lb.surname
WHERE lb.label IS NOT NULL""",
            *_TRAIN_VIEWS,
        ),
        "q28e_label_codes": with_views(
            _labelled_ctes(pruned=True)
            + _SPLIT.format(seed=1298)
            + """
SELECT sp.name, sp.surname, sp.season, sp.round_no, lb.fv_bin, sp.split,
       CAST(dense_rank() OVER (ORDER BY lb.fv_bin) - 1 AS INT) AS label
FROM sp JOIN lb
  ON sp.row_id = lb.row_id AND sp.name IS NOT DISTINCT FROM lb.name AND sp.surname IS NOT DISTINCT FROM lb.surname
WHERE lb.label IS NOT NULL AND lb.fv_bin <> 0.0""",
            *_TRAIN_VIEWS,
        ),
        "q07c_quality_gate": with_views(
            _team_feat_ctes()
            + """
SELECT team_id, team_name, event_date, fixture_id, league_id, fixture_stat, CAST(2 * count(*) AS BIGINT) AS n_rows
FROM cut WHERE fixture_id % 5 = 0 GROUP BY team_id, team_name, event_date, fixture_id, league_id, fixture_stat""",
            "calendar",
            "fixture_master",
            "fixture_stats",
        ),
        "q38_stream_features": _q01(),
        "q39_stream_dedup": """
WITH b AS (SELECT min(ts) AS a, max(ts) AS z FROM events),
d AS (SELECT e.event_id, e.user_id, e.event_type, e.ts, b.z FROM events e, b),
m AS (SELECT a + (z - a) / 2 AS mid, z FROM b)
SELECT event_id, user_id, event_type, ts FROM d
UNION ALL
-- given again with a time beyond the watermark, after the key's state is gone
SELECT event_id, user_id, event_type, d.z + INTERVAL 1 DAY FROM d, m
WHERE ts < mid AND event_id % 5 = 0 AND ts + INTERVAL 2 DAY <= d.z - INTERVAL 2 DAY""",
        "q40_stat_files": with_views(
            """
SELECT DISTINCT fixture_id, fixture_stat, home, away FROM fixture_stats
WHERE fixture_id IN (SELECT fixture_id FROM fixture_master)""",
            "fixture_stats", "fixture_master",
        ),
        "q41_stat_envelopes": with_views(
            """
SELECT fixture_id, fixture_stat, max(home) AS home, max(away) AS away FROM fixture_stats
WHERE fixture_id % 7 <> 0 GROUP BY fixture_id, fixture_stat""",
            "fixture_stats",
        ),
        "q41b_search_envelopes": """
SELECT event_id, event_type AS name, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
WHERE event_type = 'click' AND event_id % 5 <> 0""",
        "q07b_duplicate_team_rows": with_views(
            _team_feat_ctes()
            + """
SELECT team_id, team_name, event_date, fixture_id, league_id, fixture_stat, count(*) AS n_rows
FROM cut GROUP BY ALL HAVING count(*) > 1""",
            "calendar",
            "fixture_master",
            "fixture_stats",
        ),
        "q18b_contiguous_folds": with_views(
            _labelled_ctes()
            + """
, o AS (SELECT name, surname, season, round_no, fv_bin,
               row_number() OVER (ORDER BY season, round_no, surname, name) - 1 AS k, count(*) OVER () AS n FROM lb)
SELECT name, surname, season, round_no, fv_bin,
       CAST(CASE WHEN k < (n % 5) * (n // 5 + 1) THEN k // (n // 5 + 1)
                 ELSE n % 5 + (k - (n % 5) * (n // 5 + 1)) // greatest(n // 5, 1) END AS INT) AS fold
FROM o""",
            *_TRAIN_VIEWS,
        ),
        "q32_round_csvs": with_views(
            f"""
SELECT DISTINCT team, name, surname, role, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _CELLS)},
       season, round_no AS "match"
FROM player_match""",
            "player_match",
        ),
        "q34_marks_pages": with_views(
            f"""
SELECT team, name, surname, role, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _CELLS)}
FROM player_match""",
            "player_match",
        ),
        "q33_fixture_files": with_views(
            """
, r AS (SELECT fixture_id, CAST(league_id AS BIGINT) AS league_id, event_date, status_short AS "statusShort",
  CAST(home_team_id AS BIGINT) AS home_team_id, 'team ' || home_team_id AS home_team_name,
  CAST(away_team_id AS BIGINT) AS away_team_id, 'team ' || away_team_id AS away_team_name,
  CASE WHEN fixture_id % 5 = 0 THEN 0 ELSE home_ht_goal END AS home_ht_goal,
  CASE WHEN fixture_id % 5 = 0 THEN 0 ELSE away_ht_goal END AS away_ht_goal,
  home_ft_goal, away_ft_goal
FROM fixture WHERE status_short = 'FT')
SELECT * FROM r WHERE league_id IN (SELECT league_id FROM r GROUP BY league_id HAVING count(*) >= 2)""",
            "fixture",
        ),
        "q33b_calendar_files": with_views(
            """
SELECT fixture_id, CAST(league_id AS BIGINT) AS league_id, event_date, round_no AS "match",
       CASE status_short WHEN 'FT' THEN 'Match Finished' ELSE 'Not Started' END AS status, status_short AS "statusShort"
FROM calendar""",
            "calendar",
        ),
        "q29_stream_upsert": """
SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rk
  FROM events) x WHERE rk = 1""",
        "q09b_fixtures_per_round": with_views(
            "SELECT league_id, round_no, count(*) AS n_fixtures FROM calendar GROUP BY league_id, round_no",
            "calendar",
        ),
        "q19_confusion": """
SELECT quality AS truth, toxic AS pred, count(*) AS n FROM labels GROUP BY quality, toxic""",
        "q20_class_report": "WITH x AS (SELECT 1)" + _pairs() + _PER_CLASS + """
, r AS (SELECT CAST(label AS VARCHAR) AS label,
               CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
               CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, support, tp FROM pc),
r2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1_score FROM r)
SELECT label, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall, ROUND(f1_score, 6) AS f1_score,
       CAST(support AS BIGINT) AS support FROM r2
UNION ALL SELECT 'accuracy', NULL, NULL, ROUND(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM r2
UNION ALL SELECT 'macro avg', ROUND(avg(precision), 6), ROUND(avg(recall), 6), ROUND(avg(f1_score), 6),
                 CAST(sum(support) AS BIGINT) FROM r2
UNION ALL SELECT 'weighted avg', ROUND(sum(precision * support) / sum(support), 6),
                 ROUND(sum(recall * support) / sum(support), 6), ROUND(sum(f1_score * support) / sum(support), 6),
                 CAST(sum(support) AS BIGINT) FROM r2""",
        "q21_mcc": "WITH x AS (SELECT 1)" + _pairs() + _PER_CLASS + """
, a AS (SELECT CAST(sum(support) AS DOUBLE) AS s, CAST(sum(tp) AS DOUBLE) AS c,
               CAST(sum(predicted * support) AS DOUBLE) AS pt, CAST(sum(predicted * predicted) AS DOUBLE) AS pp,
               CAST(sum(support * support) AS DOUBLE) AS tt,
               avg(CASE WHEN support > 0 THEN tp / support END) AS bal FROM pc)
SELECT CAST(s AS BIGINT) AS n, ROUND(c / s, 6) AS accuracy, ROUND(bal, 6) AS balanced_accuracy,
       ROUND(CASE WHEN (s * s - pp) * (s * s - tt) > 0 THEN (c * s - pt) / sqrt((s * s - pp) * (s * s - tt)) ELSE 0.0 END, 6) AS mcc
FROM a""",
        "q22_regression_metrics": with_views(
            """
, b AS (SELECT fantavoto AS y, fantavoto - voto AS e FROM player_match
        WHERE fantavoto IS NOT NULL AND voto IS NOT NULL)
SELECT count(*) AS n, ROUND(avg(e * e), 6) AS mse, ROUND(1 - var_pop(e) / var_pop(y), 6) AS explained_variance,
       ROUND(quantile_cont(abs(e), 0.5), 6) AS median_abs_error
FROM b""",
            "player_match",
        ),
        "q23_label_distribution": "WITH x AS (SELECT 1)" + _pairs() + """
SELECT label, CAST(sum(t) AS BIGINT) AS n_true, CAST(sum(p) AS BIGINT) AS n_pred FROM (
  SELECT truth AS label, 1 AS t, 0 AS p FROM pairs UNION ALL SELECT pred, 0, 1 FROM pairs
) u GROUP BY label""",
        "q10_name_fix": with_views(
            """
, master AS (
  SELECT team, name, surname, role, min(season) AS season_min, max(season) AS season_max,
         min(round_no) AS match_min, max(round_no) AS match_max,
         len(string_split(surname, ' ')) > 1 AS needs_review
  FROM player_match GROUP BY team, name, surname, role
)
SELECT m.team,
       CASE WHEN COALESCE(f.name_correct, f.surname_correct) IS NOT NULL THEN f.name_correct ELSE m.name END AS name,
       CASE WHEN COALESCE(f.name_correct, f.surname_correct) IS NOT NULL THEN f.surname_correct ELSE m.surname END AS surname,
       m.role, m.season_min, m.season_max, m.match_min, m.match_max, m.needs_review
FROM master m LEFT JOIN name_fix f
  ON m.name IS NOT DISTINCT FROM f.name AND m.surname IS NOT DISTINCT FROM f.surname""",
            "player_match",
            "name_fix",
        ),
    }
