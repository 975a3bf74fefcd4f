"""Oracle SQL (DuckDB dialect) for the registered queries.

Each statement recomputes its query independently from the raw test tables,
with the same fixture projection, explicit NULL ordering and explicit types
(DuckDB ``SUM`` is HUGEINT and ``ROW_NUMBER`` BIGINT, so both are cast).
Keys that only list catalog metadata or run the whole chain have no oracle.
"""

from __future__ import annotations

N = 20  # teams of the fixture (touchline.fixtures.N_TEAMS)

NESTED = "'football-data.org'"
FLAT = "'thesportsdb.com'"

M = f"""m AS (
  SELECT o_orderkey AS k,
         CAST(o_orderkey AS VARCHAR) AS match_id,
         CASE WHEN o_orderkey % 2 = 0 THEN 'C0' ELSE 'C1' END AS competition_id,
         o_orderdate AS utc_date,
         CASE o_orderstatus WHEN 'P' THEN 'scheduled' ELSE 'finished' END AS status,
         CAST(1 + o_orderkey % 38 AS INTEGER) AS matchday,
         CAST(o_custkey % {N} AS VARCHAR) AS home_team_id,
         'Team ' || CAST(o_custkey % {N} AS VARCHAR) AS home_team_name,
         CAST((o_custkey % {N} + 1 + o_orderkey % {N - 1}) % {N} AS VARCHAR) AS away_team_id,
         'Team ' || CAST((o_custkey % {N} + 1 + o_orderkey % {N - 1}) % {N} AS VARCHAR) AS away_team_name,
         CASE WHEN o_orderstatus = 'P' OR o_orderkey % 97 = 0 THEN NULL
              ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) % 5 AS INTEGER) END AS home_score,
         CASE WHEN o_orderstatus = 'P' OR o_orderkey % 97 = 0 THEN NULL
              ELSE CAST(CAST(floor(o_totalprice / 10) AS BIGINT) % 4 AS INTEGER) END AS away_score,
         CASE WHEN o_orderkey % 3 = 0 THEN {FLAT} ELSE {NESTED} END AS source
  FROM orders)"""

M_COLS = ("match_id, competition_id, utc_date, status, matchday, home_team_id, home_team_name, "
          "away_team_id, away_team_name, home_score, away_score, source")

DIRTY = f"""dm AS (
  SELECT CASE WHEN k % 101 = 0 THEN NULL ELSE match_id END AS match_id,
         competition_id, utc_date, status, matchday, home_team_id,
         CASE WHEN home_team_id = '3' AND k % 2 = 0 THEN 'Team 3 FC' ELSE home_team_name END AS home_team_name,
         away_team_id, away_team_name,
         CASE WHEN k % 103 = 0 AND home_score IS NOT NULL THEN -1 ELSE home_score END AS home_score,
         away_score, source
  FROM m)"""


def persp(src: str = "m", name: str = "pr") -> str:
    """Perspectives of finished matches with result and points."""
    return f"""{name}_p AS (
  SELECT match_id, competition_id, utc_date, home_team_id AS team_id, home_team_name AS team_name,
         away_team_id AS opponent_id, away_team_name AS opponent_name, 'home' AS venue,
         home_score AS goals_scored, away_score AS goals_conceded
  FROM {src} WHERE status = 'finished'
  UNION ALL
  SELECT match_id, competition_id, utc_date, away_team_id, away_team_name, home_team_id,
         home_team_name, 'away', away_score, home_score
  FROM {src} WHERE status = 'finished'),
{name} AS (
  SELECT *,
         CASE WHEN goals_scored > goals_conceded THEN 'W'
              WHEN goals_scored = goals_conceded THEN 'D' ELSE 'L' END AS result,
         CAST(CASE WHEN goals_scored > goals_conceded THEN 3
                   WHEN goals_scored = goals_conceded THEN 1 ELSE 0 END AS INTEGER) AS points
  FROM {name}_p)"""


ORDER = "utc_date ASC NULLS FIRST, match_id ASC NULLS FIRST"


def form(src: str = "pr", keep_unscored: bool = False, strict: bool = False, name: str = "tf") -> str:
    where = "" if keep_unscored else "WHERE goals_scored IS NOT NULL"
    op = ">" if strict else ">="
    return f"""{name}_w AS (
  SELECT *,
         ROUND(AVG(goals_scored) OVER w5, 2) AS goals_scored_rolling_avg_5,
         ROUND(AVG(goals_conceded) OVER w5, 2) AS goals_conceded_rolling_avg_5,
         CAST(SUM(points) OVER w5 AS BIGINT) AS points_last5
  FROM {src} {where}
  WINDOW w5 AS (PARTITION BY team_id ORDER BY {ORDER} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
{name} AS (
  SELECT *,
         CASE WHEN LAG(points_last5, 5) OVER w IS NULL THEN 'improving'
              WHEN points_last5 {op} LAG(points_last5, 5) OVER w THEN 'improving'
              ELSE 'declining' END AS form_trend
  FROM {name}_w
  WINDOW w AS (PARTITION BY team_id ORDER BY {ORDER}))"""


TF_COLS = ("match_id, competition_id, utc_date, team_id, team_name, opponent_id, opponent_name, "
           "venue, goals_scored, goals_conceded, result, points, goals_scored_rolling_avg_5, "
           "goals_conceded_rolling_avg_5, points_last5, form_trend")

GOLD_FORM = f"WITH {M},\n{persp()},\n{form(keep_unscored=True)}\n"
RESULTS_PY = f"""rp AS (
  SELECT match_id, competition_id, utc_date, matchday, home_team_id, home_team_name, away_team_id,
         away_team_name, home_score, away_score,
         CASE WHEN home_score > away_score THEN 'home_win'
              WHEN home_score < away_score THEN 'away_win' ELSE 'draw' END AS result, source
  FROM m WHERE status = 'finished')"""


def results_model(src: str = "m", name: str = "rs") -> str:
    return f"""{name} AS (
  SELECT match_id, competition_id, utc_date, matchday, home_team_id, home_team_name, away_team_id,
         away_team_name, home_score, away_score,
         CASE WHEN home_score > away_score THEN 'home_win'
              WHEN home_score = away_score THEN 'draw' ELSE 'away_win' END AS result
  FROM {src} WHERE status = 'finished' AND home_score IS NOT NULL AND away_score IS NOT NULL)"""


def _bigsum(expr: str) -> str:
    return f"CAST(COALESCE(SUM({expr}), 0) AS BIGINT)"


def _cnt(cond: str) -> str:
    return _bigsum(f"CASE WHEN {cond} THEN 1 ELSE 0 END")


STANDINGS_BODY = """
  SELECT {by},
         COUNT(*) AS played,
         CAST(SUM(CASE WHEN result = 'W' THEN 1 ELSE 0 END) AS BIGINT) AS won,
         CAST(SUM(CASE WHEN result = 'D' THEN 1 ELSE 0 END) AS BIGINT) AS drawn,
         CAST(SUM(CASE WHEN result = 'L' THEN 1 ELSE 0 END) AS BIGINT) AS lost,
         CAST(SUM(points) AS BIGINT) AS {pts},
         CAST(SUM(goals_scored) AS BIGINT) AS {gf},
         CAST(SUM(goals_conceded) AS BIGINT) AS {ga},
         CAST(SUM(goals_scored) - SUM(goals_conceded) AS BIGINT) AS {gd},
         CAST(ROW_NUMBER() OVER (ORDER BY SUM(points) DESC NULLS LAST,
                                 SUM(goals_scored) - SUM(goals_conceded) DESC NULLS LAST,
                                 SUM(goals_scored) DESC NULLS LAST, {by_order}) AS INTEGER) AS {pos}
  FROM {src} GROUP BY {by}"""


def standings(src: str, by: tuple[str, ...], names=("total_points", "goals_for", "goals_against",
                                                     "goal_difference", "position")) -> str:
    pts, gf, ga, gd, pos = names
    return STANDINGS_BODY.format(by=", ".join(by), by_order=", ".join(f"{c} ASC NULLS LAST" for c in by),
                                 pts=pts, gf=gf, ga=ga, gd=gd, pos=pos, src=src)


# ------------------------------------------------------------------ raw versions

VERSIONS = f"""mv AS (
  SELECT *, source AS src, 1 AS days, FALSE AS older, 0 AS md_add FROM m
  UNION ALL
  SELECT *, CASE WHEN k % 3 = 0 THEN {NESTED} ELSE {FLAT} END, 2, FALSE, 0 FROM m WHERE k % 5 = 0
  UNION ALL
  SELECT *, source, 0, TRUE, 0 FROM m WHERE k % 7 = 0
  UNION ALL
  SELECT *, source, 1, FALSE, 1 FROM m WHERE k % 23 = 0),
v AS (
  SELECT k, match_id, competition_id, utc_date,
         CASE WHEN older THEN 'scheduled' ELSE status END AS status,
         CAST(matchday + md_add AS INTEGER) AS matchday, matchday AS base_matchday,
         home_team_id, home_team_name, away_team_id, away_team_name,
         CASE WHEN older THEN NULL ELSE home_score END AS home_score,
         CASE WHEN older THEN NULL ELSE away_score END AS away_score,
         src AS source,
         TIMESTAMP '2024-01-13 00:00:00' + to_days(days) + to_seconds(k % 86400) AS ingested_ts
  FROM mv),
fl AS (
  SELECT match_id,
         CASE WHEN source = {NESTED} THEN (CASE WHEN k % 8 = 0 THEN 'PL' ELSE competition_id END)
              ELSE (CASE WHEN k % 4 = 0 THEN 'PL' ELSE competition_id END) END AS competition_id,
         CASE WHEN source = {FLAT} AND k % 13 = 0 THEN NULL ELSE utc_date END AS utc_date,
         CASE WHEN source = {NESTED}
                THEN (CASE WHEN status = 'scheduled' AND k % 29 = 0 THEN 'postponed' ELSE status END)
              ELSE (CASE WHEN status = 'finished' AND k % 31 = 0 THEN '1h'
                         WHEN status = 'scheduled' AND k % 29 = 0 THEN 'postponed'
                         ELSE status END) END AS status,
         matchday,
         CASE WHEN source = {NESTED} AND base_matchday % 2 = 1 THEN 'LEAGUE_STAGE'
              ELSE 'REGULAR_SEASON' END AS stage,
         CASE WHEN source = {NESTED} AND k % 13 = 0 THEN NULL ELSE home_team_id END AS home_team_id,
         home_team_name, away_team_id, away_team_name,
         CASE WHEN source = {FLAT} AND k % 19 = 0 THEN NULL ELSE home_score END AS home_score,
         away_score, ingested_ts AS ingested_at, source
  FROM v),
flq AS (
  SELECT *, CASE WHEN match_id IS NOT NULL AND home_team_id IS NOT NULL AND away_team_id IS NOT NULL
                      AND utc_date IS NOT NULL AND status IS NOT NULL THEN 'valid'
                 ELSE 'incomplete' END AS quality_flag
  FROM fl)"""

SILVER_COLS = ("match_id, competition_id, utc_date, status, matchday, stage, home_team_id, "
               "home_team_name, away_team_id, away_team_name, home_score, away_score, ingested_at, source")

SILVER_TIEBREAK = ", ".join(f"{c} ASC NULLS LAST" for c in (
    "competition_id", "utc_date", "status", "matchday", "stage", "home_team_id", "home_team_name",
    "away_team_id", "away_team_name", "home_score", "away_score", "source", "quality_flag"))

SILVER = f"""WITH {M},
{VERSIONS}
SELECT {SILVER_COLS}, quality_flag FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY match_id
                               ORDER BY ingested_at DESC NULLS LAST, {SILVER_TIEBREAK}) AS rn
  FROM flq) WHERE rn = 1"""

NESTED_JSON = """CAST(to_json(struct_pack(
    id := k,
    utcDate := strftime(utc_date, '%Y-%m-%dT%H:%M:%SZ'),
    status := CASE WHEN status = 'scheduled' AND k % 29 = 0 THEN 'POSTPONED' ELSE upper(status) END,
    matchday := matchday,
    stage := CASE WHEN base_matchday % 2 = 0 THEN NULL ELSE 'LEAGUE_STAGE' END,
    competition := struct_pack(code := CASE WHEN k % 8 = 0 THEN NULL ELSE competition_id END),
    homeTeam := struct_pack(id := CASE WHEN k % 13 = 0 THEN NULL ELSE CAST(home_team_id AS BIGINT) END,
                            name := home_team_name),
    awayTeam := struct_pack(id := CAST(away_team_id AS BIGINT), name := away_team_name),
    score := struct_pack(fullTime := struct_pack(home := home_score, away := away_score)),
    _metadata := struct_pack(ingested_at := strftime(ingested_ts, '%Y-%m-%dT%H:%M:%SZ'),
                             source := 'football-data.org',
                             competition_id := CASE WHEN k % 4 = 0 THEN NULL ELSE competition_id END))) AS VARCHAR)"""

FLAT_JSON = """CAST(to_json(struct_pack(
    idEvent := match_id,
    dateEvent := CASE WHEN k % 13 = 0 THEN NULL ELSE strftime(utc_date, '%Y-%m-%d') END,
    strTime := CASE WHEN k % 17 = 0 THEN NULL ELSE strftime(utc_date, '%H:%M:%S') END,
    strStatus := CASE WHEN status = 'finished' THEN (CASE WHEN k % 31 = 0 THEN '1H' ELSE 'Match Finished' END)
                      WHEN status = 'scheduled' THEN (CASE WHEN k % 29 = 0 THEN 'Match Postponed' ELSE 'Not Started' END)
                      ELSE status END,
    intRound := CAST(matchday AS VARCHAR),
    idHomeTeam := home_team_id, strHomeTeam := home_team_name,
    idAwayTeam := away_team_id, strAwayTeam := away_team_name,
    intHomeScore := CASE WHEN k % 19 = 0 THEN (CASE WHEN home_score IS NOT NULL THEN 'x' END)
                         ELSE CAST(home_score AS VARCHAR) END,
    intAwayScore := CAST(away_score AS VARCHAR),
    _metadata := struct_pack(ingested_at := strftime(ingested_ts, '%Y-%m-%dT%H:%M:%S.%f+00:00'),
                             source := 'thesportsdb.com',
                             competition_id := CASE WHEN k % 4 = 0 THEN NULL ELSE competition_id END))) AS VARCHAR)"""



def _standing(prefix: str, other: str, first: str) -> str:
    own, against = f"{prefix}_score", f"{other}_score"
    return f"""struct_pack(position := CASE WHEN {first} THEN 1 ELSE 2 END,
      team := struct_pack(id := CAST({prefix}_team_id AS BIGINT), name := {prefix}_team_name), playedGames := matchday,
      won := CAST({own} > {against} AS INTEGER), draw := CAST({own} = {against} AS INTEGER), lost := CAST({own} < {against} AS INTEGER),
      points := 3 * CAST({own} > {against} AS INTEGER) + CAST({own} = {against} AS INTEGER),
      goalsFor := {own}, goalsAgainst := {against}, goalDifference := {own} - {against})"""


def _standings_json() -> str:
    home = _standing("home", "away", "home_score >= away_score")
    away = _standing("away", "home", "away_score > home_score")
    scored = "home_score IS NOT NULL AND away_score IS NOT NULL"

    def table(kind, *rows):
        return f"struct_pack(type := '{kind}', \"table\" := CASE WHEN {scored} THEN [{', '.join(rows)}] ELSE [] END)"

    tables = ", ".join([table("TOTAL", home, away), table("HOME", home), table("AWAY", away)])
    return f"""CAST(to_json(struct_pack(standings := [{tables}],
    _metadata := struct_pack(ingested_at := strftime(TIMESTAMP '2024-01-15 00:00:00' + to_seconds(k % 86400), '%Y-%m-%dT%H:%M:%SZ'),
                             source := 'football-data.org', competition_id := competition_id))) AS VARCHAR)"""


# ------------------------------------------------------------------ standings documents

SD = """sd AS (
  SELECT *, TIMESTAMP '2024-01-15 00:00:00' + to_seconds(k % 86400) AS ingested_at FROM m
  WHERE home_score IS NOT NULL AND away_score IS NOT NULL),
fs AS (
  SELECT home_team_id AS team_id, home_team_name AS team_name,
         CAST(CASE WHEN home_score >= away_score THEN 1 ELSE 2 END AS INTEGER) AS position,
         matchday AS played_games,
         CAST(home_score > away_score AS INTEGER) AS won, CAST(home_score = away_score AS INTEGER) AS draw,
         CAST(home_score < away_score AS INTEGER) AS lost,
         CAST(3 * CAST(home_score > away_score AS INTEGER) + CAST(home_score = away_score AS INTEGER) AS INTEGER) AS points,
         home_score AS goals_for, away_score AS goals_against,
         CAST(home_score - away_score AS INTEGER) AS goal_difference, ingested_at
  FROM sd
  UNION ALL
  SELECT away_team_id, away_team_name,
         CAST(CASE WHEN away_score > home_score THEN 1 ELSE 2 END AS INTEGER),
         matchday,
         CAST(away_score > home_score AS INTEGER), CAST(away_score = home_score AS INTEGER),
         CAST(away_score < home_score AS INTEGER),
         CAST(3 * CAST(away_score > home_score AS INTEGER) + CAST(away_score = home_score AS INTEGER) AS INTEGER),
         away_score, home_score, CAST(away_score - home_score AS INTEGER), ingested_at
  FROM sd)"""

STANDINGS_LATEST = f"""WITH {M},
{SD}
SELECT team_id, team_name, position, played_games, won, draw, lost, points, goals_for, goals_against,
       goal_difference, ingested_at FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY team_id ORDER BY ingested_at DESC NULLS LAST,
      {", ".join(f"{c} ASC NULLS LAST" for c in ("team_name", "position", "played_games", "won", "draw",
                                                 "lost", "points", "goals_for", "goals_against",
                                                 "goal_difference"))}) AS rn
  FROM fs) WHERE rn = 1"""

# ------------------------------------------------------------------ messages

MSG = """msg AS (
  SELECT CASE event_type WHEN 'click' THEN 'x-matches' WHEN 'view' THEN 'x-standings' ELSE 'x-misc' END AS topic,
         CAST(event_id AS VARCHAR) AS key,
         CASE WHEN event_id % 50 = 0 THEN substring(props, 1, length(props) - 1)
              WHEN event_id % 50 = 25 THEN CAST(event_id % 10 AS VARCHAR)
              ELSE props END AS value,
         ts AS timestamp
  FROM events)"""

LANDED = f"""WITH {MSG}
SELECT CASE WHEN topic LIKE '%matches%' THEN 'matches' WHEN topic LIKE '%standings%' THEN 'standings'
            ELSE 'other' END AS kind,
       CAST(timestamp AS DATE) AS date, value
FROM msg WHERE json_valid(value)"""

LINEITEM_LATEST = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, l_shipdate FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
               l_extendedprice DESC NULLS LAST, l_quantity ASC NULLS LAST, l_discount ASC NULLS LAST,
               l_tax ASC NULLS LAST, l_returnflag ASC NULLS LAST, l_linestatus ASC NULLS LAST) AS rn
  FROM lineitem) WHERE rn = 1"""

# ------------------------------------------------------------------ snapshots


def _snap_ledger(src: str) -> str:
    return f"""yc AS (SELECT year(utc_date) AS y, COUNT(*) AS n FROM {src} WHERE utc_date IS NOT NULL GROUP BY 1),
cum AS (SELECT y, SUM(n) OVER (ORDER BY y ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total,
               ROW_NUMBER() OVER (ORDER BY y) AS seq FROM yc),
led AS (SELECT CAST(y AS BIGINT) AS snapshot_id, make_timestamp(y + 1, 1, 1, 0, 0, 0) AS committed_at,
               CASE WHEN seq = 1 THEN 'append' ELSE 'overwrite' END AS operation,
               CAST(total AS VARCHAR) AS added_records, CAST(total AS VARCHAR) AS total_records,
               CAST(total AS BIGINT) AS rows_at_snapshot
        FROM cum)"""


DIRTY_FORM = f"""WITH {M},
{persp()},
{form(keep_unscored=True)},
dtf AS (
  SELECT * REPLACE (
      CASE WHEN TRY_CAST(match_id AS BIGINT) % 53 = 0 THEN 'flat' ELSE form_trend END AS form_trend,
      CASE WHEN TRY_CAST(match_id AS BIGINT) % 59 = 0 THEN points_last5 + 16 ELSE points_last5 END
        AS points_last5)
  FROM tf)
"""

FORM_REPORT = ("team_name, utc_date, venue, goals_scored, goals_conceded, result, points, points_last5, "
               "goals_scored_rolling_avg_5 AS avg_gf, goals_conceded_rolling_avg_5 AS avg_gc, form_trend")
NEWEST = "utc_date DESC NULLS LAST, match_id DESC NULLS LAST, team_id ASC NULLS LAST"


def _top_names() -> str:
    return f"""byname AS ({standings('tf', ('team_name',), ('pts', 'gf', 'gc', 'gd', 'pos'))}),
tops AS (SELECT max(CASE WHEN pos = 1 THEN team_name END) AS first_team,
                max(CASE WHEN pos = 2 THEN team_name END) AS second_team FROM byname)"""


def _ilike(col: str, name_sql: str) -> str:
    """Literal case-insensitive substring match of a name held in SQL."""
    bs = "\\"
    esc = f"replace(replace(replace({name_sql}, '{bs}', '{bs}{bs}'), '%', '{bs}%'), '_', '{bs}_')"
    return f"{col} ILIKE ('%' || {esc} || '%') ESCAPE '{bs}'"


def _not_null_checks() -> str:
    from touchline.operators.quality import GOLD_NOT_NULL
    srcs = {"gold_team_form": "tfm", "gold_match_results": "rs", "gold_head_to_head": "h2h",
            "gold_league_standings": "ls"}
    parts = []
    for model, cols in GOLD_NOT_NULL.items():
        for c in cols:
            parts.append(f"SELECT '{model}' AS model, '{c}' AS column_name, 'not_null' AS \"check\", "
                         f"{_cnt(f'{c} IS NULL')} AS violations FROM {srcs[model]}")
    return "\nUNION ALL\n".join(parts)


def oracle_sql() -> dict[str, str]:
    m_only = f"WITH {M}\n"
    pr = persp()
    sql: dict[str, str] = {}

    sql["team_form"] = f"WITH {M},\n{pr},\n{form()}\nSELECT {TF_COLS} FROM tf"
    sql["team_form_strict"] = f"WITH {M},\n{pr},\n{form(strict=True)}\nSELECT {TF_COLS} FROM tf"
    sql["team_form_unscored"] = f"{GOLD_FORM}SELECT {TF_COLS} FROM tf"
    sql["form_refresh"] = sql["team_form_unscored"]
    sql["perspectives"] = (f"WITH {M},\n{pr}\nSELECT match_id, competition_id, utc_date, team_id, team_name, "
                           "opponent_id, opponent_name, venue, goals_scored, goals_conceded, result, points FROM pr")
    sql["match_results"] = f"WITH {M},\n{RESULTS_PY}\nSELECT * FROM rp"
    sql["match_results_strict"] = f"WITH {M},\n{results_model()}\nSELECT * FROM rs"
    sql["head_to_head"] = f"""WITH {M},
{results_model()},
pairs AS (
  SELECT LEAST(home_team_id, away_team_id) AS team_a_id,
         CASE WHEN home_team_id < away_team_id THEN home_team_name ELSE away_team_name END AS team_a_name,
         GREATEST(home_team_id, away_team_id) AS team_b_id,
         CASE WHEN home_team_id < away_team_id THEN away_team_name ELSE home_team_name END AS team_b_name,
         home_score, away_score,
         CASE WHEN home_score > away_score THEN home_team_id
              WHEN away_score > home_score THEN away_team_id END AS winner_id
  FROM rs)
SELECT team_a_id, team_a_name, team_b_id, team_b_name, COUNT(*) AS total_matches,
       {_cnt('winner_id = team_a_id')} AS team_a_wins,
       {_cnt('winner_id = team_b_id')} AS team_b_wins,
       {_cnt('winner_id IS NULL')} AS draws,
       CAST((200 * SUM(home_score + away_score) + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 100.0
         AS avg_total_goals
FROM pairs GROUP BY team_a_id, team_a_name, team_b_id, team_b_name"""
    sql["league_standings"] = (f"WITH {M},\n{pr},\n{form(strict=True)}\n"
                               + standings("tf", ("team_id", "team_name")))
    sql["league_standings_by_name"] = GOLD_FORM + standings("tf", ("team_name",),
                                                            ("pts", "gf", "gc", "gd", "pos"))
    sql["dashboard_standings"] = ("SELECT pos AS Pos, team_name AS Team, played AS P, won AS W, drawn AS D, lost AS L, "
                                  "gf AS GF, gc AS GA, gd AS GD, pts AS Pts "
                                  f"FROM ({sql['league_standings_by_name']}) AS s")
    sql["teams"] = f"""{m_only}SELECT DISTINCT team_id, team_name, competition_id FROM (
  SELECT home_team_id AS team_id, home_team_name AS team_name, competition_id FROM m
  UNION ALL
  SELECT away_team_id, away_team_name, competition_id FROM m) WHERE team_id IS NOT NULL"""
    sql["team_names"] = f"{GOLD_FORM}SELECT DISTINCT team_name FROM tf"

    # reports
    sql["team_form_recent"] = (f"{GOLD_FORM}SELECT {FORM_REPORT} FROM tf WHERE {_ilike('team_name', chr(39) + 'Team 1' + chr(39))} "
                               f"ORDER BY {NEWEST} LIMIT 20")
    sql["team_form_recent_exact"] = (f"{GOLD_FORM}SELECT {FORM_REPORT} FROM tf WHERE team_name = 'Team 1' "
                                     f"ORDER BY {NEWEST} LIMIT 20")
    pm_cols = "utc_date, home_team_name, away_team_name, home_score, away_score, result"
    fuzzy = (f"({_ilike('home_team_name', chr(39) + 'Team 1' + chr(39))} AND {_ilike('away_team_name', chr(39) + 'Team 2' + chr(39))}) OR "
             f"({_ilike('home_team_name', chr(39) + 'Team 2' + chr(39))} AND {_ilike('away_team_name', chr(39) + 'Team 1' + chr(39))})")
    sql["pair_matches"] = f"WITH {M},\n{RESULTS_PY}\nSELECT {pm_cols} FROM rp WHERE {fuzzy}"
    exact = ("(home_team_name = 'Team 0' AND away_team_name = 'Team 1') OR "
             "(home_team_name = 'Team 1' AND away_team_name = 'Team 0')")
    sql["pair_matches_exact"] = (f"WITH {M},\n{RESULTS_PY}\nSELECT utc_date AS \"Date\", home_team_name AS \"Home\", "
                                 f"away_team_name AS \"Away\", home_score AS \"HG\", away_score AS \"AG\", "
                                 f"result AS \"Result\" FROM rp WHERE {exact}")
    a_w = "(home_team_name = 'Team 0' AND result = 'home_win') OR (away_team_name = 'Team 0' AND result = 'away_win')"
    b_w = "(home_team_name = 'Team 1' AND result = 'home_win') OR (away_team_name = 'Team 1' AND result = 'away_win')"
    sql["pair_tally"] = f"""WITH {M},
{RESULTS_PY},
pm AS (SELECT * FROM rp WHERE {exact})
SELECT COUNT(*) AS total, {_cnt(a_w)} AS a_wins, {_cnt(b_w)} AS b_wins,
       CAST(COUNT(*) - {_cnt(a_w)} - {_cnt(b_w)} AS BIGINT) AS draws FROM pm"""
    sql["league_kpis"] = f"""{GOLD_FORM},
byname AS ({standings('tf', ('team_name',), ('pts', 'gf', 'gc', 'gd', 'pos'))})
SELECT max(CASE WHEN pos = 1 THEN team_name END) AS top_team, COUNT(*) AS total_teams,
       CAST(SUM(played) // 2 AS BIGINT) AS total_matches FROM byname"""
    sql["latest_form"] = f"""{GOLD_FORM}SELECT team_name, utc_date, form_trend, points_last5,
       goals_scored_rolling_avg_5 AS avg_gf, goals_conceded_rolling_avg_5 AS avg_gc FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY team_name ORDER BY {NEWEST}) AS rn FROM tf) WHERE rn = 1"""
    sql["top_team_form"] = f"""{GOLD_FORM},
{_top_names()}
SELECT {FORM_REPORT} FROM tf WHERE {_ilike('team_name', '(SELECT first_team FROM tops)')}
ORDER BY {NEWEST} LIMIT 20"""
    t1, t2 = "(SELECT first_team FROM tops)", "(SELECT second_team FROM tops)"
    sql["top_two_history"] = f"""{GOLD_FORM},
{RESULTS_PY},
{_top_names()}
SELECT {pm_cols} FROM rp
WHERE ({_ilike('home_team_name', t1)} AND {_ilike('away_team_name', t2)})
   OR ({_ilike('home_team_name', t2)} AND {_ilike('away_team_name', t1)})"""
    sql["form_series"] = (f"{GOLD_FORM}SELECT utc_date, goals_scored_rolling_avg_5 AS avg_gf, "
                          f"goals_conceded_rolling_avg_5 AS avg_gc FROM tf WHERE team_name = 'Team 1' "
                          f"ORDER BY {NEWEST} LIMIT 20")
    sql["date_window"] = (f"{m_only}SELECT {M_COLS} FROM m WHERE utc_date BETWEEN "
                          "TIMESTAMP '1998-07-26 00:00:00' AND TIMESTAMP '1998-08-02 00:00:00'")
    sql["fresh_rows"] = ("SELECT event_id, ts, event_type FROM events WHERE ts > TIMESTAMP '2024-01-15 11:50:00' "
                         "AND ts <= TIMESTAMP '2024-01-15 12:00:00'")
    sql["epoch_to_ts"] = ("SELECT event_id, epoch_us(ts) // 1000 AS timestamp_ms, "
                          "epoch_ms(epoch_us(ts) // 1000) AS committed_at FROM events")

    # silver
    sql["normalize_status"] = f"""WITH {M},
{VERSIONS},
raw AS (
  SELECT match_id,
         CASE WHEN status = 'finished' THEN (CASE WHEN k % 31 = 0 THEN '1H' ELSE 'Match Finished' END)
              WHEN status = 'scheduled' THEN (CASE WHEN k % 29 = 0 THEN 'Match Postponed' ELSE 'Not Started' END)
              ELSE status END AS raw_status
  FROM v WHERE source = {FLAT})
SELECT match_id, raw_status,
       CASE WHEN lower(raw_status) LIKE '%finished%' THEN 'finished'
            WHEN lower(raw_status) LIKE '%not started%' THEN 'scheduled'
            WHEN lower(raw_status) LIKE '%postponed%' THEN 'postponed'
            ELSE lower(raw_status) END AS status
FROM raw"""
    sql["flatten_nested"] = f"WITH {M},\n{VERSIONS}\nSELECT {SILVER_COLS} FROM fl WHERE source = {NESTED}"
    sql["unknown_sources"] = sql["flatten_nested"]
    sql["flatten_flat"] = f"WITH {M},\n{VERSIONS}\nSELECT {SILVER_COLS} FROM fl WHERE source = {FLAT}"
    sql["unify_sources"] = f"WITH {M},\n{VERSIONS}\nSELECT {SILVER_COLS} FROM fl"
    sql["quality_flag"] = f"WITH {M},\n{VERSIONS}\nSELECT {SILVER_COLS}, quality_flag FROM flq"
    sql["raw_roundtrip"] = f"""WITH {M},
{VERSIONS}
SELECT CAST(ingested_ts AS DATE) AS date, source, match_id AS match_key,
       CASE WHEN source = {NESTED} THEN strftime(ingested_ts, '%Y-%m-%dT%H:%M:%SZ')
            ELSE strftime(ingested_ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS ingested_at
FROM v"""
    sql["silver_matches"] = SILVER
    sql["keep_latest"] = LINEITEM_LATEST
    sql["stream_upsert"] = LINEITEM_LATEST
    sql["flatten_standings"] = (f"WITH {M},\n{SD}\nSELECT team_id, team_name, position, played_games, won, draw, "
                                "lost, points, goals_for, goals_against, goal_difference, ingested_at FROM fs")
    sql["keep_latest_standings"] = STANDINGS_LATEST
    sql["silver_standings"] = STANDINGS_LATEST
    sql["to_messages"] = f"""WITH {M},
{VERSIONS}
SELECT 'x-matches' AS topic, CAST(k AS VARCHAR) AS key, {NESTED_JSON} AS value FROM v WHERE source = {NESTED}
UNION ALL
SELECT 'x-matches', match_id, {FLAT_JSON} FROM v WHERE source = {FLAT}
UNION ALL
SELECT 'x-standings', competition_id, {_standings_json()} FROM m"""
    sql["parse_messages"] = f"WITH {MSG}\nSELECT topic, key, value, timestamp FROM msg WHERE json_valid(value)"
    sql["stream_land_raw"] = LANDED
    sql["stream_restart"] = LANDED
    sql["stream_land_once"] = LANDED

    for key in ("league_standings", "league_standings_by_name", "head_to_head"):
        sql[f"{key}_kept"] = sql[key]

    # checks
    sql["check_silver"] = f"""WITH {M},
{DIRTY}
SELECT COUNT(*) AS total_rows, {_cnt('match_id IS NULL')} AS null_match_ids,
       {_cnt('home_score < 0 OR away_score < 0')} AS negative_scores,
       (COUNT(*) > 0 AND {_cnt('match_id IS NULL')} = 0 AND {_cnt('home_score < 0 OR away_score < 0')} = 0) AS passed
FROM dm"""
    bad_trend = "form_trend NOT IN ('improving', 'declining')"
    bad_pts = "points_last5 < 0 OR points_last5 > 15"
    sql["check_gold"] = f"""{DIRTY_FORM}SELECT {_cnt(bad_trend)} AS invalid_trends, {_cnt(bad_pts)} AS invalid_points,
       (COUNT(*) > 0 AND {_cnt(bad_trend)} = 0 AND {_cnt(bad_pts)} = 0) AS passed FROM dtf"""
    sql["check_points_range"] = f"{DIRTY_FORM}SELECT team_id, match_id, points_last5 FROM dtf WHERE {bad_pts}"
    sql["check_not_null"] = f"""WITH {M},
{pr},
{form(strict=True, name='tfm')},
{results_model()},
h2h AS (SELECT LEAST(home_team_id, away_team_id) AS team_a_id, GREATEST(home_team_id, away_team_id) AS team_b_id
        FROM rs),
ls AS ({standings('tfm', ('team_id', 'team_name'))}),
chk AS ({_not_null_checks()})
SELECT model, column_name, "check", violations, violations = 0 AS passed FROM chk"""
    sql["check_unique"] = f"""WITH {M},
{VERSIONS},
{DIRTY},
{persp('dm', 'dp')},
dup_results AS (SELECT match_id FROM fl WHERE status = 'finished' AND match_id IS NOT NULL
                GROUP BY match_id HAVING COUNT(*) > 1),
groups AS (SELECT team_id, team_name FROM dp WHERE goals_scored IS NOT NULL GROUP BY team_id, team_name),
dup_teams AS (SELECT team_id FROM groups WHERE team_id IS NOT NULL GROUP BY team_id HAVING COUNT(*) > 1),
chk AS (
  SELECT 'gold_match_results' AS model, 'match_id' AS column_name, 'unique' AS "check",
         (SELECT COUNT(*) FROM dup_results) AS violations
  UNION ALL
  SELECT 'gold_league_standings', 'team_id', 'unique', (SELECT COUNT(*) FROM dup_teams))
SELECT model, column_name, "check", violations, violations = 0 AS passed FROM chk"""
    sql["check_accepted"] = f"""{DIRTY_FORM},
{results_model()},
chk AS (
  SELECT 'gold_team_form' AS model, 'result' AS column_name, 'accepted_values' AS "check",
         {_cnt("result NOT IN ('W', 'D', 'L')")} AS violations FROM dtf
  UNION ALL
  SELECT 'gold_team_form', 'form_trend', 'accepted_values', {_cnt(bad_trend)} FROM dtf
  UNION ALL
  SELECT 'gold_match_results', 'result', 'accepted_values',
         {_cnt("result NOT IN ('home_win', 'draw', 'away_win')")} FROM rs)
SELECT model, column_name, "check", violations, violations = 0 AS passed FROM chk"""
    sql["check_scores"] = f"""WITH {M},
{DIRTY},
{results_model('dm')}
SELECT match_id, home_score, away_score FROM rs WHERE home_score < 0 OR away_score < 0"""

    # snapshots
    led = _snap_ledger("m")
    sql["snapshot_history"] = (f"WITH {M},\n{led}\nSELECT snapshot_id, committed_at, operation, added_records, "
                               "total_records FROM led")
    sql["read_at_snapshot"] = (f"{m_only}SELECT {M_COLS} FROM m WHERE year(utc_date) <= "
                               "(SELECT min(year(utc_date)) FROM m)")
    sql["snapshot_compare"] = f"""WITH {M},
{led},
r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY committed_at DESC, snapshot_id DESC) AS rk FROM led)
SELECT max(CASE WHEN rk = 1 THEN snapshot_id END) AS newest_snapshot_id,
       max(CASE WHEN rk = 1 THEN committed_at END) AS newest_committed_at,
       max(CASE WHEN rk = 1 THEN rows_at_snapshot END) AS newest_count,
       max(CASE WHEN rk = 2 THEN snapshot_id END) AS previous_snapshot_id,
       max(CASE WHEN rk = 2 THEN committed_at END) AS previous_committed_at,
       max(CASE WHEN rk = 2 THEN rows_at_snapshot END) AS previous_count,
       max(CASE WHEN rk = 1 THEN rows_at_snapshot END) - max(CASE WHEN rk = 2 THEN rows_at_snapshot END) AS row_delta
FROM r HAVING max(CASE WHEN rk = 2 THEN snapshot_id END) IS NOT NULL"""
    sql["read_as_of"] = f"""WITH {M},
{led}
SELECT {M_COLS} FROM m WHERE year(utc_date) <= (
  SELECT max(snapshot_id) FROM led WHERE committed_at <= TIMESTAMP '{'1998-06-30 00:00:00'}')"""
    sql["snapshot_report"] = f"""{GOLD_FORM},
{RESULTS_PY},
{_snap_ledger('m').replace('yc AS', 'yc_m AS').replace('FROM yc)', 'FROM yc_m)').replace('cum AS', 'cum_m AS').replace('FROM cum)', 'FROM cum_m)').replace('led AS', 'led_m AS')},
{_snap_ledger('tf').replace('yc AS', 'yc_f AS').replace('FROM yc)', 'FROM yc_f)').replace('cum AS', 'cum_f AS').replace('FROM cum)', 'FROM cum_f)').replace('led AS', 'led_f AS')},
{_snap_ledger('rp').replace('yc AS', 'yc_r AS').replace('FROM yc)', 'FROM yc_r)').replace('cum AS', 'cum_r AS').replace('FROM cum)', 'FROM cum_r)').replace('led AS', 'led_r AS')},
{SD},
sl AS (SELECT COUNT(DISTINCT team_id) AS n FROM fs)
SELECT 'silver.matches' AS table_name, * FROM led_m
UNION ALL SELECT 'silver.standings', 2024, TIMESTAMP '2025-01-01 00:00:00', 'append', CAST(n AS VARCHAR), CAST(n AS VARCHAR), n FROM sl
UNION ALL SELECT 'gold.team_form', * FROM led_f
UNION ALL SELECT 'gold.match_results', * FROM led_r"""

    # composed runs
    sql["run_full"] = f"""{LAKE}
SELECT model, column_name, "check", CAST(violations AS BIGINT) AS violations, violations = 0 AS passed FROM (
  SELECT 'silver_matches' AS model, '*' AS column_name, 'validate_silver' AS "check",
         {_cnt('match_id IS NULL')} + {_cnt('home_score < 0 OR away_score < 0')} AS violations FROM silver
  UNION ALL {_zero('team_form', 'validate_gold', '*')}
  UNION ALL SELECT 'gold_team_form', 'team_id', 'not_null', {_cnt('team_id IS NULL')} FROM own
  UNION ALL SELECT 'gold_team_form', 'goals_conceded', 'not_null', {_cnt('conceded IS NULL')} FROM own
  UNION ALL {_zero('gold_team_form', 'not_null', 'match_id', 'result', 'form_trend', 'goals_scored', 'points_last5')}
  UNION ALL {_zero('gold_team_form', 'accepted_values', 'result', 'form_trend')}
  UNION ALL {_zero('gold_team_form', 'between', 'points_last5')}
  UNION ALL {_zero('gold_match_results', 'not_null', 'match_id', 'result', 'home_score', 'away_score')}
  UNION ALL {_zero('gold_match_results', 'accepted_values', 'result')}
  UNION ALL {_zero('gold_match_results', 'at_least', 'home_score', 'away_score')}
  UNION ALL {_zero('gold_match_results', 'unique', 'match_id')}
  UNION ALL SELECT 'gold_head_to_head', 'team_a_id', 'not_null', {_cnt('a IS NULL')} FROM pairs
  UNION ALL SELECT 'gold_head_to_head', 'team_b_id', 'not_null', {_cnt('b IS NULL')} FROM pairs
  UNION ALL SELECT 'gold_league_standings', 'team_id', 'not_null', {_cnt('team_id IS NULL')} FROM named
  UNION ALL {_zero('gold_league_standings', 'not_null', 'position')}
  UNION ALL SELECT 'gold_league_standings', 'team_id', 'unique', COUNT(*) FROM (
    SELECT team_id FROM named WHERE team_id IS NOT NULL GROUP BY team_id HAVING COUNT(*) > 1))"""
    sql["run_full_history"] = f"""{LAKE},
{SD},
sizes AS (
  SELECT 'silver.matches' AS table_name, COUNT(*) AS n FROM silver
  UNION ALL SELECT 'silver.standings', COUNT(DISTINCT team_id) FROM fs
  UNION ALL SELECT 'gold.team_form', 2 * COUNT(*) FROM fin
  UNION ALL SELECT 'gold.match_results', COUNT(*) FROM fin)
SELECT table_name, 'append' AS operation, CAST(n AS VARCHAR) AS added_records, CAST(n AS VARCHAR) AS total_records, n AS rows_at_snapshot FROM sizes"""
    needed = ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}:not_null' END" for c in ("match_id", "home_team_id", "away_team_id", "utc_date", "status"))
    negative = ", ".join(f"CASE WHEN {c} < 0 THEN '{c}:at_least' END" for c in ("home_score", "away_score"))
    sql["quarantine"] = f"""WITH {M},
{VERSIONS}
SELECT match_id, source, ingested_at, CASE WHEN reasons = '' THEN 'good' ELSE 'bad' END AS verdict, reasons
FROM (SELECT *, concat_ws(',', {needed}, {negative}) AS reasons FROM fl)"""
    return sql


# Silver from all landed versions, and what the gold models are built from.
LAKE = f"""WITH {M},
{VERSIONS},
silver AS (
  SELECT {SILVER_COLS} FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY match_id ORDER BY ingested_at DESC NULLS LAST, {SILVER_TIEBREAK}) AS rn
    FROM flq) WHERE rn = 1),
fin AS (SELECT * FROM silver WHERE status = 'finished'),
own AS (
  SELECT home_team_id AS team_id, home_team_name AS team_name, away_score AS conceded FROM fin WHERE home_score IS NOT NULL
  UNION ALL
  SELECT away_team_id, away_team_name, home_score FROM fin WHERE away_score IS NOT NULL),
named AS (SELECT DISTINCT team_id, team_name FROM own),
pairs AS (
  SELECT DISTINCT LEAST(home_team_id, away_team_id) AS a, GREATEST(home_team_id, away_team_id) AS b,
         CASE WHEN home_team_id < away_team_id THEN home_team_name ELSE away_team_name END AS a_name,
         CASE WHEN home_team_id < away_team_id THEN away_team_name ELSE home_team_name END AS b_name
  FROM fin WHERE home_score IS NOT NULL AND away_score IS NOT NULL)"""


def _zero(model: str, check: str, *columns: str) -> str:
    """Checks that the model's own definition rules out."""
    return " UNION ALL ".join(f"SELECT '{model}', '{c}', '{check}', 0" for c in columns)
