"""ANSI SQL twin of each registered query, built from shared common table expressions."""

from __future__ import annotations

# -- match data from orders -----------------------------------------------------------------

M1 = """
m1 AS (
  SELECT o_orderkey AS match_id, o_orderdate AS match_datetime, o_custkey % 3 AS lg, o_orderstatus AS st,
         (o_custkey % 3) * 20 + o_custkey % 20 AS home_team_id,
         (o_custkey % 3) * 20 + (o_custkey % 20 + 1 + o_orderkey % 19) % 20 AS away_team_id,
         CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice) AS BIGINT) % 5 END AS hs,
         CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice) AS BIGINT) % 7 % 4 END AS aw
  FROM orders
)"""

FACT = M1 + """,
fact AS (
  SELECT match_id, match_datetime AS match_date,
         CASE lg WHEN 0 THEN 'PL' WHEN 1 THEN 'FL1' ELSE 'PD' END AS competition_code,
         CASE lg WHEN 0 THEN 'Premier League' WHEN 1 THEN 'Ligue 1' ELSE 'La Liga' END AS competition_name,
         CASE st WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'SCHEDULED' WHEN 'P' THEN 'IN_PLAY' END AS status,
         home_team_id, CASE WHEN home_team_id % 10 = 3 AND match_datetime >= DATE '1997-07-01' THEN 'Club ' ELSE 'Team ' END
           || home_team_id AS home_team_name,
         away_team_id, CASE WHEN away_team_id % 10 = 3 AND match_datetime >= DATE '1997-07-01' THEN 'Club ' ELSE 'Team ' END
           || away_team_id AS away_team_name,
         hs AS fulltime_home_score, aw AS fulltime_away_score,
         CAST(floor(hs / 2.0) AS BIGINT) AS halftime_home_score, CAST(floor(aw / 2.0) AS BIGINT) AS halftime_away_score,
         CASE WHEN hs > aw THEN 'HOME_TEAM' WHEN hs < aw THEN 'AWAY_TEAM' WHEN hs = aw THEN 'DRAW' END AS winner,
         CASE WHEN hs > aw THEN 'Home Win' WHEN hs < aw THEN 'Away Win' WHEN hs = aw THEN 'Draw'
              ELSE 'Unknown' END AS match_outcome,
         hs + aw AS total_goals, CAST(year(match_datetime) AS BIGINT) AS match_year
  FROM m1
)"""

BRONZE = FACT + """,
bronze AS (
  SELECT match_id AS id, strftime(match_date, '%Y-%m-%dT%H:%M:%S') || 'Z' AS "utcDate", status,
         home_team_id AS "homeTeam_id", home_team_name AS "homeTeam_name",
         away_team_id AS "awayTeam_id", away_team_name AS "awayTeam_name",
         winner AS "score_winner",
         fulltime_home_score AS "score_fullTime_home", fulltime_away_score AS "score_fullTime_away",
         halftime_home_score AS "score_halfTime_home", halftime_away_score AS "score_halfTime_away",
         competition_code, CAST(match_year AS INTEGER) AS season_year
  FROM fact
)"""


def num(expr: str, places: int) -> str:
    """Round half away from zero on the decimal value, then back to a double."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(28, 12)), {places}) AS DOUBLE)"


def pct(part: str, whole: str) -> str:
    return num(f"CAST(100 AS DOUBLE) * {part} / {whole}", 2)


def quot(part: str, whole: str) -> str:
    return num(f"CAST({part} AS DOUBLE) / {whole}", 2)


def total(expr: str) -> str:
    return f"CAST(SUM({expr}) AS BIGINT)"


def hits(condition: str) -> str:
    return total(f"CASE WHEN {condition} THEN 1 ELSE 0 END")


SIDES = FACT + """,
sides AS (
  SELECT match_id, match_date, competition_code, home_team_id AS team_id, home_team_name AS team_name,
         fulltime_home_score AS gf, fulltime_away_score AS ga, 1 AS at_home FROM fact WHERE status = 'FINISHED'
  UNION ALL
  SELECT match_id, match_date, competition_code, away_team_id, away_team_name,
         fulltime_away_score, fulltime_home_score, 0 FROM fact WHERE status = 'FINISHED'
)"""

NAMED = """,
latest_names AS (
  SELECT competition_code, team_id, team_name FROM (
    SELECT competition_code, team_id, team_name,
           ROW_NUMBER() OVER (PARTITION BY competition_code, team_id ORDER BY match_date DESC, match_id DESC) AS rn
    FROM sides
  ) t WHERE rn = 1
)"""

PERF = SIDES + NAMED + f""",
perf0 AS (
  SELECT competition_code, MAX(latest_name) AS team_name, COUNT(*) AS total_matches,
         {hits('gf > ga')} AS total_wins, {hits('gf = ga')} AS total_draws, {hits('gf < ga')} AS total_losses,
         {total('gf')} AS total_goals_scored, {total('ga')} AS total_goals_conceded,
         {hits('gf > ga AND at_home = 1')} AS home_wins, {hits('gf > ga AND at_home = 0')} AS away_wins,
         {hits('at_home = 1')} AS home_matches, {hits('at_home = 0')} AS away_matches
  FROM (SELECT s.*, n.team_name AS latest_name FROM sides s JOIN latest_names n
        ON s.competition_code = n.competition_code AND s.team_id = n.team_id) named
  GROUP BY competition_code, team_id
),
perf AS (
  SELECT competition_code, team_name, total_matches, total_wins, total_draws, total_losses,
         total_goals_scored, total_goals_conceded, total_goals_scored - total_goals_conceded AS goal_difference,
         3 * total_wins + total_draws AS total_points,
         {pct('total_wins', 'total_matches')} AS win_percentage,
         {quot('(3 * total_wins + total_draws)', 'total_matches')} AS points_per_match,
         home_wins, away_wins, home_matches, away_matches
  FROM perf0
)"""

COMP = FACT + f""",
comp AS (
  SELECT match_year, competition_code, competition_name, COUNT(*) AS total_matches,
         {total('total_goals')} AS total_goals, {quot(total('total_goals'), 'COUNT(*)')} AS avg_goals_per_match,
         {pct(hits("match_outcome = 'Home Win'"), 'COUNT(*)')} AS home_win_percentage,
         {pct(hits("match_outcome = 'Away Win'"), 'COUNT(*)')} AS away_win_percentage,
         {pct(hits("match_outcome = 'Draw'"), 'COUNT(*)')} AS draw_percentage,
         {pct(hits('total_goals > 3'), 'COUNT(*)')} AS high_scoring_percentage
  FROM fact WHERE status = 'FINISHED' GROUP BY match_year, competition_code, competition_name
)"""

TEAM_STATS = SIDES + NAMED + f""",
team_stats AS (
  SELECT team_id, MAX(latest_name) AS team_name, competition_code AS league_code, COUNT(*) AS total_matches,
         {hits('gf > ga')} AS total_wins, {hits('gf = ga')} AS total_draws, {hits('gf < ga')} AS total_losses,
         {total('CASE WHEN gf > ga THEN 3 WHEN gf = ga THEN 1 ELSE 0 END')} AS total_points,
         {pct(hits('gf > ga'), 'COUNT(*)')} AS win_rate
  FROM (SELECT s.*, n.team_name AS latest_name FROM sides s JOIN latest_names n
        ON s.competition_code = n.competition_code AND s.team_id = n.team_id) named
  GROUP BY team_id, competition_code
)"""

TEAMS = FACT + """,
seen AS (
  SELECT home_team_id AS team_id, home_team_name AS team_name, competition_code, match_date, match_id FROM fact
  UNION ALL
  SELECT away_team_id, away_team_name, competition_code, match_date, match_id FROM fact
),
teams AS (
  SELECT team_id, team_name FROM (
    SELECT team_id, team_name, ROW_NUMBER() OVER (PARTITION BY team_id ORDER BY match_date DESC, match_id DESC) AS rn
    FROM seen
  ) t WHERE rn = 1
),
partial_teams AS (SELECT DISTINCT team_id FROM seen WHERE competition_code IN ('PL', 'FL1'))"""

STAGED = BRONZE + """,
staged AS (
  SELECT match_id, match_date AS match_datetime, status, competition_code AS league_code,
         home_team_id, home_team_name, away_team_id, away_team_name,
         fulltime_home_score AS full_time_home_score, fulltime_away_score AS full_time_away_score,
         halftime_home_score AS half_time_home_score, halftime_away_score AS half_time_away_score,
         winner, match_outcome AS match_result
  FROM fact
)"""

LEAGUES = M1 + """,
leagues AS (
  SELECT DISTINCT lg + 2000 AS id, CASE lg WHEN 0 THEN 'PL' WHEN 1 THEN 'FL1' ELSE 'PD' END AS code,
         CASE lg WHEN 0 THEN 'Premier League' WHEN 1 THEN 'Ligue 1' ELSE 'La Liga' END AS name
  FROM m1
)"""

# JSON text of the nested fields, built by hand
_int = "COALESCE(CAST({0} AS VARCHAR), 'null')"


def _pair(half: str) -> str:
    home, away = (_int.format(f"{half}time_{side}_score") for side in ("home", "away"))
    return f"""'{{"home":' || {home} || ',"away":' || {away} || '}}'"""


REF_ID = "CAST(match_id % 7 AS VARCHAR)"
REFEREES = f"""CASE WHEN match_id % 5 = 0 THEN '[]' ELSE '[{{"id":' || {REF_ID} || ',"name":' ||
  CASE WHEN match_id % 3 <> 0 THEN '"Ref ' || {REF_ID} || '"' ELSE 'null' END || '}}]' END"""
SCORE = f"""'{{"winner":' || COALESCE('"' || winner || '"', 'null') || ',"fullTime":' || {_pair('full')} ||
  ',"halfTime":' || {_pair('half')} || '}}'"""
UTC = "strftime(match_date, '%Y-%m-%dT%H:%M:%S') || 'Z'"
REFEREE_COUNT = "CAST(CASE WHEN match_id % 5 = 0 THEN 0 ELSE 1 END AS BIGINT)"


def flat(sep: str, referees: str, tags: str = "competition_code AS {q}competition{s}code{q}") -> str:
    """Flattened payload columns with `sep` in their names."""
    q = '"'
    name = lambda *parts: q + sep.join(parts) + q
    return f"""
  match_id AS id, {UTC} AS "utcDate", status, {tags.format(q=q, s=sep)},
  competition_name AS {name('competition', 'name')}, match_year AS {name('season', 'startYear')},
  home_team_id AS {name('homeTeam', 'id')}, home_team_name AS {name('homeTeam', 'name')},
  away_team_id AS {name('awayTeam', 'id')}, away_team_name AS {name('awayTeam', 'name')},
  winner AS {name('score', 'winner')},
  fulltime_home_score AS {name('score', 'fullTime', 'home')}, fulltime_away_score AS {name('score', 'fullTime', 'away')},
  halftime_home_score AS {name('score', 'halfTime', 'home')}, halftime_away_score AS {name('score', 'halfTime', 'away')},
  {referees} AS referees"""


ORACLE: dict[str, str] = {}


def add(ctes: str, **selects: str) -> None:
    for name, select in selects.items():
        ORACLE[name] = f"WITH {ctes.strip()}\n{select}"


TEAM_RESULT = """CASE WHEN home_team_name = 'Team 7' AND winner = 'HOME_TEAM' THEN 'Win'
  WHEN away_team_name = 'Team 7' AND winner = 'AWAY_TEAM' THEN 'Win'
  WHEN winner = 'DRAW' THEN 'Draw' ELSE 'Loss' END"""
OF_TEAM = "(home_team_name = 'Team 7' OR away_team_name = 'Team 7')"
NEWEST = "ORDER BY match_date DESC NULLS FIRST, match_id DESC NULLS FIRST"
TABLE_ORDER = "ORDER BY total_points DESC NULLS FIRST, goal_difference DESC NULLS FIRST, team_name, competition_code"
RECENT = """match_date, competition_name, home_team_name, away_team_name,
  fulltime_home_score, fulltime_away_score, match_outcome"""
SCORE_TEXT = """COALESCE(CAST(fulltime_home_score AS VARCHAR), 'nan') || ' - ' ||
  COALESCE(CAST(fulltime_away_score AS VARCHAR), 'nan')"""
STANDINGS = """team_name, total_matches, total_wins, total_draws, total_losses, total_goals_scored,
  total_goals_conceded, goal_difference, total_points, win_percentage, points_per_match"""

# -- sources and sinks ----------------------------------------------------------------------

add(
    BRONZE,
    src_raw_matches=f"SELECT {flat('_', REFEREES)}, CAST(match_year AS INTEGER) AS season_year FROM fact",
    src_parquet="SELECT * FROM bronze",
    src_table_query="""SELECT home_team_name, COUNT(*) AS matches, CAST(SUM(total_goals) AS BIGINT) AS goals FROM fact
      WHERE competition_code = 'PL' AND match_year >= 1997 AND status = 'FINISHED' GROUP BY home_team_name""",
    src_dir_scan="""SELECT 'all_matches' AS table_name, COUNT(*) AS row_count FROM bronze
      UNION ALL SELECT 'competitions', COUNT(DISTINCT competition_code) FROM bronze""",
    snk_raw_envelope="""SELECT competition_code, season_year, '2025-01-06T04:30:00.000000' AS extracted_at,
      COUNT(*) AS record_count, COUNT(*) AS matches, MIN(id) AS first_id, MAX(id) AS last_id
      FROM bronze GROUP BY competition_code, season_year, id // 1000""",
    snk_parquet_by_season="SELECT id, \"utcDate\", status, competition_code, season_year FROM bronze",
    load_unflattened=f"""SELECT match_id AS id, {UTC} AS "utcDate", status,
      '{{"code":"' || competition_code || '","name":"' || competition_name || '"}}' AS competition, {REFEREES} AS referees,
      '{{"id":' || home_team_id || ',"name":"' || home_team_name || '"}}' AS "homeTeam",
      '{{"id":' || away_team_id || ',"name":"' || away_team_name || '"}}' AS "awayTeam", {SCORE} AS score,
      CAST(match_year AS INTEGER) AS season,
      CAST(CASE competition_code WHEN 'PL' THEN 2000 ELSE 2001 END AS BIGINT) AS competition_id
      FROM fact WHERE competition_code <> 'PD'""",
    load_directory="""SELECT 'bronze' AS layer, 'all_matches' AS table_name, COUNT(*) AS row_count FROM bronze
      UNION ALL SELECT 'bronze', 'competitions', COUNT(DISTINCT competition_code) FROM bronze""",
    append_tables=f"""SELECT match_id AS id, status, {REFEREES} AS referees,
      CASE WHEN match_id % 5 <> 0 THEN match_id % 7 END AS first_referee
      FROM fact, (VALUES (1), (2)) runs(n)
      UNION ALL SELECT match_id, status, '"plain ' || match_id || '"', NULL FROM fact WHERE match_id % 3 <> 0
      UNION ALL SELECT match_id, status, '[{{"id":' || match_id || '}}]', match_id FROM fact WHERE match_id % 3 = 0""",
    snk_replace="SELECT id, status, season_year FROM bronze",
    snk_append="""SELECT id, status, season_year FROM bronze
      UNION ALL SELECT id, CAST(NULL AS VARCHAR), season_year FROM bronze""",
    snk_load_seasons="""SELECT CAST(s.y AS INTEGER) AS season_year, COUNT(b.id) AS rows_loaded,
      COUNT(b.id) AS rows_stored, COUNT(b.id) = 0 AS failed
      FROM (SELECT unnest(range(lo, hi)) AS y FROM (SELECT MIN(season_year) - 1 AS lo, MAX(season_year) + 2 AS hi FROM bronze) r) s LEFT JOIN bronze b ON b.season_year = s.y GROUP BY s.y""",
    snk_layer_schema="""SELECT l.layer, 'matches' AS table_name, COUNT(*) AS row_count
      FROM (VALUES ('bronze'), ('silver'), ('gold')) l(layer), bronze GROUP BY l.layer""",
    snk_model_table="SELECT *, TIMESTAMP '2025-01-06 04:30:00' AS loaded_at FROM fact",
)
add(LEAGUES, src_raw_competitions="SELECT id, code, name FROM leagues")
add(M1, src_competition_ids="SELECT match_id, lg + 2000 AS competition_id FROM m1")
add(
    PERF,
    src_inventory="""SELECT 'bronze' AS layer, 'matches' AS table_name, COUNT(*) AS row_count FROM fact
      UNION ALL SELECT 'bronze', 'competitions', COUNT(DISTINCT competition_code) FROM fact
      UNION ALL SELECT 'silver', 'stg_matches', COUNT(*) FROM fact
      UNION ALL SELECT 'gold', 'agg_team_performance', COUNT(*) FROM perf""",
)

# -- projections ----------------------------------------------------------------------------

add(
    STAGED,
    prj_flatten=f"SELECT {flat('_', REFEREE_COUNT)} FROM fact",
    prj_flatten_dot=f"SELECT {flat('.', REFEREE_COUNT)} FROM fact",
    prj_tag="""SELECT match_id AS id, 'PL' AS competition_code, competition_name,
      CAST(2023 AS INTEGER) AS season_year FROM fact""",
    prj_tag_raw="""SELECT match_id AS id, CAST(2023 AS INTEGER) AS season, CAST(2021 AS INTEGER) AS competition_id
      FROM fact""",
    prj_json_encode=f"""SELECT match_id AS id, {UTC} AS "utcDate", status,
      '{{"code":"' || competition_code || '","name":"' || competition_name || '"}}' AS competition,
      '{{"startYear":' || match_year || '}}' AS season,
      '{{"id":' || home_team_id || ',"name":"' || home_team_name || '"}}' AS "homeTeam",
      '{{"id":' || away_team_id || ',"name":"' || away_team_name || '"}}' AS "awayTeam",
      {SCORE} AS score, {REFEREES} AS referees FROM fact""",
    prj_json_encode_strict=f"""SELECT match_id AS id, {SCORE} AS score,
      CASE WHEN match_id % 5 <> 0 THEN {REFEREES} END AS referees,
      '[' || fulltime_home_score || ',' || fulltime_away_score || ']' AS goals FROM fact""",
    prj_rename_cast="SELECT * FROM staged",
    stg_matches="SELECT * FROM staged",
    prj_null_handling="""SELECT status, match_result, COUNT(*) AS matches, COUNT(full_time_home_score) AS scored
      FROM staged GROUP BY status, match_result""",
    prj_match_result="SELECT match_id, match_outcome FROM fact",
    prj_total_goals="SELECT match_id, total_goals FROM fact",
    prj_loaded_at="SELECT match_id, TIMESTAMP '2025-01-06 04:30:00' AS loaded_at FROM fact",
    prj_team_result=f"SELECT match_id, {TEAM_RESULT} AS result FROM fact WHERE {OF_TEAM}",
    prj_score_label=f"""SELECT match_id, {SCORE_TEXT} AS score,
      home_team_name || ' ' || {SCORE_TEXT} || ' ' || away_team_name AS match FROM fact""",
    prj_recent_cols=f"""SELECT match_date, competition_name,
      home_team_name || ' ' || {SCORE_TEXT} || ' ' || away_team_name AS match, match_outcome
      FROM fact {NEWEST} LIMIT 10""",
    scalar_functions=f"""SELECT id, CAST(substr("utcDate", 1, 19) AS TIMESTAMP) AS ts, CAST(season_year AS BIGINT) AS year,
      substr("utcDate", 1, 19) AS iso, competition_code AS code,
      CASE WHEN "score_fullTime_home" + "score_fullTime_away" > 0 THEN
        {pct('"score_fullTime_home"', '("score_fullTime_home" + "score_fullTime_away")')} END AS home_share,
      CAST("score_fullTime_home" AS DOUBLE) / 2 AS half
      FROM bronze""",
)
ORACLE["prj_json_type"] = """SELECT event_id, event_type, 'OBJECT<k: BIGINT>' AS shape,
  CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"""

add(
    PERF,
    prj_report_cols=f"SELECT {STANDINGS} FROM perf WHERE competition_code = 'PL'",
    prj_team_overview=f"""SELECT total_matches, total_points, {num('win_percentage', 1)} AS win_rate,
      total_goals_scored, goal_difference FROM perf WHERE team_name = 'Team 7' {TABLE_ORDER} LIMIT 1""",
    prj_unpivot_wdl="""SELECT r.result, CASE r.result WHEN 'Wins' THEN total_wins WHEN 'Draws' THEN total_draws
      ELSE total_losses END AS matches
      FROM perf, (VALUES ('Wins'), ('Draws'), ('Losses')) r(result) WHERE team_name = 'Team 7'""",
    prj_unpivot_venue="""SELECT 'Home' AS venue, home_wins AS wins, home_matches AS matches FROM perf
      WHERE team_name = 'Team 7' UNION ALL SELECT 'Away', away_wins, away_matches FROM perf WHERE team_name = 'Team 7'""",
)
add(
    COMP,
    prj_goals_trend="SELECT match_year, avg_goals_per_match FROM comp WHERE competition_name = 'La Liga'",
    prj_high_scoring="""SELECT competition_name, match_year, high_scoring_percentage FROM comp
      WHERE competition_code = 'FL1'""",
    prj_unpivot_outcomes="""SELECT match_year, o.outcome, CASE o.outcome WHEN 'Home Wins' THEN home_win_percentage
      WHEN 'Away Wins' THEN away_win_percentage ELSE draw_percentage END AS percentage
      FROM comp, (VALUES ('Home Wins'), ('Away Wins'), ('Draws')) o(outcome) WHERE competition_name = 'La Liga'""",
)

# -- filters --------------------------------------------------------------------------------

add(
    BRONZE,
    flt_season="SELECT * FROM bronze WHERE season_year = 1996",
    flt_team_either_side=f"SELECT * FROM fact WHERE {OF_TEAM}",
    flt_finished="SELECT match_id, status, total_goals FROM fact WHERE status = 'FINISHED'",
    flt_scope="SELECT * FROM bronze WHERE competition_code IN ('PL', 'PD') AND season_year IN (1996, 1997)",
    flt_status_domain="SELECT * FROM bronze WHERE status IN ('FINISHED', 'PAUSED')",
    flt_nonempty="""SELECT CAST(season_year AS VARCHAR) AS table_name, COUNT(*) AS row_count FROM bronze
      GROUP BY season_year""",
)
add(
    COMP,
    flt_year="SELECT * FROM comp WHERE match_year = 1997",
    flt_competition="SELECT * FROM comp WHERE competition_code = 'FL1'",
    flt_exact="SELECT * FROM comp WHERE competition_name = 'La Liga'",
)

# -- models, joins and windows --------------------------------------------------------------

add(
    FACT,
    fact_matches="SELECT *, TIMESTAMP '2025-01-06 04:30:00' AS loaded_at FROM fact",
    mart_match_overview=f"""SELECT competition_code AS league_code, COUNT(*) AS total_matches,
      {quot(total('total_goals'), 'COUNT(*)')} AS avg_goals_per_match
      FROM fact WHERE status = 'FINISHED' GROUP BY competition_code""",
    join_competition="SELECT match_id, competition_code, competition_name FROM fact",
)
add(LEAGUES, stg_competitions="SELECT id AS competition_id, code AS competition_code, name AS competition_name FROM leagues")
add(
    TEAMS,
    stg_teams="SELECT team_id, team_name FROM teams",
    agg_dim_teams="SELECT team_id, team_name FROM teams",
    join_anti_team="""SELECT match_id, home_team_id FROM fact f
      WHERE NOT EXISTS (SELECT 1 FROM partial_teams t WHERE t.team_id = f.home_team_id)""",
)
add(COMP, agg_competition_stats="SELECT * FROM comp")
add(TEAM_STATS, mart_team_stats="SELECT * FROM team_stats")
add(
    PERF,
    agg_team_performance="SELECT * FROM perf",
    mart_league_standings="""SELECT competition_code AS league_code, RANK() OVER (PARTITION BY competition_code
      ORDER BY total_points DESC, goal_difference DESC, total_goals_scored DESC) AS team_rank,
      team_name, total_points, goal_difference, total_goals_scored FROM perf""",
    mart_team_form=f"""SELECT team_id, MAX(CASE WHEN rn = 1 THEN team_name END) AS team_name,
      {total('CASE WHEN gf > ga THEN 3 WHEN gf = ga THEN 1 ELSE 0 END')} AS last_5_points,
      string_agg(CASE WHEN gf > ga THEN 'W' WHEN gf = ga THEN 'D' ELSE 'L' END, '' ORDER BY rn) AS current_form
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY team_id ORDER BY match_date DESC, match_id DESC) AS rn
            FROM sides) s
      WHERE rn <= 5 GROUP BY team_id""",
)

# -- aggregates and reports -----------------------------------------------------------------

add(
    BRONZE,
    agg_table_stats="SELECT COUNT(*) AS row_count, COUNT(DISTINCT match_id) AS unique_keys FROM fact",
    agg_key_metrics=f"""SELECT COUNT(DISTINCT match_id) AS total_matches, COUNT(DISTINCT home_team_id) AS unique_teams,
      {total('total_goals')} AS total_goals FROM fact""",
    agg_freshness="""SELECT MAX(loaded_at) AS last_load
      FROM (SELECT TIMESTAMP '2025-01-06 04:30:00' AS loaded_at FROM fact) f""",
    agg_count="SELECT COUNT(*) AS row_count FROM bronze",
    agg_date_range="SELECT MIN(\"utcDate\") AS first_match, MAX(\"utcDate\") AS last_match FROM bronze",
    agg_by_year="SELECT CAST(season_year AS BIGINT) AS year, COUNT(*) AS matches FROM bronze GROUP BY season_year",
    agg_form_counts=f"""SELECT result, COUNT(*) AS matches FROM (
      SELECT {TEAM_RESULT} AS result FROM fact WHERE {OF_TEAM} {NEWEST} LIMIT 10) f GROUP BY result""",
    agg_having_dup="""SELECT match_id, COUNT(*) AS "rows" FROM (
      SELECT match_id FROM fact UNION ALL SELECT match_id FROM fact WHERE match_year = 1995) f
      GROUP BY match_id HAVING COUNT(*) > 1""",
    top_recent_matches=f"SELECT {RECENT} FROM fact {NEWEST} LIMIT 20",
    top_first_last_matches="""SELECT * FROM (SELECT 'first' AS which, "utcDate", "homeTeam_name", "awayTeam_name"
      FROM bronze ORDER BY "utcDate" NULLS LAST, id LIMIT 3) a
      UNION ALL SELECT * FROM (SELECT 'last', "utcDate", "homeTeam_name", "awayTeam_name"
      FROM bronze ORDER BY "utcDate" DESC NULLS FIRST, id DESC LIMIT 3) b""",
    top_team_matches20=f"""SELECT match_date, competition_name, home_team_name, away_team_name, {SCORE_TEXT} AS score,
      {TEAM_RESULT} AS result FROM fact WHERE {OF_TEAM} {NEWEST} LIMIT 20""",
    lim_sample="SELECT * FROM bronze ORDER BY id LIMIT 5",
    set_concat="""SELECT id, status, CASE WHEN season_year >= 1997 THEN "score_halfTime_home" END
      AS "score_halfTime_home", season_year FROM bronze""",
    set_extend='SELECT id, "utcDate", competition_code, season_year FROM bronze',
)
add(
    COMP,
    agg_kpi_competition=f"""SELECT {total('total_matches')} AS total_matches, {total('total_goals')} AS total_goals,
      {num('AVG(avg_goals_per_match)', 2)} AS avg_goals FROM comp WHERE competition_name = 'La Liga'""",
    agg_matches_by_competition=f"""SELECT competition_name, {total('total_matches')} AS total_matches
      FROM comp GROUP BY competition_name""",
    agg_home_away_mean=f"""SELECT competition_name, {num('AVG(home_win_percentage)', 2)} AS home_win_percentage,
      {num('AVG(away_win_percentage)', 2)} AS away_win_percentage,
      {num('AVG(draw_percentage)', 2)} AS draw_percentage FROM comp GROUP BY competition_name""",
    agg_goal_distribution="SELECT competition_name, " + ", ".join(
        num(f"quantile_cont(avg_goals_per_match, {q})", 4) + f" AS {n}" for q, n in (
            (0, "lowest"), (0.25, "lower_quartile"), (0.5, "median"), (0.75, "upper_quartile"), (1, "highest"))
    ) + " FROM comp GROUP BY competition_name",
    srt_competition_stats="SELECT * FROM comp ORDER BY match_year DESC, competition_code",
)
add(
    PERF + "," + COMP.removeprefix(FACT + ","),
    agg_kpi=f"""SELECT {total('total_matches')} AS total_matches, {total('total_goals')} AS total_goals,
      {num('AVG(avg_goals_per_match)', 2)} AS avg_goals,
      (SELECT COUNT(*) FROM perf WHERE competition_code = 'FL1') AS total_teams
      FROM comp WHERE match_year = 1997 AND competition_code = 'FL1'""",
)
add(
    PERF,
    agg_distinct_values="SELECT DISTINCT team_name FROM perf",
    srt_team_performance=f"SELECT * FROM perf {TABLE_ORDER}",
    srt_league_table="SELECT team_name, total_points, goal_difference FROM perf WHERE competition_code = 'PL'",
    top_points=f"""SELECT team_name, total_points FROM perf WHERE competition_code = 'PL' {TABLE_ORDER} LIMIT 5""",
    top_goals=f"""SELECT team_name, total_goals_scored FROM perf WHERE competition_code = 'PL'
      {TABLE_ORDER.replace('ORDER BY', 'ORDER BY total_goals_scored DESC,')} LIMIT 5""",
    top_defense=f"""SELECT team_name, total_goals_conceded FROM perf WHERE competition_code = 'PL'
      {TABLE_ORDER.replace('ORDER BY', 'ORDER BY total_goals_conceded,')} LIMIT 5""",
    top_standings20=f"""SELECT team_name, total_points, goal_difference FROM perf WHERE competition_code = 'PL'
      {TABLE_ORDER} LIMIT 20""",
    sel_first_row=f"SELECT * FROM perf WHERE team_name = 'Team 7' {TABLE_ORDER} LIMIT 1",
)
add(
    TEAM_STATS,
    top_team_points5="""SELECT team_name, league_code, total_matches, total_wins, total_draws, total_losses, total_points
      FROM team_stats ORDER BY total_points DESC, team_name, team_id, league_code LIMIT 5""",
)
add(
    PERF + "," + TEAMS.removeprefix(FACT + ","),
    set_union_counts="""SELECT 'fact_matches' AS table_name, COUNT(*) AS row_count FROM fact
      UNION ALL SELECT 'dim_teams', COUNT(*) FROM teams
      UNION ALL SELECT 'agg_team_performance', COUNT(*) FROM perf""",
)

# -- quality --------------------------------------------------------------------------------


def check(name: str, table: str, column: str, failed: str, severity: str = "error") -> str:
    return (f"SELECT '{name}' AS \"check\", '{table}' AS table_name, '{column}' AS column_name, "
            f"{failed} AS failed_rows, '{severity}' AS severity")


def failing(name: str, table: str, column: str, source: str, condition: str, severity: str = "error") -> str:
    return check(name, table, column, f"(SELECT COUNT(*) FROM {source} WHERE {condition})", severity)


def union(*selects: str) -> str:
    return "\nUNION ALL ".join(selects)


def nulls(table: str, source: str, *columns: str) -> list[str]:
    return [failing("not_null", table, c, source, f'"{c}" IS NULL') for c in columns]


def outside(table: str, source: str, column: str, *values: str) -> str:
    domain = ", ".join(f"'{v}'" for v in values)
    return failing("accepted_values", table, column, source, f'"{column}" NOT IN ({domain})')


def repeated(table: str, source: str, column: str, name: str = "unique") -> str:
    keys = f'(SELECT "{column}" FROM {source} WHERE "{column}" IS NOT NULL GROUP BY "{column}" HAVING COUNT(*) > 1) d'
    return check(name, table, column, f"(SELECT COUNT(*) FROM {keys})")


STATUSES4 = ("FINISHED", "IN_PLAY", "PAUSED", "SCHEDULED")
STATUSES9 = (*STATUSES4, "TIMED", "POSTPONED", "CANCELLED", "SUSPENDED", "AWARDED")
RESULTS = ("Home Win", "Away Win", "Draw", "Unknown")


def silver_checks(*leagues: str) -> list[str]:
    return [
        *nulls("stg_matches", "staged", "match_id", "match_datetime", "status", "league_code"),
        outside("stg_matches", "staged", "status", *STATUSES4),
        outside("stg_matches", "staged", "league_code", *leagues),
        outside("stg_matches", "staged", "match_result", *RESULTS),
    ]


SCORES_OK = failing("valid_scores", "fact_matches", "fulltime_score", "fact",
                    "fulltime_home_score < 0 OR fulltime_away_score < 0")
HALFTIME_OK = failing("halftime_within_fulltime", "fact_matches", "halftime_score", "fact",
                      "halftime_home_score > fulltime_home_score OR halftime_away_score > fulltime_away_score")
DATES_OK = failing("reasonable_dates", "fact_matches", "match_date", "fact",
                   "match_date > DATE '2000-12-01' + INTERVAL 30 DAY OR match_date < DATE '1996-01-01'")
ORPHANS = "NOT EXISTS (SELECT 1 FROM {0} t WHERE t.team_id = f.home_team_id)"

add(
    STAGED,
    dq_unique=union(repeated("fact_matches", "fact", "match_id"), repeated("fact_matches", "fact", "home_team_id")),
    dq_not_null=union(*nulls("fact_matches", "fact", "match_id", "home_team_id", "fulltime_home_score", "winner")),
    dq_accepted_values=union(*silver_checks("PL", "FL1"), outside("stg_matches", "staged", "winner", "HOME_TEAM", "DRAW")),
    dq_valid_scores=SCORES_OK,
    dq_halftime=HALFTIME_OK,
    dq_dates=DATES_OK,
    dq_no_duplicates=repeated("fact_matches", "fact", "match_id", "no_duplicates"),
    dq_nonempty_allnull=union(
        failing("all_null_row", "scores", "*", "fact",
                "fulltime_home_score IS NULL AND fulltime_away_score IS NULL AND winner IS NULL", "warn"),
        check("nonempty", "scores", "*", "(SELECT CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END FROM fact)", "warn"),
    ),
    dq_missing_loads="""SELECT c.code AS competition_code, CAST(s.y AS INTEGER) AS season_year
      FROM (VALUES ('PL'), ('FL1'), ('PD'), ('BL1')) c(code), (SELECT unnest(range(lo, hi)) AS y FROM (SELECT MIN(season_year) - 1 AS lo, MAX(season_year) + 2 AS hi FROM bronze) r) s
      WHERE NOT EXISTS (SELECT 1 FROM bronze b WHERE b.competition_code = c.code AND b.season_year = s.y)""",
    dq_landing_files="""SELECT 'all_matches/season_year=' || s.y AS dataset,
      CASE WHEN COUNT(b.id) > 0 THEN 'OK' ELSE 'MISSING' END AS status, COUNT(b.id) AS row_count
      FROM (SELECT unnest(range(lo, hi)) AS y FROM (SELECT MIN(season_year) - 1 AS lo, MAX(season_year) + 2 AS hi FROM bronze) r) s LEFT JOIN bronze b ON b.season_year = s.y GROUP BY s.y
      UNION ALL SELECT 'competitions', 'OK', COUNT(DISTINCT competition_code) FROM bronze""",
)
add(
    TEAMS,
    dq_ref_integrity=failing("referential_integrity", "fact_matches", "home_team_id", "fact f",
                             ORPHANS.format("partial_teams")),
)

EVERYTHING = ",".join([
    STAGED, *(part.removeprefix(FACT + ",") for part in (PERF, COMP, TEAMS)),
    TEAM_STATS.removeprefix(SIDES + NAMED + ","), LEAGUES.removeprefix(M1 + ","),
]) + """,
stg_comp AS (SELECT id AS competition_id, code AS competition_code, name AS competition_name FROM leagues),
standings AS (SELECT competition_code AS league_code, team_name, 1 AS team_rank FROM perf)"""


def health(name: str, source: str, key: str) -> str:
    return (f"SELECT '{name}' AS table_name, COUNT(*) AS row_count, COUNT(DISTINCT {key}) AS unique_keys, "
            f"CASE WHEN COUNT(*) = 0 THEN 'EMPTY' ELSE 'OK' END AS status FROM {source}")


def nonempty(table: str, source: str) -> str:
    return check("nonempty", table, "*", f"(SELECT CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END FROM {source})", "warn")


HEALTH = union(
    health("fact_matches", "fact", "match_id"), health("dim_teams", "teams", "team_id"),
    health("agg_team_performance", "perf", "(competition_code, team_name)"),
    health("agg_competition_stats", "comp", "(match_year, competition_code)"),
)
CONTRACTS = union(
    *nulls("matches", "bronze", "id", "status", "homeTeam_id", "awayTeam_id"),
    outside("matches", "bronze", "status", *STATUSES9),
    failing("status_not_staged", "matches", "status", "bronze",
            "status NOT IN ('FINISHED', 'IN_PLAY', 'PAUSED', 'SCHEDULED')", "warn"),
    nonempty("matches", "bronze"), repeated("matches", "bronze", "id"),
    *silver_checks("PL", "FL1", "PD"), nonempty("stg_matches", "staged"), repeated("stg_matches", "staged", "match_id"),
    *nulls("stg_competitions", "stg_comp", "competition_id", "competition_code", "competition_name"),
    nonempty("stg_competitions", "stg_comp"),
    repeated("stg_competitions", "stg_comp", "competition_id"), repeated("stg_competitions", "stg_comp", "competition_code"),
    SCORES_OK, HALFTIME_OK, DATES_OK, nonempty("fact_matches", "fact"),
    repeated("fact_matches", "fact", "match_id", "no_duplicates"),
    failing("referential_integrity", "fact_matches", "home_team_id", "fact f", ORPHANS.format("teams")),
    *nulls("mart_team_stats", "team_stats", "team_id", "team_name", "league_code", "total_matches", "total_points"),
    outside("mart_team_stats", "team_stats", "league_code", "PL", "FL1", "PD"), nonempty("mart_team_stats", "team_stats"),
    *nulls("mart_league_standings", "standings", "league_code", "team_rank", "team_name"),
    nonempty("mart_league_standings", "standings"),
)
REPORT = f""",
health AS ({HEALTH}),
contracts AS ({CONTRACTS})
SELECT 'payload' AS section, 'matches' AS item, d.measure,
  CAST(CASE d.measure WHEN 'documents' THEN (SELECT COUNT(*) FROM (
    SELECT DISTINCT competition_code, season_year, id // 1000 FROM bronze) pages) ELSE 0 END AS VARCHAR) AS value
  FROM (VALUES ('documents'), ('corrupt'), ('without_records'), ('miscounted')) d(measure)
UNION ALL SELECT 'load', CAST(season_year AS VARCHAR), 'rows_loaded', CAST(COUNT(*) AS VARCHAR) FROM bronze GROUP BY season_year
UNION ALL SELECT 'landing' AS section, 'all_matches/season_year=' || season_year AS item, 'OK' AS measure,
  CAST(COUNT(*) AS VARCHAR) AS value FROM bronze GROUP BY season_year
UNION ALL SELECT 'landing', 'competitions', 'OK', CAST(COUNT(*) AS VARCHAR) FROM leagues
UNION ALL SELECT 'table', table_name, 'row_count', CAST(row_count AS VARCHAR) FROM health
UNION ALL SELECT 'table', table_name, 'unique_keys', CAST(unique_keys AS VARCHAR) FROM health
UNION ALL SELECT 'table', table_name, 'status', status FROM health
UNION ALL SELECT 'metric', 'fact_matches', 'total_matches', CAST(COUNT(DISTINCT match_id) AS VARCHAR) FROM fact
UNION ALL SELECT 'metric', 'fact_matches', 'unique_teams', CAST(COUNT(DISTINCT home_team_id) AS VARCHAR) FROM fact
UNION ALL SELECT 'metric', 'fact_matches', 'total_goals', CAST(SUM(total_goals) AS VARCHAR) FROM fact
UNION ALL SELECT 'freshness', 'fact_matches', 'last_load', '2025-01-06T04:30:00'
UNION ALL SELECT 'test', table_name || '.' || column_name, severity || ':' || "check", CAST(failed_rows AS VARCHAR)
  FROM contracts"""

add(EVERYTHING, dq_gold_tables=HEALTH)
ORACLE["dq_payload_defects"] = """SELECT COUNT(*) AS documents,
  COUNT(*) FILTER (WHERE o_orderkey % 7 = 0) AS corrupt,
  COUNT(*) FILTER (WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 = 0) AS without_records,
  COUNT(*) FILTER (WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 13 = 0) AS miscounted,
  CAST(SUM(CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN 0 WHEN o_orderkey % 13 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS records,
  COUNT(*) FILTER (WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0) AS held
  FROM orders"""
ORACLE["dq_report"] = f"WITH {EVERYTHING.strip()}{REPORT}"
