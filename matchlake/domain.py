"""Fixed values of the match data contracts."""

# Competitions and seasons loaded when the caller names none.
DEFAULT_LEAGUES = ("PL", "FL1", "PD")
DEFAULT_SEASONS = (2023, 2024)

# Status domain accepted on the source (bronze) and on the staging table (silver).
SOURCE_STATUSES = (
    "FINISHED", "SCHEDULED", "IN_PLAY", "PAUSED", "TIMED",
    "POSTPONED", "CANCELLED", "SUSPENDED", "AWARDED",
)
STAGED_STATUSES = ("FINISHED", "IN_PLAY", "PAUSED", "SCHEDULED")
FINISHED = "FINISHED"

# Outcome labels and the winner codes of the payload.
HOME_WIN, AWAY_WIN, DRAW, UNKNOWN = "Home Win", "Away Win", "Draw", "Unknown"
MATCH_RESULTS = (HOME_WIN, AWAY_WIN, DRAW, UNKNOWN)
WINNER_HOME, WINNER_AWAY, WINNER_DRAW = "HOME_TEAM", "AWAY_TEAM", "DRAW"

# League points, and the goal count a match must exceed to be high scoring.
POINTS_WIN, POINTS_DRAW, POINTS_LOSS = 3, 1, 0
HIGH_SCORING_OVER = 3

# Date rule bounds: no match before MIN_MATCH_DATE or more than MAX_DAYS_AHEAD days ahead.
MIN_MATCH_DATE = "2020-01-01"
MAX_DAYS_AHEAD = 30

# Storage layers, one catalog database each.
LAYERS = ("bronze", "silver", "gold")

# Columns shown by the recent-match reports and by the standings table.
RECENT_COLUMNS = (
    "match_date", "competition_name", "home_team_name", "away_team_name",
    "fulltime_home_score", "fulltime_away_score", "match_outcome",
)
STANDINGS_COLUMNS = (
    "team_name", "total_matches", "total_wins", "total_draws", "total_losses",
    "total_goals_scored", "total_goals_conceded", "goal_difference", "total_points",
    "win_percentage", "points_per_match",
)

# Gold tables checked after a load, with the key each one is counted by.
GOLD_TABLE_KEYS = {
    "fact_matches": ("match_id",),
    "dim_teams": ("team_id",),
    "agg_team_performance": ("competition_code", "team_name"),
    "agg_competition_stats": ("match_year", "competition_code"),
}
