"""Hand-made payloads and staged matches."""

import datetime as dt

STAGED = (
    "match_id bigint, match_datetime timestamp_ntz, status string, league_code string, competition_name string, "
    "home_team_id bigint, home_team_name string, away_team_id bigint, away_team_name string, "
    "full_time_home_score bigint, full_time_away_score bigint, half_time_home_score bigint, "
    "half_time_away_score bigint, winner string, match_result string"
)


def payload_match(match_id, status="FINISHED", home=(1, "A"), away=(2, "B"), score=(2, 1), half=(1, 0), **more):
    finished = score[0] is not None
    winner = None
    if finished:
        winner = "HOME_TEAM" if score[0] > score[1] else "AWAY_TEAM" if score[0] < score[1] else "DRAW"
    return {
        "id": match_id, "utcDate": f"2023-08-{match_id:02d}T19:00:00Z", "status": status,
        "homeTeam": {"id": home[0], "name": home[1]}, "awayTeam": {"id": away[0], "name": away[1]},
        "competition": {"code": "XX"},
        "score": {
            "winner": winner,
            "fullTime": {"home": score[0], "away": score[1]}, "halfTime": {"home": half[0], "away": half[1]},
        },
        "referees": [{"id": 9, "name": None}],
        **more,
    }


def envelope(*matches):
    return {"extracted_at": "2024-01-01T00:00:00", "data": {"matches": list(matches)}, "record_count": len(matches)}


def staged(match_id, day, home, away, score, status="FINISHED", league="PL", hour=12):
    """A staged match row between (id, name) teams."""
    h, a = score
    if h is None or a is None:
        winner, result = None, "Unknown"
    elif h == a:
        winner, result = "DRAW", "Draw"
    else:
        winner, result = ("HOME_TEAM", "Home Win") if h > a else ("AWAY_TEAM", "Away Win")
    half = (None, None) if h is None else (h // 2, a // 2)
    names = {"PL": "Premier League", "FL1": "Ligue 1", "PD": "La Liga"}
    return (
        match_id, dt.datetime(2023, 9, day, hour), status, league, names[league], *home, *away, h, a, *half, winner, result,
    )


A, B, C = (1, "Alpha"), (2, "Beta"), (3, "Gamma")

SEASON = [
    staged(1, 1, A, B, (2, 1)),
    staged(2, 2, B, C, (0, 0)),
    staged(3, 3, C, A, (1, 4)),
    staged(4, 4, A, C, (3, 3)),
    staged(5, 5, B, A, (5, 0)),
    staged(6, 6, C, B, (0, 2)),
    staged(7, 7, A, B, (None, None), "SCHEDULED"),
    staged(8, 8, A, C, (None, None), "IN_PLAY"),
]
