"""Plain sequential replay of matches, written for clarity: what the Spark plans must agree with."""

from __future__ import annotations

from collections import defaultdict

from duelframe.schema import ELO, PRIORS


def chronological(rows):
    return sorted(rows, key=lambda r: (r["match_datetime"], r["home_team"], r["away_team"], r["match_id"]))


def mean(values, default):
    return sum(values) / len(values) if values else default


def replay(rows):
    """match_id -> feature dict, plus the final ratings."""
    rating = defaultdict(lambda: ELO["initial_rating"])
    past, last = defaultdict(list), {}
    out = {}
    for r in chronological(rows):
        f = {}
        for side, team in (("home", r["home_team"]), ("away", r["away_team"])):
            seen = past[team]
            for name, field, n in (
                ("points_5", "points", 5),
                ("points_10", "points", 10),
                ("goal_diff_5", "goal_diff", 5),
                ("goal_diff_10", "goal_diff", 10),
                ("goals_for_5", "goals_for", 5),
                ("goals_against_5", "goals_against", 5),
            ):
                f[f"{side}_{name}"] = mean([e[field] for e in seen[-n:]], PRIORS[field])
            venue = [e["points"] for e in seen if e["side"] == side]
            f[f"{side}_{side}_points_5"] = mean(venue[-5:], PRIORS["points"])
            f[f"{side}_rest_days"] = float((r["match_date"] - last[team]).days) if team in last else PRIORS["rest_days"]
            f[f"elo_{side}"] = rating[team]
        f["rest_days_diff"] = f["home_rest_days"] - f["away_rest_days"]
        f["elo_diff"] = f["elo_home"] - f["elo_away"]
        out[r["match_id"]] = f

        h, a = r["home_goals"], r["away_goals"]
        hp, ap = {"H": (3, 0), "D": (1, 1), "A": (0, 3)}[r["ftr"]]
        for side, team, gf, ga, pts in (("home", r["home_team"], h, a, hp), ("away", r["away_team"], a, h, ap)):
            past[team].append({"side": side, "points": pts, "goals_for": gf, "goals_against": ga, "goal_diff": gf - ga})
            last[team] = r["match_date"]
        gap = f["elo_away"] - f["elo_home"] - ELO["home_advantage"]
        change = ELO["k_factor"] * ({"H": 1.0, "D": 0.5, "A": 0.0}[r["ftr"]] - 1 / (1 + 10 ** (gap / 400)))
        rating[r["home_team"]] += change
        rating[r["away_team"]] -= change
    return out, dict(rating)


def rounds(rows):
    """match_id -> matchday, per season."""
    out = {}
    state = {}
    for r in chronological(rows):
        day, seen = state.get(r["season"], (1, set()))
        if {r["home_team"], r["away_team"]} & seen:
            day, seen = day + 1, set()
        state[r["season"]] = (day, seen | {r["home_team"], r["away_team"]})
        out[r["match_id"]] = day
    return out
