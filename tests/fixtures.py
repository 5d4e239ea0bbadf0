"""Hand-written landed documents for the tests: the API's layout, invented values."""

from __future__ import annotations

import json
import os


def fixture(fid, date, status, home, away, goals, ht=(None, None), league=(39, "First Division"),
            season=2024, venue=("Quay Park", "Northgate"), rnd="Regular Season - 4"):
    """One fixture object in the API's nested layout."""
    return {
        "fixture": {"id": fid, "referee": "R. Eferee", "timezone": "UTC", "date": date,
                    "timestamp": 0, "periods": {"first": None, "second": None},
                    "venue": {"id": 1, "name": venue[0], "city": venue[1]},
                    "status": {"long": status, "short": status, "elapsed": 90}},
        "league": {"id": league[0], "name": league[1], "country": "England", "logo": "",
                   "flag": "", "season": season, "round": rnd},
        "teams": {"home": {"id": home[0], "name": home[1], "logo": "", "winner": None},
                  "away": {"id": away[0], "name": away[1], "logo": "", "winner": None}},
        "goals": {"home": goals[0], "away": goals[1]},
        "score": {"halftime": {"home": ht[0], "away": ht[1]},
                  "fulltime": {"home": goals[0], "away": goals[1]},
                  "extratime": {"home": None, "away": None},
                  "penalty": {"home": None, "away": None}},
    }


# Two invented matches: a home win and a draw, three and two goals.
SAMPLE = [
    fixture(700001, "2024-11-01T19:15:00+00:00", "FT", (501, "Northgate"), (502, "Harbour Town"),
            (3, 0), (2, 0)),
    fixture(700002, "2024-11-01T16:00:00+00:00", "FT", (503, "Vale Rovers"), (504, "Eastmoor"),
            (1, 1), (1, 0), venue=("Mill Lane", "Eastmoor")),
]


def envelope(records, league="39", season="2024", date="2024-11-01"):
    return {"get": "fixtures", "parameters": {"league": league, "season": season, "date": date},
            "errors": [], "results": len(records), "paging": {"current": 1, "total": 1},
            "response": records}


def land(base, sport, date, league_id, doc=None, text=None, name=None):
    """Write one landed file as the copy activity names it."""
    folder = os.path.join(base, sport, "raw", date, f"league_{league_id}")
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name or f"fixtures_{league_id}_{date}.json")
    with open(path, "w") as fh:
        fh.write(text if text is not None else json.dumps(doc, indent=2))
    return path


def land_records(base, sport, date, league_id, records):
    """JSON Lines layout: one fixture object per line."""
    return land(base, sport, date, league_id,
                text="\n".join(json.dumps(r) for r in records) + "\n")
