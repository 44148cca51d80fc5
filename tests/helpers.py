"""Hand-made rows shared by the tests."""

import json
from datetime import datetime, timezone

from scorelake.schemas import GAME, SILVER

AT = datetime(2026, 1, 2, 3, 4, 5, 678901, tzinfo=timezone.utc)


def game(id=1, score=80, consoles=("Wii",), released="2022-02-03", **other):
    platforms = None
    if consoles is not None:
        platforms = [
            None if name is None else {"platform": {"id": 7, "name": name, "slug": None}}
            for name in consoles
        ]
    row = {
        "id": id,
        "name": f"Game {id}",
        "released": released,
        "metacritic": float(score) if isinstance(score, int) else score,
        "platforms": platforms,
        "genres": [{"id": 1, "name": "Action", "slug": "action"}],
        "esrb_rating": {"id": 1, "name": "Teen", "slug": "teen"},
    }
    return row | other


def bronze(spark, games, month="2022-02"):
    rows = [(AT, one, month) for one in games]
    schema = f"downloaded_at timestamp, game {GAME.simpleString()}, date string"
    return spark.createDataFrame(rows, schema)


def silver(spark, rows):
    """Rows of ``(game_id, score, consoles)`` as a silver table."""
    full = [
        ("2022-02", f"Game {id}", None, score, id, consoles, None, None)
        for id, score, consoles in rows
    ]
    return spark.createDataFrame(full, SILVER)


def land(raw, month, *pages):
    """Write pages as the indented files a download leaves behind."""
    folder = raw / f"date={month}"
    folder.mkdir(parents=True, exist_ok=True)
    for number, games in enumerate(pages, 1):
        page = {"downloaded_at": AT.isoformat(), "results": games}
        text = json.dumps(page, ensure_ascii=False, indent=2)
        (folder / f"page_{number}.json").write_text(text, encoding="utf-8")
