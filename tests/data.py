"""Small hand-built capture tables."""

from datetime import datetime

from footfall.sources.captures import REQUIRED

DAY = "2024-03-05"


def at(clock, day=DAY):
    return datetime.fromisoformat(f"{day} {clock}")


def captures(spark, rows, day=DAY):
    """Rows of (profile, clock or datetime, region) plus optional overrides as a dict."""
    full = []
    for i, (profile, clock, region, *more) in enumerate(rows):
        extra = more[0] if more else {}
        when = clock if isinstance(clock, datetime) else at(clock, extra.get("day", day))
        row = {
            "capture_id": i, "profile_id": profile, "profile_type": 1, "member_tier": "Gold", "age": 30,
            "gender": 1, "region_id": region, "region_name": f"R{region}", "camera_id": 94,
            "capture_time": when, **{k: v for k, v in extra.items() if k != "day"},
        }
        full.append(tuple(row[f.name] for f in REQUIRED.fields))
    return spark.createDataFrame(full, REQUIRED)


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
