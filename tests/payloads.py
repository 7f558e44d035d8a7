"""Small synthetic landing payloads (our own, not copied from any sample)."""

from __future__ import annotations

import datetime as dt
import json
import os

REGIONS = ("Central", "North", "South")
ZONE_REGION = {f"Z{i}": ("Central" if i <= 4 else "North" if i <= 7 else "South") for i in range(1, 11)}


def _hours(day: str, hours=range(24)):
    d = dt.datetime.fromisoformat(day)
    for h in hours:
        s = d + dt.timedelta(hours=h)
        yield h, s.isoformat(), (s + dt.timedelta(hours=1)).isoformat()


def actual_records(day: str, hours=range(24), regions=REGIONS, load=None):
    out = []
    for h, start, end in _hours(day, hours):
        for i, r in enumerate(regions):
            value = load(h, r) if load else round(10000 + 1000 * i + 37.5 * h, 2)
            out.append({"timeInterval": {"resolution": "hourly", "start": start, "end": end,
                                         "value": str(h + 1)}, "region": r, "load": value})
    return out


def forecast_records(day: str, init: str | None = None, hours=range(24), zones=tuple(ZONE_REGION), value=None):
    init = init or (dt.date.fromisoformat(day[:10]) - dt.timedelta(days=1)).isoformat()
    out = []
    for h, start, end in _hours(day, hours):
        for z in zones:
            v = value(h, z) if value else round(1000 + 10 * int(z[1:]) + 3.25 * h, 2)
            out.append({"timeInterval": {"resolution": "hourly", "start": start, "end": end,
                                         "value": str(h + 1)}, "region": ZONE_REGION.get(z, "Central"),
                        "localResourceZone": z, "loadForecast": v, "init": init})
    return out


def write(folder: str, name: str, records=None, raw: str | None = None) -> str:
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(raw if raw is not None else json.dumps({"data": records}, indent=2))
    return path
