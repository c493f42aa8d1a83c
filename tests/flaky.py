"""A transport for tests: every request fails first, then answers; long answers are cut at their oldest bars."""

import json
from datetime import date, timedelta


def transport(options):
    seen = {}

    def get(endpoint, asked):
        key = json.dumps(asked, sort_keys=True)
        seen[key] = seen.get(key, 0) + 1
        if asked.get("symbol") == "BAD":
            return 200, '{"Error Message": "no such apikey=secret"}', {}
        if seen[key] <= int(options.get("fails", 1)):
            return (429 if seen[key] % 2 else 503), "", {"Retry-After": "0"}
        if endpoint == "delisted_companies":
            rows = [{"symbol": f"S{k}", "delistedDate": "2020-01-01"} for k in range(25)]
            return 200, json.dumps(rows[10 * asked["page"] : 10 * asked["page"] + 10]), {}
        low, high = date.fromisoformat(asked["from"]), date.fromisoformat(asked["to"])
        days = [low + timedelta(d) for d in range((high - low).days + 1)]
        bars = [{"date": str(d), "adjOpen": 1, "adjHigh": 2, "adjLow": "1", "adjClose": d.toordinal(), "volume": "x", "attempt": seen[key]} for d in days]
        return 200, json.dumps({"historical": bars[-int(options.get("most", 10**9)) :]}), {}

    return get
