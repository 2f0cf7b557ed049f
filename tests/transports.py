"""Scripted answers in place of a routing service, by corridor id."""

import io
import json
from urllib.error import HTTPError

GOOD = {"routes": [{"duration": "130s", "staticDuration": "100s", "distanceMeters": 900}]}
CALLS: dict[str, int] = {}


def http_error(code: int) -> HTTPError:
    return HTTPError("http://routing.invalid", code, f"status {code}", None, io.BytesIO())


def scripted(corridor: dict, options: dict) -> str:
    name = corridor["corridor_id"]
    CALLS[name] = CALLS.get(name, 0) + 1
    if name == "busy" and CALLS[name] == 1:
        raise http_error(429)
    if name == "gone":
        raise http_error(404)
    if name == "slow":
        raise TimeoutError("timed out")
    if name == "empty":
        return json.dumps({"routes": []})
    if name == "zero":
        return json.dumps({"routes": [{"duration": "5s", "staticDuration": "0s"}]})
    return json.dumps(GOOD)
