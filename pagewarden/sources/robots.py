"""robots.txt: fetched once for each host of a run, by the rules of a live fetch, and asked for each URL.

2xx is parsed, a redirect is followed (five at most, then no limits; out of scope also means no limits), other 3xx and 4xx
mean no limits, everything else that the host cannot be fetched from now."""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import unquote

from ..functions import vocab as V
from ..functions.urls import join_url, prepare

_REDIRECTS = (301, 302, 303, 307, 308)


class Rules:
    """The groups of a file that speak to an agent: its own, otherwise those for all. The longest matching path decides, of
    equally long ones the one that allows."""

    def __init__(self, text: str, agent: str):
        groups: dict[str, dict] = {}
        names: list[str] = []
        open_ = False
        for line in text.lstrip("﻿").splitlines():
            key, colon, value = line.split("#", 1)[0].partition(":")
            key, value = key.strip().lower(), value.strip()
            if not colon:
                continue
            if key == "user-agent":
                names = [*names, value.lower()] if open_ else [value.lower()]
                open_ = True
                groups.setdefault(value.lower(), {"rules": [], "delay": None})
                continue
            open_ = False
            for n in names:
                if key in ("allow", "disallow") and value:
                    groups[n]["rules"].append((value, key == "allow"))
                elif key == "crawl-delay" and re.fullmatch(r"\d+(\.\d+)?", value):
                    groups[n]["delay"] = float(value)
        mine = groups.get(agent.lower()) or groups.get("*") or {"rules": [], "delay": None}
        self.rules = [(len(p), allow, self._pattern(p)) for p, allow in mine["rules"]]
        self.delay = mine["delay"]

    @staticmethod
    def _pattern(path: str) -> re.Pattern:
        end = path.endswith("$")
        parts = unquote(path.removesuffix("$")).split("*")
        return re.compile(".*".join(map(re.escape, parts)) + (r"\Z" if end else ""))

    def allows(self, url: str) -> bool:
        path = unquote(re.sub(r"^[a-z]+://[^/?#]*", "", url).split("#")[0]) or "/"
        found = [(length, allow) for length, allow, p in self.rules if p.match(path)]
        return not found or max(found)[1]


class Robots:
    """What hosts allow, each asked once through the same exchanges as pages."""

    def __init__(self, agent: str, allowed: set[str], exchange: Callable):
        self.agent, self.allowed, self.exchange, self.known = agent, allowed, exchange, {}

    def of(self, host_key: str) -> Rules | str:
        """The host's rules, or allow or unavailable."""
        if host_key not in self.known:
            self.known[host_key] = self._load(host_key)
        return self.known[host_key]

    def _load(self, host_key: str) -> Rules | str:
        url = f"{host_key}/robots.txt"
        for _ in range(V.MAX_REDIRECTS + 1):
            ready = prepare(url)
            if not ready or ready["rejection"] or ready["host_key"] not in self.allowed:
                return "allow"
            got = self.exchange(ready["normalized"])
            if isinstance(got, str):
                return "unavailable"
            status, headers, body = got
            if status in _REDIRECTS and headers.get("location"):
                url = join_url(ready["normalized"], headers["location"]) or headers["location"]
                continue
            if 200 <= status < 300:
                return Rules(body[: V.ROBOTS_LIMIT].decode("utf-8", "replace"), self.agent)
            return "allow" if 300 <= status < 500 else "unavailable"
        return "allow"

    def __call__(self, host_key: str, url: str | None = None) -> str:
        """allow, deny or unavailable."""
        rules = self.of(host_key)
        if isinstance(rules, str):
            return rules
        return "allow" if url is None or rules.allows(url) else "deny"

    def delay(self, host_key: str) -> float | None:
        rules = self.of(host_key)
        return rules.delay if isinstance(rules, Rules) and rules.delay else None
