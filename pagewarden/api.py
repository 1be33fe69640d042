"""Readers' answers as JSON-ready values, over a store; a web server only has to map paths to these functions."""

from __future__ import annotations

import json
import re

from pyspark.sql import functions as F

from .functions import vocab as V
from .operators import facts
from .operators.store import Store

ATTRIBUTION = "Source: public program registry"
_UUID = re.compile("[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}")


class NotFound(Exception):
    """404"""


class BadRequest(Exception):
    """400"""


def _body(data) -> dict:
    return {"data": data, "attribution": ATTRIBUTION}


def _rows(df) -> list[dict]:
    return [json.loads(x) for x in df.toJSON().collect()]


def error(exc: Exception) -> tuple[int, dict]:
    return (404 if isinstance(exc, NotFound) else 400 if isinstance(exc, BadRequest) else 500), {"error": {"message": str(exc)}}


def areas(store: Store) -> dict:
    return _body(_rows(store.read("areas").orderBy("code")))


def _facts(store: Store, programs):
    return facts.facts(programs, *(store.read(t) for t in ("program_urls", "urls", "url_resources", "resources")))


def area_programs(store: Store, code: str, age_months: str | None = None, category: str | None = None) -> dict:
    """Programs of an area with their facts, in the readers' order."""
    if age_months is not None and not re.fullmatch("[0-9]+", age_months):
        raise BadRequest("age_months must be a whole number, 0 or more")
    table = store.read("areas")
    if table.where(F.col("code") == code).isEmpty():
        raise NotFound(f"no area {code}")
    found = facts.area_programs(store.read("programs"), table, code, int(age_months) if age_months else None, category)
    with_facts = found.drop("source_url", "imported_at").join(_facts(store, found), "id")
    return _body(_rows(with_facts.orderBy(F.desc("area_code"), F.substring("um", 3, 20).cast("int").asc(), F.asc("psid"))))


def program(store: Store, program_id: str) -> dict:
    """One program with its registry row; a malformed id is unknown."""
    found = store.read("programs").where(F.col("id") == program_id)
    if not _UUID.fullmatch(program_id) or found.isEmpty():
        raise NotFound(f"no program {program_id}")
    return _body(_rows(found.join(_facts(store, found), "id"))[0])


def tags() -> dict:
    return _body({k: [{"code": c, "name": n} for c, n in v] for k, v in V.TAGS.items()})
