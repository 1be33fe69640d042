"""Schemas of the engine's tables; explicit, never inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def struct(ddl: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in ddl.items()])


_S, _I, _L, _B, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.TimestampType()
_CODES = T.ArrayType(_S)

AREAS = struct({"code": _S, "name": _S, "parent_code": _S})
PROGRAMS = struct({"id": _S, "psid": _S, "um": _S, "area_code": _S, "canonical_name": _S, "short_name": _S, "source_url": _S, "category_codes": _CODES, "target_codes": _CODES, "content_codes": _CODES, "age_min_months": _I, "age_max_months": _I, "registry": _S, "imported_at": _TS})
URLS = struct({"id": _S, "raw_url": _S, "normalized_url": _S, "dedup_key": _S, "host_key": _S, "role": _S, "depth": _I, "priority": _I, "status": _S, "next_crawl_at": _TS, "last_crawled_at": _TS, "attempt_count": _I, "retry_count": _I, "worker_id": _S, "lease_until": _TS, "claim_token": _L, "last_error_type": _S, "recrawl_interval_secs": _I})
PROGRAM_URLS = struct({"program_id": _S, "url_id": _S, "role": _S, "rank": _I, "source": _S})
RESOURCES = struct({"id": _S, "canonical_url": _S, "final_url": _S, "declared_canonical_url": _S, "canonical_source": _S, "state": _S, "etag": _S, "last_modified": _S, "raw_hash": _S, "page_hash": _S, "title_hash": _S, "body_hash": _S, "links_hash": _S, "page_updated_on": T.DateType(), "extractor_version": _I, "extractor_rule": _S, "robots_meta": _S, "last_crawled_at": _TS, "last_changed_at": _TS, "consecutive_not_found": _I, "moved_to_resource_id": _S, "change_count": _I})
URL_RESOURCES = struct({"url_id": _S, "resource_id": _S, "relation": _S, "observed_at": _TS})
HOST_MOVES = struct({"from_host_key": _S, "to_host_key": _S, "status": _S, "sample_url": _S, "first_seen_at": _TS, "last_seen_at": _TS})
FETCH_HISTORY = struct({"run_id": _S, "url_id": _S, "fetched_at": _TS, "attempt": _I, "http_status": _I, "response_time_ms": _L, "bytes": _L, "outcome": _S, "error_type": _S, "error_detail": _S, "etag": _S, "last_modified": _S, "raw_hash": _S, "body_hash": _S, "extractor_version": _I, "declared_canonical_url": _S, "content_type": _S, "charset": _S, "charset_source": _S, "charset_replaced": _B, "observation": _S})
CONTENT_VERSIONS = struct({"resource_id": _S, "body_hash": _S, "created_at": _TS, "title": _S, "page_updated_on": T.DateType(), "extractor_version": _I})
PAGE_LINKS = struct({"resource_id": _S, "url": _S, "dedup_key": _S, "host_key": _S, "text": _S})
CRAWL_RUNS = struct({"id": _S, "kind": _S, "started_at": _TS, "finished_at": _TS, "config": _S, "stats": _S, "alerts": _S})

TABLES = {"areas": AREAS, "programs": PROGRAMS, "urls": URLS, "program_urls": PROGRAM_URLS, "resources": RESOURCES, "url_resources": URL_RESOURCES, "host_moves": HOST_MOVES, "fetch_history": FETCH_HISTORY, "content_versions": CONTENT_VERSIONS, "page_links": PAGE_LINKS, "crawl_runs": CRAWL_RUNS}

_BOUND = struct({"targetAge": _I, "targetAgeOfMonths": _I})
REGISTRY = struct({
    "institutionName": struct({"canonicalName": _S, "shortName": _S}),
    "target": struct({k: _BOUND for k in ("lessThan", "lessThanOrEqualTo", "greaterThanOrEqualTo", "greaterThan")}),
    "localGovernmentLink": struct({"uri": _S}), "area": struct({"areaCode": _S}), "basicInformation": struct({"psid": _S}),
    "tag": struct({"categoryCode": _CODES, "targetCode": _CODES, "contentsCode": _CODES}),
})
REVIEWS = struct({"reviewed_at": _S, "reviews": T.ArrayType(struct({"program_id": _S, "dead_url": _S, "verdict": _S, "url": _S, "host_move": _B, "rejected": T.ArrayType(_S)}))})
HOPS = T.ArrayType(struct({"url": _S, "status": _I, "elapsed_ms": _L}))
FETCHES = struct({"url_id": _S, "url": _S, "hops": HOPS, "outcome": _S, "status": _I, "etag": _S, "last_modified": _S, "content_type": _S, "x_robots_tag": _S, "body": T.BinaryType(), "error": struct({"host_key": _S, "location": _S, "kind": _S, "detail": _S})})
