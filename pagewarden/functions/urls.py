"""URLs: splitting, parsing and normalising, keys, and tests on normalised URLs.

Parsing by the WHATWG rules runs in one Arrow UDF; everything on normalised URLs is a column expression.
"""

from __future__ import annotations

import re
import unicodedata
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import vocab as V

PREPARED = T.StructType([T.StructField(n, T.StringType()) for n in ("raw", "normalized", "dedup_key", "host_key", "rejection")])
_UNRESERVED = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-._~")
_DEFAULT_PORT = {"http": 80, "https": 443, "ftp": 21, "ws": 80, "wss": 443}
_HEX = re.compile("%([0-9A-Fa-f]{2})")


def split_joined(value: Column) -> Column:
    """Parts of a comma-joined value; only a comma right before http:// or https:// separates."""
    return F.split(value, ",(?=https?://)")


def normalize_percent(value: str) -> str:
    """Unreserved characters decoded, other escapes in upper case, malformed ones kept."""
    return _HEX.sub(lambda m: chr(b) if (b := int(m[1], 16)) in _UNRESERVED else f"%{m[1].upper()}", value)


def normalize_query(query: str) -> str:
    pairs = [p for p in query.split("&") if p and p.partition("=")[0] not in V.TRACKING]
    return "&".join(sorted((normalize_percent(p) for p in pairs), key=str.encode))


def _host(host: str) -> str | None:
    """A lower-case ASCII host, a bracketed IPv6 address, or None."""
    if host.startswith("["):
        import ipaddress

        try:
            return f"[{ipaddress.IPv6Address(host[1:-1]).compressed}]" if host.endswith("]") else None
        except ValueError:
            return None
    from urllib.parse import unquote

    host = unicodedata.normalize("NFKC", unquote(host)).lower().replace("。", ".")
    if not host.isascii():
        try:
            import idna

            host = idna.encode(host, uts46=True).decode()
        except Exception:
            return None
    if not host or re.search(r"[\x00-\x20#%/:<>?@\[\\\]^|\x7f]", host):
        return None
    last = host.rstrip(".").rsplit(".", 1)[-1]
    if last.isdigit() or re.fullmatch("0x[0-9a-f]*", last):  # then it must be an IPv4 address
        try:
            parts = [int(p, 16) if p.startswith("0x") else int(p, 8) if len(p) > 1 and p[0] == "0" else int(p) for p in host.rstrip(".").split(".")]
        except ValueError:
            return None
        if len(parts) > 4 or any(p > 255 for p in parts[:-1]) or parts[-1] >= 256 ** (5 - len(parts)):
            return None
        n = parts[-1] + sum(p << 8 * (3 - i) for i, p in enumerate(parts[:-1]))
        return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))
    return host


def _path(path: str) -> str:
    """An absolute path with dot segments resolved."""
    out: list[str] = []
    parts = path.replace("\\", "/").lstrip("/").split("/") if path else [""]
    if path.replace("\\", "/").startswith("//"):
        parts = path.replace("\\", "/")[1:].split("/")
    for i, p in enumerate(parts):
        low, last = p.lower().replace("%2e", "."), i == len(parts) - 1
        if low == "..":
            out = out[:-1]
            if last:
                out.append("")
        elif low == ".":
            if last:
                out.append("")
        else:
            out.append(p)
    return "/" + "/".join(quote(p, safe="!$&'()*+,;=:@-._~%/|[]\\^") for p in out)


def parse(raw: str) -> tuple[str, str | None, int | None, str, str | None, str | None] | None:
    """(scheme, host, explicit port other than the scheme's own, path, query, fragment), or None if unreadable."""
    text = re.sub(r"[\t\n\r]", "", raw.strip("".join(map(chr, range(33)))))
    m = re.match(r"([A-Za-z][A-Za-z0-9+.\-]*):(.*)", text, re.S)
    if not m:
        return None
    scheme, rest = m[1].lower(), m[2]
    rest, _, fragment = rest.partition("#")
    fragment = fragment if "#" in m[2] else None
    if scheme not in _DEFAULT_PORT:
        slashes = re.match(r"//([^/?]*)(.*)", rest, re.S)
        return scheme, (slashes[1] or None) if slashes else None, None, slashes[2] if slashes else rest, None, fragment
    rest = re.sub(r"^[/\\]*", "", rest)
    authority = re.match(r"[^/\\?]*", rest)[0]
    path, mark, query = rest[len(authority) :].partition("?")
    authority = authority.rpartition("@")[2]
    pm = re.fullmatch(r"(\[[^\]]*\]|[^:]*)(?::([0-9]*))?", authority)
    if not pm:
        return None
    host = _host(pm[1]) if pm[1] else None
    if host is None:
        return None
    port = int(pm[2]) if pm[2] else None
    if port is not None and port > 65535:
        return None
    query = quote(query, safe="!$&()*+,;=:@-._~%/?|[]\\^`{}") if mark else None
    return scheme, host, None if port == _DEFAULT_PORT[scheme] else port, _path(path), query, fragment


def prepare(raw: str | None) -> dict | None:
    """What a URL becomes before it is used; ``rejection`` says why it is not."""
    if raw is None:
        return None
    raw = raw.strip()
    out = {"raw": raw, "normalized": None, "dedup_key": None, "host_key": None, "rejection": None}
    parts = parse(raw)
    if parts is None:
        return out | {"rejection": "unparsable"}
    scheme, host, port, path, query, _ = parts
    if scheme not in V.SCHEMES:
        return out | {"rejection": "scheme"}
    if port is not None:
        return out | {"rejection": "port"}
    if not host:
        return out | {"rejection": "no_host"}
    query = normalize_query(query or "")
    tail = f"?{query}" if query else ""
    path = normalize_percent(path)
    strip = V.SITE_RULES.get(host)
    keyed = "/" + path[len(strip) :] if strip and path.startswith(strip) else path
    return out | {"normalized": f"{scheme}://{host}{path}{tail}", "dedup_key": f"{scheme}://{host}{keyed}{tail}", "host_key": f"{scheme}://{host}"}


@F.pandas_udf(PREPARED)
def prepared(raw: pd.Series) -> pd.DataFrame:
    """prepare() as a column; a null URL gives a struct of nulls."""
    rows = [prepare(x if isinstance(x, str) else None) or dict.fromkeys(PREPARED.names) for x in raw]
    return pd.DataFrame(rows, columns=PREPARED.names)


def join_url(base: str | None, link: str | None) -> str | None:
    """A link resolved against its page, without normalising; None if either cannot be read."""
    if link is None:
        return None
    link = re.sub(r"[\t\n\r]", "", link.strip("".join(map(chr, range(33)))))
    if re.match(r"[A-Za-z][A-Za-z0-9+.\-]*:", link):
        return _text(parse(link))
    b = parse(base) if base else None
    if b is None or b[0] not in _DEFAULT_PORT:
        return None
    scheme, host, port, path, query, _ = b
    if re.match(r"[/\\]{2}", link):
        return _text(parse(f"{scheme}:{link}"))
    origin = f"{scheme}://{host}" + (f":{port}" if port else "")
    rest, _, fragment = link.partition("#")
    mark = f"#{fragment}" if "#" in link else ""
    if not rest:
        return _text(parse(origin + path + (f"?{query}" if query is not None else "") + mark))
    if rest[0] in "/\\":
        return _text(parse(origin + rest + mark))
    if rest[0] == "?":
        return _text(parse(origin + path + rest + mark))
    return _text(parse(origin + path.rpartition("/")[0] + "/" + rest + mark))


def _text(parts) -> str | None:
    if parts is None:
        return None
    scheme, host, port, path, query, fragment = parts
    head = f"{scheme}://{host}" if host else f"{scheme}:"
    return head + (f":{port}" if port else "") + path + (f"?{query}" if query is not None else "") + (f"#{fragment}" if fragment is not None else "")


@F.pandas_udf(T.StringType())
def joined(base: pd.Series, link: pd.Series) -> pd.Series:
    return pd.Series([join_url(b if isinstance(b, str) else None, x if isinstance(x, str) else None) for b, x in zip(base, link)])


# ---- on normalised URLs ----------------------------------------------------------------------------------------------


def normalize_plain(url: Column) -> Column:
    """The normal form of a URL that is already plain ASCII with a lower-case host and no escapes or dot segments: no
    fragment, no tracking parameters, the others in byte order. Stays in the JVM; prepared() takes every URL."""
    bare = F.regexp_replace(url, "#.*$", "")
    path, query = F.substring_index(bare, "?", 1), F.when(F.instr(bare, "?") > 0, F.substring(bare, F.instr(bare, "?") + 1, F.length(bare))).otherwise(F.lit(""))
    pairs = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.substring_index(p, "=", 1).isin(*V.TRACKING)))
    return F.when(F.size(pairs) > 0, F.concat(path, F.lit("?"), F.array_join(pairs, "&"))).otherwise(path)


def dedup_key(normalized: Column) -> Column:
    out = normalized
    for host, prefix in V.SITE_RULES.items():
        out = F.regexp_replace(out, rf"^(https?://{re.escape(host)}){prefix}", "$1/")
    return out


def host_key(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"^(https?://[^/?#]+)", 1), F.lit(""))


def hostname(key: Column) -> Column:
    return F.regexp_replace(key, r"^https?://", "")


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^https?://[^/?#]*([^?#]*)", 1)


def is_top_page(url: Column) -> Column:
    """No query, and the path is / or /index.something."""
    return url.rlike(r"^https?://[^/?#]+/?(?:index\.[^/?#]*)?(?:#.*)?$")


def parent_dir(url: Column) -> Column:
    """The directory above, with its slash; null if the URL has none."""
    return F.nullif(F.regexp_extract(F.regexp_replace(url, r"[?#].*$", ""), V.PARENT_PATTERN, 1), F.lit(""))


def _extension(url: Column) -> Column:
    return F.lower(F.regexp_extract(path_of(url), r"\.([^./]*)$", 1))


def page_like(url: Column) -> Column:
    name = F.regexp_extract(path_of(url), r"([^/]*)$", 1)
    return F.instr(url, "://").cast("boolean") & ((F.instr(name, ".") == 0) | _extension(url).isin(*V.PAGE_EXTENSIONS))


def html_like(url: Column) -> Column:
    name = F.regexp_extract(path_of(url), r"([^/]*)$", 1)
    return (F.instr(name, ".") == 0) | _extension(url).isin(*V.HTML_EXTENSIONS)


def is_form(url: Column) -> Column:
    return F.contains(path_of(url), F.lit(V.FORM_PATH))


def extract_urls(text: Column) -> Column:
    """URLs in free text, split where two are joined, without trailing marks."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(V.URL_PATTERN), F.lit(0))
    parts = F.flatten(F.transform(found, lambda u: F.split(u, "[,;](?=https?://)")))
    return F.transform(parts, lambda u: F.regexp_replace(u, r"[.,;:()']+$", ""))
