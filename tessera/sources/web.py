"""Static pages over HTTP (survey A4, A5): one GET each, with every address and every redirect checked first.

The connection goes to the address that was checked: the name isn't resolved again. Pages are read from a table of urls by
`fetch_urls`, or by spark.read.format("tessera_pages") after `register`, in both ways host by host."""

from __future__ import annotations

import http.client
import importlib
import ipaddress
import socket
import ssl
import time
from collections.abc import Callable, Iterator
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tessera.sources.readers import Limits

FETCHED = "url string, final_url string, status int, media_type string, size_bytes long, text string, code string, redirects array<string>, etag string, last_modified string"
HTML_TYPES = ("text/html", "application/xhtml+xml")


def blocked_address(address: str) -> bool:
    """A5: whether an address is private or otherwise not for the open web."""
    try:
        ip = ipaddress.ip_address(address)
    except ValueError:
        return True
    ip = getattr(ip, "ipv4_mapped", None) or ip
    return ip.is_private or ip.is_loopback or ip.is_link_local or ip.is_multicast or ip.is_unspecified or ip.is_reserved


@F.arrow_udf(T.BooleanType())
def _blocked(addresses: pa.Array) -> pa.Array:
    return pa.array([blocked_address(a.as_py() or "") for a in addresses], pa.bool_())


def is_blocked_address(address: Column) -> Column:
    return _blocked(address)


Resolver = Callable[[str, int], list[str]]
#: A transport takes (url, timeout, the checked address) and gives (status, headers in lower case, a reader of so many bytes).
Transport = Callable[[str, float, str], tuple[int, dict[str, str], Callable[[int], bytes]]]


def resolve(host: str, port: int) -> list[str]:
    return sorted({info[4][0] for info in socket.getaddrinfo(host, port, type=socket.SOCK_STREAM)})


class _Plain(http.client.HTTPConnection):
    """Goes to `address`, whatever the host's name resolves to by now."""

    address = ""

    def connect(self) -> None:
        self.sock = socket.create_connection((self.address, self.port), self.timeout)


class _Secure(http.client.HTTPSConnection):
    address = ""

    def connect(self) -> None:
        plain = socket.create_connection((self.address, self.port), self.timeout)
        self.sock = ssl.create_default_context().wrap_socket(plain, server_hostname=self.host)


def transport(url: str, timeout: float, address: str) -> tuple[int, dict[str, str], Callable[[int], bytes]]:
    parts = urlsplit(url)
    connection = (_Secure if parts.scheme == "https" else _Plain)(parts.hostname, parts.port, timeout=timeout)
    connection.address = address
    target = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    try:
        connection.request("GET", target, headers={"Accept": ",".join(HTML_TYPES), "Connection": "close"})
        response = connection.getresponse()
    except http.client.HTTPException as error:
        raise OSError(str(error)) from error

    def read(n: int) -> bytes:
        try:
            return response.read(n)
        finally:
            connection.close()

    return response.status, {k.lower(): v for k, v in response.getheaders()}, read


def _checked(url: str, resolver: Resolver) -> tuple[str | None, str]:
    """What is wrong with a url, and the address to go to if nothing is."""
    try:
        parts = urlsplit(url)
        port = parts.port or (443 if parts.scheme == "https" else 80)
    except ValueError:
        return "WEB_INVALID_URL", ""
    if parts.scheme not in ("http", "https") or not parts.hostname or parts.username or parts.password:
        return "WEB_INVALID_URL", ""
    try:
        addresses = resolver(parts.hostname, port)
    except OSError:
        return "WEB_HTTP_ERROR", ""
    if not addresses:
        return "WEB_HTTP_ERROR", ""
    return ("WEB_PRIVATE_ADDRESS_BLOCKED", "") if any(map(blocked_address, addresses)) else (None, addresses[0])


def fetch(url: str, limits: Limits, resolver: Resolver = resolve, send: Transport = transport) -> dict:
    """One page as a row; `code` says why there is no text."""
    row = {"url": url, "final_url": url, "status": None, "media_type": None, "size_bytes": None, "text": None, "code": None, "redirects": [], "etag": None, "last_modified": None}
    for _ in range(limits.redirects + 1):
        code, address = _checked(row["final_url"], resolver)
        if code:
            return row | {"code": code}
        try:
            status, headers, read = send(row["final_url"], limits.timeout_seconds, address)
        except TimeoutError:
            return row | {"code": "WEB_FETCH_TIMEOUT"}
        except OSError:
            return row | {"code": "WEB_HTTP_ERROR"}
        row["status"] = status
        if status in (301, 302, 303, 307, 308) and headers.get("location"):
            row["redirects"] = [*row["redirects"], row["final_url"]]
            row["final_url"] = urljoin(row["final_url"], headers["location"])
            continue
        if not 200 <= status < 300:
            return row | {"code": "WEB_HTTP_ERROR"}
        row["etag"], row["last_modified"] = headers.get("etag"), headers.get("last-modified")
        media, _, parameters = headers.get("content-type", "").partition(";")
        row["media_type"] = media.strip().lower()
        if row["media_type"] not in HTML_TYPES:
            return row | {"code": "WEB_UNSUPPORTED_CONTENT_TYPE"}
        if headers.get("content-length", "").isdigit() and int(headers["content-length"]) > limits.text_bytes:
            return row | {"code": "WEB_RESPONSE_TOO_LARGE"}
        try:
            body = read(limits.text_bytes + 1)
        except TimeoutError:
            return row | {"code": "WEB_FETCH_TIMEOUT"}
        except (OSError, http.client.HTTPException):
            return row | {"code": "WEB_HTTP_ERROR"}
        if len(body) > limits.text_bytes:
            return row | {"code": "WEB_RESPONSE_TOO_LARGE"}
        charset = next((p.split("=", 1)[1].strip(" \"'") for p in parameters.split(";") if p.strip().lower().startswith("charset=")), "utf-8")
        try:
            text = body.decode(charset)
        except (LookupError, UnicodeDecodeError):
            return row | {"code": "INGEST_INVALID_ENCODING"}
        return row | {"size_bytes": len(body), "text": text, "code": None if text.strip() else "WEB_EMPTY_MAIN_CONTENT"}
    return row | {"code": "WEB_TOO_MANY_REDIRECTS"}


_SCHEMA = pa.schema([
    ("url", pa.string()), ("final_url", pa.string()), ("status", pa.int32()), ("media_type", pa.string()), ("size_bytes", pa.int64()), ("text", pa.string()), ("code", pa.string()),
    ("redirects", pa.list_(pa.string())), ("etag", pa.string()), ("last_modified", pa.string()),
])


def _host(url: str) -> str:
    try:
        return (urlsplit(url).hostname or "").lower()
    except ValueError:
        return ""


def _politely(urls: Iterator[str], limits: Limits, resolver: Resolver, send: Transport, delay: float) -> Iterator[dict]:
    """Each page; between two of one host at least `delay` seconds."""
    last: dict[str, float] = {}
    for url in urls:
        host = _host(url)
        if delay and host in last:
            time.sleep(max(0.0, last[host] + delay - time.monotonic()))
        yield fetch(url, limits, resolver, send)
        last[host] = time.monotonic()


def fetch_urls(urls: DataFrame, limits: Limits = Limits(), resolver: Resolver = resolve, send: Transport = transport, delay: float = 0.0) -> DataFrame:  # noqa: B008
    """A4: `urls` (url) fetched; failures are rows with a code, so that no page stops the others.

    With a `delay` the urls of one host come to one task, one after the other; without, each is fetched where its row lies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = (url or "" for batch in batches for url in batch.column("url").to_pylist())
        for row in _politely(each, limits, resolver, send, delay):
            yield pa.RecordBatch.from_pylist([row], schema=_SCHEMA)

    if delay:
        urls = urls.repartition(F.lower(F.regexp_extract("url", r"://(?:[^@/?#]*@)?([^:/?#]+)", 1)))
    return urls.select("url").mapInArrow(run, FETCHED)


def _named(path: str):
    """module:function"""
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


class Urls(InputPartition):
    def __init__(self, urls: list[str]):
        super().__init__(urls)


class PageReader(DataSourceReader):
    """A partition for each host, or for several: as many as `partitions` at most, in which a host's urls stay together."""

    def __init__(self, options: dict[str, str]):
        self.urls = [u for u in (x.strip() for x in options.get("urls", "").splitlines()) if u]
        self.limits = Limits(text_bytes=int(options.get("maxBytes", Limits().text_bytes)), redirects=int(options.get("redirects", Limits().redirects)), timeout_seconds=float(options.get("timeout", Limits().timeout_seconds)))
        self.most, self.delay = int(options.get("partitions", "200")), float(options.get("delay", "0"))
        self.names = options.get("resolver", f"{__name__}:resolve"), options.get("transport", f"{__name__}:transport")

    def partitions(self) -> list[InputPartition]:
        hosts: dict[str, list[str]] = {}
        for url in self.urls:
            hosts.setdefault(_host(url), []).append(url)
        parts: list[list[str]] = [[] for _ in range(max(1, min(self.most, len(hosts))))]
        for own in sorted(hosts.values(), key=len, reverse=True):
            min(parts, key=len).extend(own)
        return [Urls(p) for p in parts]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        resolver, send = map(_named, self.names)
        for row in _politely(iter(partition.value), self.limits, resolver, send, self.delay):
            yield tuple(row[f] for f in _SCHEMA.names)


class Pages(DataSource):
    """spark.read.format("tessera_pages").option("urls", one a line): rows of FETCHED. More options: delay (seconds between pages
    of one host), partitions, maxBytes, redirects, timeout, and resolver and transport as module:function. For lists that
    don't fit in an option, `fetch_urls` takes a table."""

    @classmethod
    def name(cls) -> str:
        return "tessera_pages"

    def schema(self) -> str:
        return FETCHED

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PageReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Pages)
