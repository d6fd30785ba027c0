"""A data source over paged JSON: ``spark.read.format("paged_items")``.

Options: ``path`` (a folder of page files ``page-0.json``, ``page-1.json`` ..., each ``{"items": [...], "next": ...}``,
where Spark finds them, on a store that Arrow reaches too) or ``url`` for a live service; ``page_size``; ``single`` for one
page only; ``stop_at``, a time at which reading stops, as items come newest first: an item at or before it ends the
read. Pages of a service follow each other by their ``next``, so a read is one task; ``read_items`` reads the page files of
a folder by many. A page that is missing or unreadable raises.

A service takes a ``token``, or ``token_url`` with ``refresh_token``, ``client_id`` and ``client_secret``, from which
tokens are drawn at first and whenever one is refused; the first refresh token comes from ``authorization_url`` and
``first_tokens``, with a user between. A service that is busy (429, 5xx) or not reached is asked
again up to ``retries`` times, after as long as its Retry-After says or a doubling wait.
"""

from __future__ import annotations

import datetime
import json
import time
from collections.abc import Iterator
from urllib.error import HTTPError, URLError
from urllib.parse import parse_qs, urlencode, urlparse
from urllib.request import Request, urlopen

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import arrow_uri


def _as_row(value, kind: T.DataType):
    if value is None:
        return None
    if isinstance(kind, T.StructType):
        return tuple(_as_row(value.get(f.name), f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return [_as_row(v, kind.elementType) for v in value]
    return value


def parse_time(text: str) -> datetime.datetime:
    return datetime.datetime.fromisoformat(text.replace("Z", "+00:00")).replace(tzinfo=None)


def authorization_url(options: dict, state: str) -> str:
    """Where a user allows the client to read for them, the first time: the service sends them on to ``redirect_uri`` with a code and this ``state``."""
    _settings(options, "authorize_url", "client_id", "redirect_uri")
    form = {"response_type": "code", "client_id": options["client_id"], "redirect_uri": options["redirect_uri"], "state": state} | ({"scope": options["scope"]} if options.get("scope") else {})
    return f"{options['authorize_url']}?{urlencode(form)}"


def first_tokens(options: dict, answer: str, state: str) -> dict[str, str]:
    """The tokens for the address to which the user was sent: ``token``, and the ``refresh_token`` from which a client draws further ones. Keep both as secrets."""
    given = parse_qs(urlparse(answer).query)
    if given.get("state") != [state]:
        raise ValueError("the answer isn't to this request")
    if "code" not in given:
        raise PermissionError(f"the service gave no code: {', '.join(given.get('error', ['no reason']))}")
    _settings(options, "token_url", "client_id", "client_secret", "redirect_uri")
    form = {"grant_type": "authorization_code", "code": given["code"][0]} | {n: options[n] for n in ("redirect_uri", "client_id", "client_secret")}
    found = Client(options)._sent(Request(options["token_url"], data=urlencode(form).encode()))
    return {"token": found["access_token"], "refresh_token": found["refresh_token"]}


def _settings(options: dict, *names: str) -> None:
    missing = [n for n in names if not options.get(n)]
    if missing:
        raise KeyError(f"settings not found: {', '.join(missing)}")


class Client:
    """GET of JSON with a bearer token."""

    def __init__(self, options: dict):
        self.options, self.token = options, options.get("token")
        self.retries, self.wait = int(options.get("retries", "5")), float(options.get("wait", "1"))

    def _refreshed(self) -> str:
        _settings(self.options, "refresh_token", "client_id", "client_secret")
        form = {"grant_type": "refresh_token"} | {n: self.options[n] for n in ("refresh_token", "client_id", "client_secret")}
        return self._sent(Request(self.options["token_url"], data=urlencode(form).encode()))["access_token"]

    def _sent(self, request: Request) -> dict:
        for k in range(self.retries + 1):
            try:
                with urlopen(request, timeout=60) as f:
                    return json.load(f)
            except HTTPError as e:
                if k == self.retries or not (e.code == 429 or e.code >= 500):
                    raise
                after = e.headers.get("Retry-After") or ""
                time.sleep(float(after) if after.replace(".", "", 1).isdigit() else self.wait * 2**k)
            except URLError:
                if k == self.retries:
                    raise
                time.sleep(self.wait * 2**k)
        raise AssertionError("unreachable")

    def get(self, url: str) -> dict:
        renewable = "token_url" in self.options
        if self.token is None and renewable:
            self.token, renewable = self._refreshed(), False
        try:
            return self._sent(Request(url, headers={"Authorization": f"Bearer {self.token or ''}"}))
        except HTTPError as e:
            if e.code != 401 or not renewable:
                raise
            self.token = self._refreshed()
            return self._sent(Request(url, headers={"Authorization": f"Bearer {self.token}"}))


def _load(folder: str, name: str) -> dict:
    """A page file, by Arrow's file systems."""
    from pyarrow.fs import FileSystem

    fs, base = FileSystem.from_uri(folder)
    with fs.open_input_stream(f"{base}/{name}") as f:
        return json.loads(f.read())


class PagedReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.options = schema, options

    def _pages(self) -> Iterator[dict]:
        folder, size = self.options.get("path"), int(self.options.get("page_size", "50"))
        client = None if folder else Client(self.options)
        at = 0 if folder else f"{self.options['url']}?limit={size}"
        while at is not None:
            if folder:
                page = _load(folder, f"page-{at}.json")
                at = at + 1 if page.get("next") else None
            else:
                page = client.get(at)
                at = page.get("next")
            yield page
            if self.options.get("single", "false") == "true":
                return

    def read(self, partition) -> Iterator[tuple]:
        stop = self.options.get("stop_at")
        mark, field = parse_time(stop) if stop else None, self.options.get("time_field", self.schema[0].name)
        for page in self._pages():
            for item in page["items"]:
                if mark is not None and parse_time(item[field]) <= mark:
                    return
                yield _as_row(item, self.schema)


class Between(InputPartition):
    """Items after ``start`` and up to ``end``."""

    def __init__(self, start: str | None, end: str | None):
        self.start, self.end = start, end


class PagedStream(DataSourceStreamReader):
    """The same items as a stream, whose offset is the newest time read so far.

    Items come newest first: the driver asks for the first one's time only, and a task reads pages down to the last
    offset. A batch that is run again reads the same times again, whatever has come since; a restart goes on from the
    checkpoint's offset. As with a mark, an item of the very time of an offset that comes later is not read.
    """

    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.options = schema, options
        self.field = options.get("time_field", schema[0].name)
        self.last = parse_time(options["stop_at"]) if options.get("stop_at") else None

    def _offset(self, time: datetime.datetime | None) -> dict:
        """Offsets don't go back, even if the newest items were taken away."""
        self.last = max((t for t in (self.last, time) if t), default=None)
        return {"read": self.last.isoformat() if self.last else None}

    def _items(self) -> Iterator[dict]:
        for page in PagedReader(self.schema, self.options)._pages():
            yield from page["items"]

    def initialOffset(self) -> dict:
        return {"read": self.options.get("stop_at")}

    def latestOffset(self) -> dict:
        newest = next(self._items(), None)
        return self._offset(parse_time(newest[self.field]) if newest else None)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self._offset(parse_time(start["read"]) if start["read"] else None)
        return [Between(start["read"], end["read"])]

    def read(self, partition: Between) -> Iterator[tuple]:
        start, end = (parse_time(t) if t else None for t in (partition.start, partition.end))
        for item in self._items():
            at = parse_time(item[self.field])
            if start is not None and at <= start:
                return
            if end is not None and at <= end:
                yield _as_row(item, self.schema)

    def commit(self, end: dict) -> None:
        pass


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_items"

    def schema(self):
        raise ValueError("state the items' schema with .schema(...)")

    def reader(self, schema: T.StructType) -> PagedReader:
        return PagedReader(schema, dict(self.options))

    def streamReader(self, schema: T.StructType) -> PagedStream:
        return PagedStream(schema, dict(self.options))


def _resolved(spark: SparkSession, options: dict[str, str]) -> dict[str, str]:
    return options | {"path": arrow_uri(spark, options["path"])} if "path" in options else options


def stream_items(spark: SparkSession, schema: T.StructType, after: datetime.datetime | None = None, **options: str):
    """Items of a paged service as a stream, those newer than ``after`` first and then what comes."""
    spark.dataSource.register(PagedSource)
    options = _resolved(spark, options)
    if after is not None:
        options["stop_at"] = after.isoformat()
    return spark.readStream.format("paged_items").schema(schema).options(**options).load()


#: What of a page's ``next`` says that none follows.
NO_NEXT = ("", "false", "0", "0.0", "[]", "{}")


def read_items(spark: SparkSession, schema: T.StructType, stop_at: datetime.datetime | None = None, **options: str) -> DataFrame:
    """Items of a paged service as a DataFrame; page files are read by many tasks, once to find the last page of the chain, which happens at this call, and once for their items."""
    if stop_at is not None:
        options["stop_at"] = stop_at.isoformat()
    if "path" in options and options.get("single", "false") != "true":
        return _folder_items(spark, schema, options)
    spark.dataSource.register(PagedSource)
    return spark.read.format("paged_items").schema(schema).options(**_resolved(spark, options)).load()


def _folder_items(spark: SparkSession, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """The items of the page files that follow each other from page 0: up to one without a ``next``, or to the first item that isn't newer than the mark."""
    number = F.regexp_extract("_metadata.file_name", r"^page-(0|[1-9][0-9]*)\.json$", 1)
    mark, field = options.get("stop_at"), options.get("time_field", schema[0].name)

    def pages(item: T.StructType, mode: str) -> DataFrame:
        kinds = T.StructType([T.StructField("items", T.ArrayType(item)), T.StructField("next", T.StringType())])
        found = spark.read.schema(kinds).option("multiLine", True).option("mode", mode).option("pathGlobFilter", "page-*.json").json(options["path"])
        return found.filter(number != "").withColumn("page", number.cast("long"))

    def old(item: Column, otherwise: Column) -> Column:
        """Whether an item isn't newer than the mark; ``otherwise``, if its time can't be told."""
        at = F.regexp_replace(item[field], "(Z|[+-][0-9]{2}:?[0-9]{2})$", "").try_cast("timestamp_ntz")
        return F.coalesce(at <= F.lit(mark).cast("timestamp_ntz"), otherwise)

    # a page that can't be read ends the chain here, and raises below if it is one of it
    last = F.col("next").isNull() | F.col("next").isin(*NO_NEXT)
    if mark:
        last = last | F.exists("items", lambda x: old(x, F.lit(True)))
    seen = pages(T.StructType([schema[field]]), "PERMISSIVE").select("page", last.alias("last")).persist()
    try:
        end = seen.filter("last").agg(F.min("page")).first()[0]
        there = seen.filter(F.col("page") <= end).count() if end is not None else seen.count()
    finally:
        seen.unpersist()
    if end is None or there <= end:
        raise FileNotFoundError(f"a page that another one names is not in {options['path']}")
    found = F.coalesce("items", F.raise_error(F.lit("a page has no items")).cast(T.ArrayType(schema)))
    if mark:
        at = F.array_position(F.transform(found, lambda x: old(x, F.raise_error(F.lit(f"an item has no time {field}")).cast("boolean"))), F.lit(True))
        found = F.when(at > 0, F.slice(found, 1, (at - 1).cast("int"))).otherwise(found)
    return pages(schema, "FAILFAST").filter(F.col("page") <= end).select(F.inline(found))
