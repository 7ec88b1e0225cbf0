"""Connectors: one contract over databases, document stores, REST services and files."""

from __future__ import annotations

import itertools
import json
import re
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

from tributary.plans.ship import ship
from tributary.sources import files

IDENTIFIER = re.compile(r"^[A-Za-z_][A-Za-z0-9_$.]*$")


def identifier(name: str) -> str:
    """A table or column name, if it is one, quoted."""
    if not IDENTIFIER.match(name):
        raise ValueError(f"not an identifier: {name!r}")
    return ".".join(f"`{p}`" for p in name.split("."))


class Connector(ABC):
    def __init__(self, spark: SparkSession, **config: object) -> None:
        self.spark, self.config = spark, config

    @abstractmethod
    def list_resources(self) -> list[str]: ...

    @abstractmethod
    def pull_full(self, resource: str) -> DataFrame: ...

    def test_connection(self) -> bool:
        self.list_resources()
        return True

    def pull_sample(self, resource: str, limit: int = 100) -> DataFrame:
        return self.pull_full(resource).limit(limit)

    def pull_delta(self, resource: str, watermark: str | None = None, since: object = None) -> DataFrame:
        """Rows whose watermark column is greater than ``since``; all of them where either is missing."""
        full = self.pull_full(resource)
        return full if watermark is None or since is None else full.filter(F.col(identifier(watermark)) > F.lit(since))


class CatalogConnector(Connector):
    """Tables and views of the session's catalog."""

    def list_resources(self) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables())

    def pull_full(self, resource: str, query: str | None = None) -> DataFrame:
        return self.spark.sql(query) if query else self.spark.table(identifier(resource))


class JdbcConnector(Connector):
    """A database over JDBC: config has url, optionally driver, user, password, and bounds for parallel reads."""

    def _reader(self):
        r = self.spark.read.format("jdbc")
        for k, v in self.config.items():
            r = r.option(k, v)
        return r

    def list_resources(self) -> list[str]:
        q = self.config.get("tables_query", "SELECT table_name FROM information_schema.tables")
        return [r[0] for r in self._reader().option("query", q).load().collect()]

    def pull_full(self, resource: str, query: str | None = None) -> DataFrame:
        if query:
            return self._reader().option("query", query).load()
        identifier(resource)
        return self._reader().option("dbtable", resource).load()


class FileConnector(Connector):
    """Files below a path of any Hadoop file system."""

    def list_resources(self) -> list[str]:
        return sorted(r.path for r in files.listing(self.spark, str(self.config["path"]), str(self.config.get("pattern", "*"))).select("path").collect())

    def pull_full(self, resource: str) -> DataFrame:
        return files.documents(self.spark, str(self.config["path"]), resource)


#: Where the records of a reply may be.
RECORD_PATHS = ("data", "results", "items", "records")


def records_of(body: object, data_path: str | None = None) -> list:
    """The records of a reply: the body if it is a list, else the first list among the known places."""
    if isinstance(body, list):
        return body
    if isinstance(body, dict):
        for p in (data_path, *RECORD_PATHS):
            if p and isinstance(body.get(p), list):
                return body[p]
    return []


def records_in(body: Column, record: str) -> Column:
    """The records of a reply's JSON text as an array of ``record``: the body if it is a list, else the first list among the known places."""
    return F.coalesce(*[F.from_json(F.get_json_object(body, f"${p}"), f"array<{record}>") for p in ("[*]", *(f".{k}" for k in RECORD_PATHS))])


TIMEOUT = 30


def http_page(url: str, headers: dict[str, str] | None = None, timeout: float = TIMEOUT, **parameters: object) -> object:
    from urllib.parse import urlencode
    from urllib.request import Request, urlopen

    asked = Request(f"{url}{'&' if '?' in url else '?'}{urlencode(parameters)}", headers=headers or {})  # noqa: S310
    with urlopen(asked, timeout=timeout) as reply:  # noqa: S310
        return json.load(reply)


def auth_headers(options) -> dict[str, str]:
    """The headers of bearer and api-key authentication (options auth_type, token, api_key, api_key_header)."""
    kind = options.get("auth_type", "")
    if kind == "bearer":
        return {"Authorization": f"Bearer {options.get('token', '')}"}
    if kind in ("api_key", "apikey"):
        return {options.get("api_key_header", "X-API-Key"): options.get("api_key", "")}
    return {}


def endpoint(base_url: str, resource: str) -> str:
    """The address of a resource: itself if it is one, else below the base."""
    return resource if "://" in resource or not base_url else f"{base_url.rstrip('/')}/{resource.lstrip('/')}"


#: Ranges of pages are read in parallel up to this page, the rest by one open-ended partition.
SPLIT_PAGES, PAGE_SIZE = 100, 100


def pages(fetch: Callable[..., object], url: str, first: int = 1, last: int | None = None, size: int = PAGE_SIZE, data_path: str | None = None, part: bool = False, page_param: str = "page", size_param: str = "page_size", **more: object) -> Iterator[object]:
    """The records from page ``first`` on: stops at an empty page, a list body, or a page of another size without ``next``.

    Records beyond ``last`` are an error, unless this is a ``part`` of the pages and others read on. A service
    that gives the same page again does not page: without ``next`` that is the end, with it an error.
    """
    before = None
    for page in itertools.count(first):
        if part and last is not None and page > last:
            return
        body = fetch(url, **{page_param: page, size_param: size}, **more)
        found = records_of(body, data_path)
        again = bool(found) and found == before
        if again and body.get("next"):
            raise RuntimeError(f"{url} gives page {page - 1} again as page {page} and names more")
        if not found or again:
            return
        if last is not None and page > last:
            raise RuntimeError(f"{url} has more than the {last} pages allowed")
        yield from found
        if isinstance(body, list) or (not body.get("next") and len(found) != size):
            return
        before = found


class RestSource(DataSource):
    """Records of a paged REST service as JSON text, one partition for each range of pages.

    Options: url, size, pages (most pages, by default all), pages_a_partition, since; page_param, size_param and
    delta_param name the parameters of page, size and since; auth_type (bearer or api_key) with token or
    api_key and api_key_header, timeout in seconds; ``fetch`` is the name module:function of a function
    (url, **parameters) -> body, by default over HTTP. The first page is read on the driver to see whether the
    service pages at all.
    """

    @classmethod
    def name(cls) -> str:
        return "tributary_rest"

    def schema(self) -> str:
        return "record string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _RestReader(self.options)

    def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:  # noqa: N802
        return _RestStream(self.options)


def _fetcher(options) -> Callable[..., object]:
    import importlib

    named = options.get("fetch")
    if not named:
        headers, timeout = auth_headers(options), float(options.get("timeout", TIMEOUT))
        return lambda url, **parameters: http_page(url, headers, timeout, **parameters)
    module, _, function = named.partition(":")
    return getattr(importlib.import_module(module), function)


def _names(options) -> dict[str, str]:
    return {k: options[k] for k in ("page_param", "size_param") if k in options}


class _Pages(InputPartition):
    def __init__(self, first: int, last: int | None, part: bool) -> None:
        super().__init__((first, last, part))


class _RestReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.options = options

    def partitions(self) -> list[InputPartition]:
        most = int(self.options["pages"]) if "pages" in self.options else None
        if "since" in self.options:  # a delta may come in one reply whatever page is asked for
            return [_Pages(1, most, False)]
        o, size = self.options, int(self.options.get("size", PAGE_SIZE))
        fetch, names = _fetcher(o), {"page_param": "page", "size_param": "page_size", **_names(o)}
        body, again = (fetch(o.get("url", ""), **{names["page_param"]: k, names["size_param"]: size}) for k in (1, 2))
        found = records_of(body, o.get("data_path"))
        if isinstance(body, list) or found == records_of(again, o.get("data_path")) or not body.get("next") and len(found) != size:
            return [_Pages(1, most, False)]  # one reply holds all; further pages would repeat it
        n, step = most or SPLIT_PAGES, int(self.options.get("pages_a_partition", 10))
        ranges = [_Pages(i, min(n, i + step - 1), most is None or i + step <= n) for i in range(1, n + 1, step)]
        return ranges if most else [*ranges, _Pages(n + 1, None, False)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        first, last, part = partition.value
        more = {self.options.get("delta_param", "since"): self.options["since"]} if "since" in self.options else {}
        for r in pages(_fetcher(self.options), self.options.get("url", ""), first, last, int(self.options.get("size", PAGE_SIZE)), self.options.get("data_path"), part, **_names(self.options), **more):
            yield (json.dumps(r, ensure_ascii=False, sort_keys=True),)


class _RestStream(SimpleDataSourceStreamReader):
    """A service asked for what is new: the offset is the greatest value of the record's ``key``."""

    def __init__(self, options) -> None:
        self.options = options

    def initialOffset(self) -> dict:  # noqa: N802
        return {"since": self.options.get("since", "")}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        o = self.options
        found = list(pages(_fetcher(o), o.get("url", ""), size=int(o.get("size", PAGE_SIZE)), data_path=o.get("data_path"), **_names(o), **{o.get("delta_param", "since"): start["since"]}))
        key = self.options.get("key", "updated_at")
        latest = max([str(r.get(key, "")) for r in found], default=start["since"])
        return iter([(json.dumps(r, ensure_ascii=False, sort_keys=True),) for r in found]), {"since": max(latest, start["since"])}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        rows, _ = self.read(start)
        return rows


class RestConnector(Connector):
    def list_resources(self) -> list[str]:
        """The configured endpoints, or the one address."""
        listed = self.config.get("endpoints") or []
        return [x["path"] if isinstance(x, dict) else str(x) for x in listed] or [str(self.config.get("url", ""))]

    def _load(self, resource: str, **more: object) -> DataFrame:
        ship(self.spark)
        self.spark.dataSource.register(RestSource)
        r = self.spark.read.format("tributary_rest")
        plain = {k: v for k, v in self.config.items() if k not in ("endpoints", "base_url")}
        for k, v in {**plain, **more, "url": endpoint(str(self.config.get("base_url", "")), resource)}.items():
            r = r.option(k, str(v))
        return r.load()

    def pull_full(self, resource: str) -> DataFrame:
        return self._load(resource)

    def pull_sample(self, resource: str, limit: int = 100) -> DataFrame:
        """Of the first page only: no more is asked for than a sample needs."""
        rows = records_of(_fetcher(self.config)(endpoint(str(self.config.get("base_url", "")), resource), **{str(self.config.get("page_param", "page")): 1, str(self.config.get("size_param", "page_size")): limit}), self.config.get("data_path"))
        return self.spark.createDataFrame([(json.dumps(r, ensure_ascii=False, sort_keys=True),) for r in rows[:limit]], "record string")

    def pull_delta(self, resource: str, watermark: str | None = None, since: object = None) -> DataFrame:
        return self._load(resource, since=since) if since is not None else self.pull_full(resource)


class MongoSource(DataSource):
    """Documents of a collection as JSON text without ``_id``; the client is pymongo or the injected ``find``."""

    @classmethod
    def name(cls) -> str:
        return "tributary_mongo"

    def schema(self) -> str:
        return "record string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _MongoReader(self.options)


def mongo_find(url: str, database: str, collection: str, since: str | None) -> Iterator[dict]:
    try:
        from bson import ObjectId
        from pymongo import MongoClient
    except ImportError as x:
        raise RuntimeError("reading from the document store needs pymongo on the executors") from x
    yield from MongoClient(url)[database][collection].find({"_id": {"$gt": ObjectId(since)}} if since else {})


class _MongoReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.options = options

    def read(self, partition: InputPartition | None) -> Iterator[tuple]:
        o = self.options
        find = _fetcher(o) if o.get("fetch") else mongo_find
        for doc in find(o.get("url", ""), o.get("database", ""), o.get("collection", ""), o.get("since")):
            yield (json.dumps({k: v for k, v in doc.items() if k != "_id"}, ensure_ascii=False, sort_keys=True, default=str),)


class MongoConnector(Connector):
    def list_resources(self) -> list[str]:
        return [str(self.config.get("collection", ""))]

    def pull_full(self, resource: str, since: object = None) -> DataFrame:
        ship(self.spark)
        self.spark.dataSource.register(MongoSource)
        r = self.spark.read.format("tributary_mongo").option("collection", resource)
        for k, v in self.config.items():
            r = r.option(k, str(v))
        return (r.option("since", str(since)) if since is not None else r).load()

    def pull_delta(self, resource: str, watermark: str | None = None, since: object = None) -> DataFrame:
        return self.pull_full(resource, since)


#: Kinds of connection.
REGISTRY: dict[str, type[Connector]] = {
    "file": FileConnector, "catalog": CatalogConnector, "jdbc": JdbcConnector, "mysql": JdbcConnector, "postgres": JdbcConnector, "postgresql": JdbcConnector,
    "mongo": MongoConnector, "mongodb": MongoConnector, "rest": RestConnector, "rest_api": RestConnector,
}


def kinds() -> list[str]:
    """The kinds of connection that a user may name."""
    return sorted(k for k in REGISTRY if k not in ("catalog", "jdbc"))


def sources_of(nodes: DataFrame, node_source: str, files_: DataFrame, file_id: str, file_name: str) -> DataFrame:
    """(source, file): the file that each connector node names, by id first, then by the file name without its extension; each once.

    Of several files of one name the one with the smallest id is taken; nodes that name no file are left out.
    """
    stem = F.regexp_replace(F.col(file_name), r"\.[^.]+$", "")
    known = files_.select(F.col(file_id).alias("__id"), stem.alias("__stem"))
    by_id, by_stem = known.select("__id").distinct(), known.groupBy("__stem").agg(F.min("__id").alias("__near"))
    asked = nodes.select(F.col(node_source).alias("source")).filter("source is not null").distinct()
    j = asked.join(by_id, F.col("source") == F.col("__id"), "left").join(by_stem, F.regexp_replace("source", r"\.[^.]+$", "") == F.col("__stem"), "left")
    return j.select("source", F.coalesce("__id", "__near").alias("file")).filter("file is not null")


def migrated(old: DataFrame, renamed: dict[str, str], defaults: dict[str, Column]) -> DataFrame:
    """Rows of an older layout in the new one: columns renamed, and a value where the old one has none or lacks the column."""
    out = old.withColumnsRenamed(renamed)
    return out.withColumns({k: F.coalesce(F.col(k), v) if k in out.columns else v for k, v in defaults.items()})


def connector(spark: SparkSession, kind: str, **config: object) -> Connector:
    if kind not in REGISTRY:
        raise ValueError(f"unknown kind of connection {kind!r}; known are {sorted(REGISTRY)}")
    return REGISTRY[kind](spark, **config)
