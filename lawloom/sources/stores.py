"""Record stores behind HTTP as Spark data sources: paged readers with pushed filters, and a writer of batches that may run again.

    stores.register(spark)
    laws = spark.read.format("paged_records").schema("id string, Name string").option("url", ".../base/table").load()
    rows = spark.read.format("rest_rows").schema("name string, year int").option("url", ".../rest/v1").option("table", "laws").load()
    laws.write.format("record_batches").option("url", ".../base/table").option("key", "Name").mode("append").save()

`paged_records` follows the offset token that each page names, so one request after the other; a
table is read in parallel by `formulas`, one to a line, which tell its rows apart. `rest_rows` reads
windows of `pageSize` rows of an order in parallel where `rows` tells how many there are, and page
after page where it does not. Both ask the store for the columns of the schema alone and pass it
the filters that it knows (equality and lists of strings); Spark applies all others.

`record_batches` sends BATCH records at a time, merged by key columns: a batch that was sent already, by a
task that was lost or a request that failed on its way back, changes nothing when it is sent again.

Answers of 429 and from 500 on are asked for again, RETRIES times; others raise.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass
from urllib.error import HTTPError, URLError
from urllib.parse import quote
from urllib.request import Request, urlopen

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, WriterCommitMessage
from pyspark.sql.types import BooleanType, DoubleType, FloatType, IntegerType, LongType, StringType, StructType

PAGE, BATCH, RETRIES = 100, 10, 4


def paged_url(url: str, fields: list[str] = (), view: str = "", formula: str = "", most: str = "", offset: str = "", page: int = 0) -> str:
    """The address of a page of records."""
    told = [("maxRecords", most), ("view", view), *(("fields[]", f) for f in fields), ("filterByFormula", formula), ("pageSize", str(page or "")), ("offset", offset)]
    asked = "&".join(f"{quote(k)}={quote(v, safe='')}" for k, v in told if v)
    return f"{url}?{asked}" if asked else url


def rest_url(table: str = "", name: str | list[str] | None = None, sql: str = "", select: str | list[str] = "", limit: int | None = None, offset: int | None = None, order: str = "", column: str = "name") -> str:
    """The address of rows of a REST table; name: that the column has one value, or one of a list."""
    one = lambda v: quote(str(v), safe="(),.*:-_ ").replace(" ", "%20")
    parts = [] if name is None else [f"{column}=in.({','.join(map(one, name))})" if isinstance(name, list) else f"{column}=eq.{one(name)}"]
    parts += [sql] if sql else []
    parts += [f"select={','.join(select) if isinstance(select, list) else select}"] if select else []
    parts += [f"{k}={v}" for k, v in (("limit", limit), ("offset", offset), ("order", order)) if v not in (None, "")]
    asked = "?" + "&".join(parts) if parts else ""
    return f"rest/v1/{table}{asked}" if table else asked


def asked(url: str, headers: dict[str, str], method: str = "GET", body: object = None, retries: int = RETRIES, wait: float = 0.2) -> object:
    """The JSON answer of a request, asked for again where that may help."""
    data = None if body is None else json.dumps(body).encode()
    for attempt in range(retries + 1):
        try:
            with urlopen(Request(url, data, headers | {"Content-Type": "application/json", "Accept": "application/json"}, method=method), timeout=60) as answer:
                return json.loads(answer.read() or b"null")
        except (HTTPError, URLError, TimeoutError) as error:
            again = not isinstance(error, HTTPError) or error.code == 429 or error.code >= 500
            if not again or attempt == retries:
                raise
            time.sleep(wait * 2**attempt)


def _headers(options: dict[str, str]) -> dict[str, str]:
    return {"Authorization": f"Bearer {options['token']}"} if options.get("token") else {}


def _value(value: object, kind) -> object:
    """A value of JSON as the type of its column; lists and objects as JSON text, lists of a text column joined by commas."""
    if value is None or isinstance(kind, StringType) and isinstance(value, str):
        return value
    if isinstance(kind, StringType):
        plain = isinstance(value, list) and all(isinstance(x, str) for x in value)
        return ",".join(value) if plain else json.dumps(value, ensure_ascii=False) if isinstance(value, (list, dict, bool)) else str(value)
    made = int if isinstance(kind, (IntegerType, LongType)) else float if isinstance(kind, (DoubleType, FloatType)) else bool if isinstance(kind, BooleanType) else None
    return value if made is None else made(value)


@dataclass
class Part(InputPartition):
    formula: str = ""
    offset: int | None = None
    limit: int | None = None


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema, self.options, self.names = schema, {k.lower(): v for k, v in options.items()}, {}
        if "url" not in self.options:
            raise ValueError("set the option url")

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if len(f.attribute if isinstance(f, (EqualTo, In)) else ()) == 1 and self._pushable(f):
                self.names[f.attribute[0]] = list(f.value) if isinstance(f, In) else f.value
            yield f  # Spark applies them as well: stores may compare in their own way

    def _pushable(self, f) -> bool:
        values = f.value if isinstance(f, In) else [f.value]
        known = {x.name for x in self.schema.fields if isinstance(x.dataType, StringType)} - {"id", "createdTime"}
        return f.attribute[0] in known - set(self.names) and all(isinstance(v, str) and "'" not in v and '"' not in v and "," not in v for v in values)


class PagedReader(_Reader):
    def partitions(self):
        return [Part(formula=f) for f in self.options.get("formulas", self.options.get("formula", "")).split("\n")]

    def read(self, part: Part):
        o = self.options
        own = [f for f in self.schema.fields if f.name not in ("id", "createdTime")]
        told = [f"OR({','.join(f'{{{c}}}=\"{x}\"' for x in v)})" if isinstance(v, list) else f'{{{c}}}="{v}"' for c, v in self.names.items()]
        formulas = [f for f in (part.formula, *told) if f]
        formula = f"AND({','.join(formulas)})" if len(formulas) > 1 else "".join(formulas)
        offset, seen = "", set()
        while True:
            page = asked(paged_url(o["url"], [f.name for f in own], o.get("view", ""), formula, o.get("maxrecords", ""), offset, int(o.get("pagesize", PAGE))), _headers(o))
            for record in page.get("records", []):
                fields = record.get("fields", {})
                yield tuple(record.get(f.name) if f.name in ("id", "createdTime") else _value(fields.get(f.name), f.dataType) for f in self.schema.fields)
            offset = page.get("offset", "")
            if not offset:
                return
            if offset in seen:
                raise RuntimeError(f"the store names the page {offset} twice")
            seen.add(offset)


class RestReader(_Reader):
    def partitions(self):
        size, rows = int(self.options.get("pagesize", PAGE)), self.options.get("rows")
        if rows is None or not self.options.get("order"):  # windows of no order may hold a row twice
            return [Part()]
        return [Part(offset=k, limit=size) for k in range(0, max(int(rows), 1), size)][:-1] + [Part(offset=(max(int(rows), 1) - 1) // size * size)]

    def read(self, part: Part):
        o, size = self.options, int(self.options.get("pagesize", PAGE))
        filters = "&".join([*([o["sql"]] if o.get("sql") else []), *(rest_url(name=v, column=c).removeprefix("?") for c, v in self.names.items())])
        at, left = part.offset or 0, part.limit
        while True:
            asks = rest_url(o.get("table", ""), sql=filters, select=[f.name for f in self.schema.fields], limit=size if left is None else min(size, left), offset=at, order=o.get("order", ""))
            page = asked(f"{o['url'].rstrip('/')}/{asks.removeprefix('rest/v1/')}" if o.get("table") else o["url"] + asks, _headers(o))
            for row in page:
                yield tuple(_value(row.get(f.name), f.dataType) for f in self.schema.fields)
            at += len(page)
            left = None if left is None else left - len(page)
            if len(page) < size or left is not None and left <= 0:
                return


@dataclass
class Sent(WriterCommitMessage):
    records: int
    batches: int


class BatchWriter(DataSourceWriter):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema, self.options = schema, {k.lower(): v for k, v in options.items()}
        self.key = [c.strip() for c in self.options.get("key", "").split(",") if c.strip()]
        missing = [c for c in self.key if c not in schema.names]
        if "url" not in self.options or not self.key or missing:
            raise ValueError("set the options url and key, columns by which records are merged")

    def write(self, rows) -> Sent:
        held, sent, batches = [], 0, 0
        for row in rows:
            held.append({"fields": {k: v for k, v in row.asDict(recursive=True).items() if v is not None}})
            if len(held) == BATCH:
                self._send(held)
                held, sent, batches = [], sent + BATCH, batches + 1
        if held:
            self._send(held)
            sent, batches = sent + len(held), batches + 1
        return Sent(sent, batches)

    def _send(self, records: list[dict]) -> None:
        asked(self.options["url"], _headers(self.options), "PATCH", {"records": records, "typecast": True, "performUpsert": {"fieldsToMergeOn": self.key}})

    def commit(self, messages) -> None:
        """Nothing is left to do: batches are in the store."""

    def abort(self, messages) -> None:
        """Batches that were sent stay; sending them again changes nothing."""


class _Store(DataSource):
    reading: type = _Reader

    def schema(self):
        raise ValueError("give the schema of the columns that are to be read")

    def reader(self, schema: StructType) -> DataSourceReader:
        return self.reading(schema, dict(self.options))


class PagedRecords(_Store):
    reading = PagedReader

    @classmethod
    def name(cls) -> str:
        return "paged_records"


class RestRows(_Store):
    reading = RestReader

    @classmethod
    def name(cls) -> str:
        return "rest_rows"


class RecordBatches(DataSource):
    @classmethod
    def name(cls) -> str:
        return "record_batches"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("records are merged by key: write with mode append")
        return BatchWriter(schema, dict(self.options))


def register(spark: SparkSession) -> None:
    """Make the three formats known to a session, and let Spark push filters to them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (PagedRecords, RestRows, RecordBatches):
        spark.dataSource.register(source)
