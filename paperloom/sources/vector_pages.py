"""Stored vectors from a service that replies by page, as a data source of its own (SRC14, SRC15).

``spark.read.format("vector_pages").option("url", ...)`` makes a partition of each page, and a page is asked for when its task runs. A filter on the
user is pushed: then only that user's pages are asked for.  What columns are decoded goes by the schema that is
asked for, so without ``embedding`` no vector is unpacked.

A scope is ``all`` or ``user/<hash>``; ``<url>/<scope>/pages`` gives the number of its pages, ``<url>/<scope>/<page>`` a page: a JSON list, or an object
with the list as ``embeddings`` or ``data``.  Addresses are http(s), files, or of any file system that Arrow knows.  A scope that isn't there has no pages.
Rows without a vector are left out; metadata may be an object or a text of one.
"""

from __future__ import annotations

import base64
import json
import math
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

_TEXTS = ["embedding_id", "request_id", "user_id_hash", "image_path", "image_hash"]
SCHEMA = T.StructType([
    *(T.StructField(name, T.StringType()) for name in _TEXTS), T.StructField("file_size_bytes", T.LongType()), T.StructField("timestamp", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())), T.StructField("embedding", T.ArrayType(T.FloatType())),
])
#: Names of plain fields in a reply.
FIELDS = {"request_id": "requestId", "user_id_hash": "userIdHash", "image_path": "imagePath", "image_hash": "imageHash", "file_size_bytes": "fileSizeBytes", "timestamp": "timestamp"}
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def fetched(address: str, timeout: float) -> bytes | None:
    """What is at an address; None if nothing is there."""
    kind = urllib.parse.urlsplit(address).scheme
    try:
        if kind in ("http", "https"):
            with urllib.request.urlopen(address, timeout=timeout) as reply:  # noqa: S310
                return reply.read()
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(address)
        with system.open_input_stream(path) as stream:
            return stream.read()
    except urllib.error.HTTPError as error:
        if error.code == 404:
            return None
        raise
    except FileNotFoundError:
        return None


def items_of(reply: bytes | None) -> list[dict]:
    """The vectors' records of a page."""
    data = json.loads(reply) if reply else []
    found = data if isinstance(data, list) else data.get("embeddings", data.get("data", []))
    return [x for x in found if isinstance(x, dict) and x.get("embedding")]


def _metadata(x: dict) -> list[tuple[str, str | None]]:
    given = x.get("metadata") or {}
    given = json.loads(given) if isinstance(given, str) else given
    return [(k, v if isinstance(v, str) or v is None else json.dumps(v, ensure_ascii=False)) for k, v in given.items()]


class Page(InputPartition):
    def __init__(self, scope: str, page: int) -> None:
        self.scope, self.page = scope, page


class PageReader(DataSourceReader):
    def __init__(self, schema: T.StructType, url: str, timeout: float) -> None:
        self.schema, self.url, self.timeout, self.user = schema, url.rstrip("/"), timeout, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("user_id_hash",) and self.user in (None, f.value):
                self.user = f.value
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        scope = "all" if self.user is None else "user/" + urllib.parse.quote(str(self.user), safe="")
        return [Page(scope, n) for n in range(int(fetched(f"{self.url}/{scope}/pages", self.timeout) or 0))]

    def read(self, partition: InputPartition | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark makes of no partitions
            return
        items = items_of(fetched(f"{self.url}/{partition.scope}/{partition.page}", self.timeout))
        make = {name: lambda x, key=key: x.get(key) for name, key in FIELDS.items()}
        make |= {"embedding_id": lambda x: x.get("embeddingId", x.get("id")), "metadata": _metadata, "embedding": lambda x: np.frombuffer(base64.b64decode(x["embedding"]), "<f4")}
        kinds = to_arrow_schema(self.schema)
        yield pa.RecordBatch.from_arrays([pa.array([make[f.name](x) for x in items], f.type) for f in kinds], schema=kinds)


class VectorPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "vector_pages"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        if unknown := {f.name for f in schema} - set(SCHEMA.names):
            raise ValueError(f"a reply has no {sorted(unknown)}")
        return PageReader(schema, self.options["url"], float(self.options.get("timeout", 120)))


def read_pages(spark: SparkSession, url: str, columns: Sequence[str] | None = None, user: str | None = None) -> DataFrame:
    """Vectors of all users, or of one; only ``columns``, by default all."""
    spark.dataSource.register(VectorPages)
    spark.conf.set(PUSHDOWN, "true")
    fields = T.StructType([f for f in SCHEMA if columns is None or f.name in {*columns, *(["user_id_hash"] if user is not None else [])}])
    rows = spark.read.format("vector_pages").schema(fields).option("url", url).load()
    rows = rows if user is None else rows.where(F.col("user_id_hash") == user)
    return rows.select(*columns) if columns else rows


def save_pages(store: DataFrame, url: str, rows_a_page: int = 1000) -> None:
    """A store (the columns of ``SCHEMA``) as the pages that the service would reply with, of all and of each user; each task writes its own."""
    given = store.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in store.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in SCHEMA))

    def item(row: dict) -> dict:
        out = {key: row[name] for name, key in FIELDS.items()} | {"embeddingId": row["embedding_id"], "metadata": dict(row["metadata"] or [])}
        return out | {"embedding": base64.b64encode(np.asarray(row["embedding"] or [], "<f4").tobytes()).decode()}

    def put(scope: str, name: object, data: bytes) -> None:
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(f"{url.rstrip('/')}/{scope}/{name}")
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(path) as stream:
            stream.write(data)

    def page(scope: str, number: int, rows: list[dict]) -> None:
        put(scope, number, json.dumps({"embeddings": [item(r) for r in rows]}, ensure_ascii=False).encode())

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rows = [r for batch in batches for r in batch.to_pylist()]
        page("all", TaskContext.get().partitionId(), rows)
        yield pa.RecordBatch.from_arrays([pa.array([len(rows)], pa.int64())], ["n"])

    def by_user(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        user, rows, pages = None, [], 0

        def closed() -> None:
            if user is not None:
                scope = "user/" + urllib.parse.quote(str(user), safe="")
                if rows:
                    page(scope, pages, rows)
                put(scope, "pages", str(pages + bool(rows)).encode())

        for batch in batches:
            for r in batch.to_pylist():
                if r["user_id_hash"] != user:
                    closed()
                    user, rows, pages = r["user_id_hash"], [], 0
                rows.append(r)
                if len(rows) == rows_a_page:
                    page("user/" + urllib.parse.quote(str(user), safe=""), pages, rows)
                    rows, pages = [], pages + 1
        closed()
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64())], ["n"])

    n = max(1, math.ceil(store.count() / rows_a_page))
    given.repartition(n).mapInArrow(every, "n long").write.format("noop").mode("overwrite").save()
    put("all", "pages", str(n).encode())
    users = given.where("user_id_hash is not null")
    users.repartition("user_id_hash").sortWithinPartitions("user_id_hash").mapInArrow(by_user, "n long").write.format("noop").mode("overwrite").save()
