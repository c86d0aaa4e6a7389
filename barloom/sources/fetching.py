"""Acquisition from an outside provider, reached through a user's fetch function.

Requests are dealt to the cluster; each task fetches its own, and answers never pass through the
driver. A provider may answer with one frame or with an iterator of frames, which are handed on as
they come, so that an answer need not fit into a worker. What was fetched is written once, and
every later step reads the written copy: a lost executor or a second action never asks the
provider again.

``spark.read.format("barloom_fetch")`` is the same as a data source, with a partition per request.
"""

from __future__ import annotations

import base64
import json
import time
from collections.abc import Callable, Iterable, Iterator
from datetime import date

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from barloom.functions import clean_double, normalize_symbol
from barloom.schemas import BARS, FIELDS, SERIES
from barloom.shared import drop, land, new_path

Fetch = Callable[[str, date, date], "pd.DataFrame | Iterable[pd.DataFrame]"]

FORMAT = "barloom_fetch"
#: Requests up to which they are partitions of the data source; more are dealt as rows.
REQUESTS = 1000
#: Rows of an answer that are handed on at a time.
ROWS = 10_000
KEY = ["symbol", "start", "end"]


def _layout(schema: StructType) -> StructType:
    """Rows of answers: data rows without ``status``, then one row with it that ends an attempt."""
    whole = StructType()
    for name, kind in zip(KEY, ("string", "date", "date"), strict=True):
        whole = whole.add(name, kind)
    for field in schema.fields[1:]:
        whole = whole.add(field.name, field.dataType)
    for name, kind in (("arrival", "long"), ("attempt", "integer"), ("status", "string"), ("message", "string"), ("rows", "long")):
        whole = whole.add(name, kind)
    return whole


KINDS = {"bars": _layout(BARS), "series": _layout(SERIES)}


def _typed(answer: pd.DataFrame, columns: list[str]) -> pd.DataFrame:
    got = answer.reindex(columns=columns)
    got["date"] = pd.to_datetime(got["date"]).dt.date
    for c in columns[1:]:
        got[c] = got[c].astype("Int64" if c == "volume" else "float64")
    return got


def _parts(answer: pd.DataFrame | Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in [answer] if isinstance(answer, pd.DataFrame) else answer:
        for at in range(0, len(frame), ROWS):
            yield frame.iloc[at : at + ROWS]


def _answers(
    fetch: Fetch, kind: str, request: tuple, attempts: int, wait: float
) -> Iterator[pa.RecordBatch]:
    """Typed rows of the answer as they come, and the row that ends the last attempt.

    An answer that breaks off or cannot be typed is a failure like any other; rows of an attempt
    that failed are told by their number.
    """
    layout = to_arrow_schema(KINDS[kind])
    columns = [n for n in layout.names[len(KEY) :] if n not in ("arrival", "attempt", "status", "message", "rows")]

    def batch(frame: pd.DataFrame, **more) -> pa.RecordBatch:
        rows = frame.assign(**dict(zip(KEY, request, strict=True)), **more)
        held = [
            pa.array(rows[f.name], f.type, from_pandas=True) if f.name in rows else pa.nulls(len(rows), f.type)
            for f in layout
        ]
        return pa.RecordBatch.from_arrays(held, schema=layout)

    status, message, rows = "failed", "", 0
    for turn in range(attempts):
        rows = 0
        try:
            for part in _parts(fetch(*request)):
                got = _typed(part, columns)
                yield batch(got, arrival=range(rows, rows + len(got)), attempt=turn)
                rows += len(got)
            status, message = "ok" if rows else "empty", ""
            break
        except Exception as problem:  # the provider's errors are data here: a status row
            message = f"{type(problem).__name__}: {problem}"
            if turn + 1 < attempts:
                time.sleep(min(10.0, wait * 2**turn))
    end = {"attempt": turn, "status": status, "message": message, "rows": rows if status == "ok" else 0}
    yield batch(pd.DataFrame([end]))


class _Requests(InputPartition):
    def __init__(self, requests: list[tuple]):
        self.requests = requests


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.kind = options["kind"]
        self.fetch = cloudpickle.loads(base64.b64decode(options["fetch"]))
        self.attempts, self.wait = int(options.get("attempts", 1)), float(options.get("wait", 2.0))
        self.tasks = int(options.get("tasks", 0))
        self.requests = [
            (symbol, date.fromisoformat(start), date.fromisoformat(end))
            for symbol, start, end in json.loads(options["requests"])
        ]

    def partitions(self) -> list[InputPartition]:
        share = self.tasks or len(self.requests)
        dealt = [self.requests[i::share] for i in range(share)] if share else []
        return [_Requests(some) for some in dealt if some] or [_Requests([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for request in partition.requests:
            yield from _answers(self.fetch, self.kind, request, self.attempts, self.wait)


class FetchSource(DataSource):
    """Answers of a provider as rows.

    Options: ``fetch``, the pickled function in base64 (``fetch_option`` gives it); ``kind``,
    ``bars`` or ``series``; ``requests``, a JSON list of [symbol, first day, last day]; and
    ``attempts``, ``wait``, ``tasks`` as in ``fetch_bars``.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return KINDS[self.options["kind"]]

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options)


def fetch_option(fetch: Fetch) -> str:
    return base64.b64encode(cloudpickle.dumps(fetch)).decode()


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    spark.dataSource.register(FetchSource)


def _by_rows(fetch: Fetch, kind: str, attempts: int, wait: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for request in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                yield from _answers(fetch, kind, request, attempts, wait)

    return rows


def fetch_answers(
    requests: DataFrame, fetch: Fetch, kind: str, attempts: int = 1, wait: float = 2.0,
    tasks: int | None = None,
) -> DataFrame:
    """Rows of the data source for a table of (symbol, start, end).

    Up to REQUESTS requests become partitions of the format; a longer list is not taken to the
    driver but dealt to tasks as rows, with the same result. ``tasks`` limits how many requests
    run at once, for providers that need it.
    """
    spark, wanted = requests.sparkSession, requests.select(*KEY)
    few = wanted.take(REQUESTS + 1)
    if len(few) <= REQUESTS:
        register(spark)
        listed = json.dumps([(r.symbol, str(r.start), str(r.end)) for r in few])
        return (
            spark.read.format(FORMAT)
            .options(fetch=fetch_option(fetch), kind=kind, requests=listed, attempts=attempts, wait=wait, tasks=tasks or 0)
            .load()
        )
    tasks = tasks or spark.sparkContext.defaultParallelism
    return wanted.repartition(tasks, *KEY).mapInArrow(
        _by_rows(fetch, kind, attempts, wait), KINDS[kind]
    )


def _fetched(
    requests: DataFrame, fetch: Fetch, kind: str, path: str, attempts: int, wait: float,
    tasks: int | None,
) -> tuple[DataFrame, DataFrame]:
    """The data rows of the attempts that succeeded, and one row per request that says how it
    went; both from the landed answers."""
    landed = land(fetch_answers(requests, fetch, kind, attempts, wait, tasks), path)
    ends = landed.where("status IS NOT NULL").select(*KEY, "attempt", "status", "message", "rows")
    good = ends.where("status = 'ok'").select(*KEY, "attempt")
    rows = landed.where("status IS NULL").join(good, [*KEY, "attempt"], "left_semi")
    return rows.drop("attempt", "status", "message", "rows"), ends.drop("attempt")


def fetch_bars(
    requests: DataFrame,
    fetch: Fetch,
    path: str,
    attempts: int = 1,
    wait: float = 2.0,
    tasks: int | None = None,
    arrival: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Bars of the requested (symbol, start, end), and one status row per request.

    Symbols are trimmed and upper-cased; a request without a symbol or a day is left out. A
    request that fails, brings nothing or brings what cannot be typed is reported and skipped;
    only if no request succeeds is that an error. ``fetch`` returns a pandas frame, or an iterator
    of them, with ``date`` and the OHLCV fields. With ``arrival`` the bars have a column of that
    name that orders them as they came: by request, then by place in the answer.
    """
    symbol = normalize_symbol(F.col("symbol")).alias("symbol")
    wanted = requests.select(symbol, "start", "end").distinct().na.drop()
    rows, status = _fetched(wanted, fetch, "bars", path, attempts, wait, tasks)
    if status.where("status = 'ok'").isEmpty():
        raise RuntimeError("no request brought any data")
    came = [F.struct("start", "end", "arrival").alias("arrival")] if arrival else []
    bars = rows.select(
        "symbol", "date", *[clean_double(F.col(f)).alias(f) for f in FIELDS[:-1]], "volume", *came
    )
    return bars, status


def read_through(
    requests: DataFrame, fetch: Fetch, landed: str, attempts: int = 3, wait: float = 2.0,
    tasks: int | None = None,
) -> DataFrame:
    """Series of the requested (symbol, start, end), fetched only where not landed before.

    ``landed``/rows holds the rows by symbol, each with its request; ``landed``/manifest lists the
    requests that are there, so what is known is found without reading rows. An empty or failed
    request leaves nothing behind and is tried again next time. A day that several requests cover
    comes once, from the request that starts first. Requests without a symbol or a day are left
    out.
    """
    spark = requests.sparkSession
    wanted = requests.select(*KEY).distinct().na.drop()
    store, manifest = f"{landed}/rows", f"{landed}/manifest"
    try:
        known = spark.read.parquet(manifest).select(*KEY).distinct()
        to_fetch = wanted.join(known, KEY, "left_anti")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        to_fetch = wanted  # nothing has been landed yet
    fetched = new_path(spark, "fetched")
    brought, status = _fetched(to_fetch, fetch, "series", fetched, attempts, wait, tasks)
    brought.select(
        *KEY, "date", "arrival", clean_double(F.col("value")).alias("value")
    ).repartition("symbol").sortWithinPartitions("symbol", "date").write.mode(
        "append"
    ).partitionBy("symbol").parquet(store)
    status.where("status = 'ok'").select(*KEY, "rows").write.mode("append").parquet(manifest)
    failed = status.where("status = 'failed'").select(*KEY, "message").take(1)
    if failed:
        raise RuntimeError(f"request {failed[0].symbol} failed: {failed[0].message}")
    drop(spark, fetched)
    rows = spark.read.schema(
        "symbol string, start date, end date, date date, arrival bigint, value double"
    ).parquet(store)
    came = F.struct("start", "end", "arrival")
    return rows.join(wanted, KEY, "left_semi").groupBy(
        F.col("symbol").alias("series_id"), "date"
    ).agg(F.min_by("value", came).alias("value"))
