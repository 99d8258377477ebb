"""The gazette's service as a source: requests are rows, answers come with a status instead of failing the job.

A transport is any picklable function (url, timeout) -> (HTTP status, body); tests and mirrors pass their own.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.assets import has_signature

Transport = Callable[[str, float], tuple[int, bytes]]

#: Paths below the service's base (fixed values); {date} is DD-MM-YYYY
PATHS = {
    "diario": "diarios/porFecha/{date}",
    "notas": "notas/{date}",
    "indicadores": "indicadores/{date}",
    "nota": "notas/nota/{id}",
    "imagenes": "imagenesFsRecurso/obtieneImagenesFS/{id}",
    "pdf": "documentos/pdf/{id}",
    "imagen": "copiaCertificada/{id}",
}
#: Endpoints whose key is a date, and those whose answer is a file of a kind
BY_DATE = ("diario", "notas", "indicadores")
BINARY = {"pdf": "pdf", "imagen": "jpeg"}
INVALID = "invalid"
OK, NO_EDITION, RETRY = "ok", "no_edition", "retry"


def http(url: str, timeout: float) -> tuple[int, bytes]:
    from urllib.error import HTTPError
    from urllib.request import Request, urlopen

    try:
        with urlopen(Request(url, headers={"User-Agent": "Mozilla/5.0"}), timeout=timeout) as answer:
            return answer.status, answer.read()
    except HTTPError as error:
        return error.code, error.read()


def request_url(base: str, endpoint: str, key: Column) -> Column:
    """Address of a request; key is a date for the daily endpoints, EDITION/NAME for a page's image, a number for the others."""
    if endpoint not in PATHS:
        raise ValueError(f"endpoint is one of {', '.join(PATHS)}, not {endpoint!r}")
    text = F.date_format(key, "dd-MM-yyyy") if endpoint in BY_DATE else key.cast("string")
    suffix = ".jpg" if endpoint == "imagen" else ""
    return F.concat(F.lit(f"{base.rstrip('/')}/{PATHS[endpoint].partition('{')[0]}"), text, F.lit(suffix))


def answer(url: str, transport: Transport, timeout: float) -> tuple[str, int | None, bytes | None, str | None]:
    """(status, HTTP status, body, error): 404 means that there is no edition; any other failure is to be tried again."""
    try:
        code, body = transport(url, timeout)
    except Exception as error:  # noqa: BLE001  whatever a transport raises is an outcome of this request
        return RETRY, None, None, f"{type(error).__name__}: {error}"
    if code == 404:
        return NO_EDITION, code, None, None
    if not 200 <= code < 300:
        return RETRY, code, None, f"HTTP {code}"
    return OK, code, body, None


def fetch(requests: DataFrame, transport: Transport = http, timeout: float = 30.0, pause: float = 0.0) -> DataFrame:
    """requests (with column url) with status, http_status, body, error. A task waits ``pause`` seconds after each success.

    The number of partitions of requests bounds the parallel connections.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for url in batch["url"]:
                found.append(answer(url, transport, timeout))
                if pause and found[-1][0] == OK:
                    time.sleep(pause)
            out = pd.DataFrame(found, columns=["status", "http_status", "body", "error"], index=batch.index)
            out["http_status"] = out["http_status"].astype("Int32")
            yield pd.concat([batch, out], axis=1)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema)
    return requests.mapInPandas(run, f"{schema}, status string, http_status int, body binary, error string")


def ask(keys: DataFrame, base: str, endpoint: str, at: str, transport: Transport = http, timeout: float | None = None, pause: float = 0.0, connections: int = 4) -> DataFrame:
    """keys (key, ..) with status and body of their requests, each asked once: the answers are kept as Parquet at ``at``.

    A file of another kind than the endpoint's, as an error page, has status invalid and no body.
    """
    kind = BINARY.get(endpoint)
    requests = keys.withColumn("url", request_url(base, endpoint, F.col("key"))).repartition(connections, "key")
    found = fetch(requests, transport, timeout or (60.0 if kind else 30.0), pause)
    if kind:
        good = (F.col("status") != OK) | has_signature(F.col("body"), kind)
        found = found.withColumns({"status": F.when(good, F.col("status")).otherwise(INVALID), "body": F.when(good, F.col("body"))})
    found.write.mode("overwrite").parquet(at)
    return keys.sparkSession.read.parquet(at)


def register(spark: SparkSession, transport: Transport = http, name: str = "gazette_service") -> None:
    """spark.read.format(name).option("base", ..).option("endpoint", ..).option("keys", "a,b,..").load(): one task per key."""

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.base, self.endpoint = options["base"].rstrip("/"), options["endpoint"]
            self.keys = [k.strip() for k in options["keys"].split(",") if k.strip()]
            self.timeout = float(options.get("timeout", 30))

        def partitions(self):
            return [InputPartition(k) for k in self.keys]

        def read(self, partition):
            path = PATHS[self.endpoint].replace("{date}", partition.value).replace("{id}", partition.value)
            status, code, body, error = answer(f"{self.base}/{path}", transport, self.timeout)
            yield partition.value, status, code, None if body is None else body.decode("utf-8"), error

    class Service(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return "key string, status string, http_status int, body string, error string"

        def reader(self, schema):
            return Reader(self.options)

    spark.dataSource.register(Service)
