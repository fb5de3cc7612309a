"""Payloads over HTTP: a data source for Spark, and a small server of payload files for trials."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from pathlib import Path
from urllib.request import Request, urlopen

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lamina.sources.feeds import FEEDS, Feed
from lamina.sources.payloads import PayloadError, parse_files


class Address(InputPartition):
    def __init__(self, url: str):
        super().__init__(url)
        self.url = url


class PayloadReader(DataSourceReader):
    """Each address is a partition of one row; a failed request fails its task, and Spark tries it again."""

    def __init__(self, urls: list[str], timeout: float):
        self.urls, self.timeout = urls, timeout

    def partitions(self) -> list[Address]:
        return [Address(u) for u in self.urls]

    def read(self, partition: Address) -> Iterator[tuple]:
        with urlopen(Request(partition.url, headers={"Accept": "application/json"}), timeout=self.timeout) as answer:
            yield partition.url.rsplit("/", 1)[-1], answer.read().decode("utf-8")


class PayloadSource(DataSource):
    """format("payloads") with the option urls (separated by spaces) and timeout in seconds: (file, value) rows."""

    @classmethod
    def name(cls) -> str:
        return "payloads"

    def schema(self) -> str:
        return "file string, value string"

    def reader(self, schema) -> PayloadReader:
        return PayloadReader(self.options.get("urls", "").split(), float(self.options.get("timeout", "30")))


def read_urls(spark: SparkSession, urls: list[str], feeds: dict[str, Feed] | None = None, system: str = "", api_prefix: str = "source", timeout: float = 30) -> DataFrame:
    """Rows of the payloads at the addresses, as read_payloads() gives them for files."""
    spark.dataSource.register(PayloadSource)
    answers = spark.read.format("payloads").option("urls", " ".join(urls)).option("timeout", timeout).load()
    return parse_files(answers, feeds or FEEDS, system, api_prefix)


def load_fixture(folder: str, name: str) -> dict:
    """A payload file of the folder; a missing or malformed one is a PayloadError."""
    path = Path(folder) / name
    try:
        payload = json.loads(path.read_text(encoding="utf-8"))
    except FileNotFoundError:
        raise PayloadError(f"{name}: not found") from None
    except ValueError as e:
        raise PayloadError(f"{name}: not JSON: {e}") from None
    return payload


#: Addresses under /api/ and the files that they serve.
ROUTES = {"firms": "firms_test.json", "interruptibles": "interruptibles_test.json", "ioc": "ioc_test.json", "awards": "awards_test.json"}


def server(folder: str, port: int = 0, origins: str | None = None) -> ThreadingHTTPServer:
    """GET /health and GET /api/<feed> of a folder's payload files; a file that can't be read is status 500 with its reason.

    origins: the origins that browsers may call from, separated by commas; else those in CORS_ALLOW_ORIGINS.
    """
    allowed = [o.strip() for o in (origins if origins is not None else os.environ.get("CORS_ALLOW_ORIGINS", "")).split(",") if o.strip()]

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:
            name = self.path.split("?")[0].rstrip("/")
            try:
                if name == "/health":
                    self.answer(200, {"status": "ok"})
                elif name.startswith("/api/") and name[5:] in ROUTES:
                    self.answer(200, load_fixture(folder, ROUTES[name[5:]]))
                else:
                    self.answer(404, {"detail": "not found"})
            except PayloadError as e:
                self.answer(500, {"detail": str(e)})

        def answer(self, status: int, body: dict) -> None:
            data = json.dumps(body).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(data)))
            origin = self.headers.get("Origin")
            if origin and (origin in allowed or "*" in allowed):
                self.send_header("Access-Control-Allow-Origin", origin)
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *args) -> None:
            pass

    return ThreadingHTTPServer(("127.0.0.1", port), Handler)
