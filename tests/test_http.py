"""Payloads over HTTP."""

from __future__ import annotations

import json
import threading
from urllib.error import HTTPError
from urllib.request import Request, urlopen

import pytest

from lamina.sources.http import load_fixture, read_urls, server
from lamina.sources.payloads import PayloadError


@pytest.fixture
def base(tmp_path):
    (tmp_path / "ioc_test.json").write_text(json.dumps({"feedType": "gINDEX", "records": [{"ID": 1, "Pipe": "p"}, {"ID": 2, "Pipe": "q"}]}))
    (tmp_path / "awards_test.json").write_text("{")
    s = server(str(tmp_path), origins="http://a")
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}", tmp_path
    s.shutdown()


def test_server(base):
    url, folder = base
    with urlopen(Request(f"{url}/health", headers={"Origin": "http://a"})) as answer:
        assert json.load(answer) == {"status": "ok"} and answer.headers["Access-Control-Allow-Origin"] == "http://a"
    for path, status in (("/api/awards", 500), ("/api/firms", 500), ("/api/none", 404)):
        with pytest.raises(HTTPError) as e:
            urlopen(url + path)
        assert e.value.code == status and json.load(e.value)["detail"]
    with pytest.raises(PayloadError):
        load_fixture(str(folder), "none.json")


def test_source(spark, base):
    rows = read_urls(spark, [f"{base[0]}/api/ioc", f"{base[0]}/health"]).collect()
    assert sorted((r.file, r.raw_record_id, r.error) for r in rows if r.error is None) == [("ioc", "1", None), ("ioc", "2", None)]
    assert [r.error for r in rows if r.file == "health"] == ["no feed type"]
