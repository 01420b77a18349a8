import json

import pytest

from ledgerfold import cli
from ledgerfold.sources.client import CircuitOpen, Client, Malformed, checked_key, fetch_vintages, paginate


def client(transport, **k):
    slept = []
    return Client("s", transport, sleep=slept.append, clock=lambda: 0.0, **k), slept


def test_retries_back_off():
    calls = []

    def flaky(url):
        calls.append(url)
        if len(calls) < 3:
            raise OSError("no")
        return b"yes"

    c, slept = client(flaky)
    assert c.get("u") == b"yes" and len(calls) == 3 and slept == [0.5, 1.0] and c.failed_calls == 0


def test_circuit_opens_after_failed_calls():
    def dead(url):
        raise OSError("no")

    c, _ = client(dead, threshold=2, attempts=2)
    for _ in range(2):
        with pytest.raises(OSError):
            c.get("u")
    with pytest.raises(CircuitOpen):
        c.get("u")
    assert c.requests == 4


def test_cache_answers_before_the_circuit(tmp_path):
    n = []
    c, _ = client(lambda u: n.append(u) or b"x", cache=tmp_path)
    assert c.get("u") == c.get("u") == b"x" and len(n) == 1
    c.failed_calls = 99
    assert c.get("u") == b"x"


def test_pacing():
    c, slept = client(lambda u: b"", spacing=0.6)
    c.get("a")
    c.get("b")
    assert slept == [0.6]


def test_pages():
    pages = {0: [{"i": 1}, {"i": 2}, {"i": 3}], 3: [{"i": 4}]}
    asked = []

    def transport(url):
        asked.append(url)
        return json.dumps({"results": pages.get(int(url.rsplit("=", 1)[1]), [])}).encode()

    c, _ = client(transport)
    assert [r["i"] for r in paginate(c, "http://x?a=1", 3)] == [1, 2, 3, 4]
    assert asked[0] == "http://x?a=1&limit=3&skip=0" and len(asked) == 2
    assert len(list(paginate(c, "http://x", 3, max_records=3))) == 3


def test_keys_are_never_told():
    secret = "A" * 31
    with pytest.raises(Malformed) as e:
        checked_key(secret)
    assert secret not in str(e.value)
    with pytest.raises(Malformed):
        checked_key(" ")
    c, _ = client(lambda u: u.encode())
    assert b"api_key=" + b"a" * 32 in fetch_vintages(c, "S", " " + "a" * 32 + "\n")


def test_live_documents_by_one_client_a_source(tmp_path):
    asked, slept = [], []

    def transport(url):
        asked.append(url)
        return url.encode()

    by = cli.clients(transport=transport, sleep=slept.append, clock=lambda: 0.0, cache=tmp_path / "cache")
    got = cli.fetch(tmp_path / "docs", "all", "b" * 32, by)
    assert sorted(got) == sorted(["shortages.json", "recalls.json", "vintages.json", *cli.PAIR_KEYS, "index.xlsx"])
    assert all((tmp_path / "docs" / n).read_bytes().decode() in asked for n in got)
    assert len([u for u in asked if "/IMTS/+/" in u and u.endswith("lastNObservations=15")]) == 3
    assert slept == [0.6, 1.0, 1.0] and by["openfda"].requests == 2 and by["imf"].requests == 3
    assert cli.fetch(tmp_path / "docs", "alfred", " ", by) == [] and cli.fetch(tmp_path / "docs", "gscpi", None, by) == ["index.xlsx"]
    assert by["gscpi"].requests == 1  # the second answer is the cache's
    landed = [cli.land_documents(tmp_path / "docs", tmp_path / "landing", lane, "2031-02-03") for lane in cli.DOCUMENTS]
    assert sum(map(len, landed)) == len(got) and cli.land_documents(tmp_path / "docs", tmp_path / "landing", "imf", "2031-02-03") == landed[3]


def test_live_tariffs(tmp_path):
    c, slept = client(lambda u: json.dumps([{"htsno": "1", "general": "Free", "description": u}]).encode(), spacing=1.0)
    cli.fetch_tariffs(tmp_path, [{"effective_from": "2030-01-01", "label": "one", "name": "r1"}, {"effective_from": "2030-02-01", "label": "two", "name": "r2"}], c)
    assert slept == [1.0] and [r["file"] for r in json.loads((tmp_path / "revisions.json").read_text())["revisions"]] == ["r1.json", "r2.json"]
    assert "revision=r2" in (tmp_path / "r2.json").read_text()


def test_pages_as_a_spark_source(spark):
    import http.server
    import threading
    from urllib.parse import parse_qs, urlparse

    from ledgerfold.sources.paged import PagedSource

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            q = {k: int(v[0]) for k, v in parse_qs(urlparse(self.path).query).items()}
            body = json.dumps({"results": [{"i": i} for i in range(25)][q["skip"] : q["skip"] + q["limit"]]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        spark.dataSource.register(PagedSource)
        rows = spark.read.format("paged").option("url", f"http://127.0.0.1:{server.server_port}/x.json?a=1").option("pageSize", 10).option("maxRecords", 50).load()
        assert rows.rdd.getNumPartitions() == 5
        assert sorted((r["skip"], json.loads(r["record"])["i"]) for r in rows.collect()) == [(i - i % 10, i) for i in range(25)]
    finally:
        server.shutdown()


def test_live_index_and_binary(tmp_path):
    c, _ = client(lambda u: b"\xd0\xcf\x11\xe0" + u.encode())
    from ledgerfold.sources import client as live

    assert live.fetch_index(c).startswith(b"\xd0\xcf\x11\xe0") and live.fetch_series(c, "A.B.C.D", 3).endswith(b"/A.B.C.D?lastNObservations=3")
    assert b"limit=1000" in live.fetch_snapshot(c, "recalls")
