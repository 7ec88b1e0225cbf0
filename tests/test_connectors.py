"""Connectors against services, databases and stores that the test runs itself."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from tributary.sources import connectors, object_store

SEEN = []


class Service(BaseHTTPRequestHandler):
    def do_GET(self):  # noqa: N802
        at, ask = urlparse(self.path), {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
        SEEN.append((at.path, ask, dict(self.headers)))
        if at.path == "/list":
            body = [{"n": i} for i in range(5)]
        elif at.path == "/same":
            body = {"data": [{"n": i} for i in range(7)]}
        elif at.path == "/delta":
            body = {"results": [{"n": i} for i in range(int(ask["after"]) + 1, 12)]}
        else:
            size, p = int(ask["per"]), int(ask["p"])
            body = {"items": [{"n": i} for i in range((p - 1) * size, min(23, p * size))], "next": p * size < 23}
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps(body).encode())

    def log_message(self, *a):
        pass


@pytest.fixture(scope="module")
def base():
    server = HTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def numbers(df):
    return sorted(json.loads(r.record)["n"] for r in df.collect())


def test_rest_yields_each_record_once(spark, base):
    con = connectors.connector(spark, "rest", base_url=base, endpoints=[{"path": "/list"}, {"path": "/paged"}], page_param="p", size_param="per", size=5, auth_type="bearer", token="t0", delta_param="after")
    assert con.list_resources() == ["/list", "/paged"]
    assert numbers(con.pull_full("/list")) == list(range(5))
    assert numbers(con.pull_full("/paged")) == list(range(23))
    assert numbers(con.pull_delta("/delta", since=8)) == [9, 10, 11]
    assert numbers(con.pull_sample("/paged", 3)) == [0, 1, 2]
    assert all(h["Authorization"] == "Bearer t0" for p, _, h in SEEN if p == "/paged")


def test_rest_that_ignores_the_page(spark, base):
    con = connectors.connector(spark, "rest", size=7, auth_type="api_key", api_key="k1", api_key_header="X-Key")
    assert numbers(con.pull_full(f"{base}/same")) == list(range(7))
    assert [h for p, _, h in SEEN if p == "/same"][0]["X-Key"] == "k1"


def test_records_in(spark):
    bodies = ['[{"k":1},{"k":2}]', '{"results":[{"k":3}]}', '{"data":[{"k":4}],"items":[{"k":9}]}', "{}", None]
    got = spark.createDataFrame([(b,) for b in bodies], "b string").select(connectors.records_in(F.col("b"), "struct<k long>").alias("r")).collect()
    assert [[x.k for x in r.r] if r.r else r.r for r in got] == [[1, 2], [3], [4], None, None]


def test_jdbc_on_an_embedded_database(spark):
    url = {"url": "jdbc:derby:memory:tributary;create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = spark.range(20).select(F.col("id").alias("K"), F.concat(F.lit("n"), "id").alias("NAME"))
    w = rows.write.format("jdbc").mode("overwrite").option("dbtable", "T1")
    for k, v in url.items():
        w = w.option(k, v)
    w.save()
    con = connectors.connector(spark, "jdbc", **url, tables_query="SELECT TABLENAME AS NAME FROM SYS.SYSTABLES WHERE TABLETYPE = 'T'")
    assert con.test_connection() and "T1" in con.list_resources()
    assert con.pull_full("T1").count() == 20 and con.pull_sample("T1", 3).count() == 3
    assert sorted(r.K for r in con.pull_delta("T1", "K", 16).collect()) == [17, 18, 19]
    assert con.pull_full("T1", "SELECT COUNT(*) AS N FROM T1").first().N == 20
    with pytest.raises(ValueError):
        con.pull_full("T1; DROP TABLE T1")


def test_object_store(spark, tmp_path):
    s = object_store.ObjectStore(spark, f"file://{tmp_path}/bucket")
    assert s.list() == [] and not s.exists("a/x.txt")
    s.put("a/x.txt", b"1")
    s.put("a/x.txt", b"22")
    s.put("b.bin", bytes(range(256)))
    assert s.get("a/x.txt") == b"22" and s.get("b.bin") == bytes(range(256))
    assert s.list() == ["a/x.txt", "b.bin"] and s.list("a/") == ["a/x.txt"] and s.read("*.txt").count() == 1
    assert s.presign("b.bin").endswith("/bucket/b.bin") and object_store.ObjectStore(spark, "x", lambda a, n: f"{a}?t={n}").presign("k", 5) == "x/k?t=5"
    assert s.delete("b.bin") and not s.delete("b.bin")
    with pytest.raises(KeyError):
        s.get("b.bin")
    for bad in ("", "/etc", "../x"):
        with pytest.raises(ValueError):
            s.address(bad)
    assert object_store.parse("s3://b/k/x") == ("b", "k/x")
    with pytest.raises(ValueError):
        object_store.parse("k/x")


def test_sources_of_nodes(spark):
    nodes = spark.createDataFrame([("f1",), ("orders",), ("orders",), ("none",), (None,)], "s string")
    files = spark.createDataFrame([("f1", "x.csv"), ("f3", "orders.csv"), ("f2", "orders.json")], "id string, name string")
    assert {tuple(r) for r in connectors.sources_of(nodes, "s", files, "id", "name").collect()} == {("f1", "f1"), ("orders", "f2")}
