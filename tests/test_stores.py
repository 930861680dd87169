"""Record stores against a local server."""

import json
import re
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlsplit

import pytest
from pyspark.sql import Row
from pyspark.sql.types import StringType, StructField, StructType

from lawloom.sources import stores


class Server:
    """A store of records and of rows, which fails as often as it is told to and remembers what it was asked."""

    def __init__(self):
        self.records = [{"id": f"rec{k}", "createdTime": "t", "fields": {"Name": f"law{k}", "Year": 1900 + k, "Tags": ["a", "b"], "Family": "ab"[k % 2]}} for k in range(25)]
        self.rows = [{"name": f"n{k}", "year": k, "live": k % 2 == 0} for k in range(23)]
        self.stored, self.batches, self.asked, self.failing, self.lost = {}, [], [], 0, 0
        server = self

        class Handler(BaseHTTPRequestHandler):
            def log_message(self, *_):
                pass

            def answer(self, code, body):
                data = json.dumps(body).encode()
                self.send_response(code)
                self.send_header("Content-Length", str(len(data)))
                self.end_headers()
                self.wfile.write(data)

            def do_GET(self):
                at, asks = urlsplit(self.path), parse_qs(urlsplit(self.path).query)
                server.asked.append((self.path, self.headers.get("Authorization")))
                if server.failing:
                    server.failing -= 1
                    return self.answer(503, {})
                if at.path == "/missing":
                    return self.answer(422, {"error": "no"})
                if at.path == "/base/table":
                    found = server.records
                    for f in re.findall(r'\{(\w+)\}="(\w+)"', asks.get("filterByFormula", [""])[0]):
                        alike = re.findall(r'"(\w+)"', asks["filterByFormula"][0])
                        found = [r for r in found if r["fields"][f[0]] in alike]
                    start, size = int(asks.get("offset", ["0"])[0].removeprefix("at")), int(asks["pageSize"][0])
                    wanted = asks.get("fields[]", [])
                    page = [r | {"fields": {k: v for k, v in r["fields"].items() if k in wanted}} for r in found[start : start + size]]
                    return self.answer(200, {"records": page} | ({"offset": f"at{start + size}"} if start + size < len(found) else {}))
                found = server.rows
                if "name" in asks:
                    names = re.sub(r"^(?:eq\.|in\.\()|\)$", "", asks["name"][0]).split(",")
                    found = [r for r in found if r["name"] in names]
                start = int(asks.get("offset", ["0"])[0])
                columns = asks["select"][0].split(",")
                return self.answer(200, [{c: r[c] for c in columns} for r in found[start : start + int(asks["limit"][0])]])

            def do_PATCH(self):
                body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
                for r in body["records"]:
                    key = tuple(r["fields"].get(c) for c in body["performUpsert"]["fieldsToMergeOn"])
                    server.stored[key] = server.stored.get(key, {}) | r["fields"]
                server.batches.append(len(body["records"]))
                if server.lost:  # stored, but the answer is lost
                    server.lost -= 1
                    return self.answer(500, {})
                return self.answer(200, {})

        self.http = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.url = f"http://127.0.0.1:{self.http.server_port}"
        threading.Thread(target=self.http.serve_forever, daemon=True).start()


@pytest.fixture
def server():
    s = Server()
    yield s
    s.http.shutdown()


def test_addresses():
    assert stores.rest_url(name="UK_uksi_2000_1") == "?name=eq.UK_uksi_2000_1"
    assert stores.rest_url(name=["UK_uksi_2000_1", "UK_uksi_2000_2"]) == "?name=in.(UK_uksi_2000_1,UK_uksi_2000_2)"
    assert stores.rest_url("uk_lrt", name="a", sql="year=gt.2", select=["name", "year"], limit=5, offset=0, order="name") == "rest/v1/uk_lrt?name=eq.a&year=gt.2&select=name,year&limit=5&offset=0&order=name"
    assert stores.rest_url("users", select="id,name", limit=10) == "rest/v1/users?select=id,name&limit=10" and stores.rest_url() == "" and stores.rest_url("t") == "rest/v1/t"
    assert stores.paged_url("/b/t", ["Name", "A B"], "Grid view", '{Name}="x"', "10", "rec1") == "/b/t?maxRecords=10&view=Grid%20view&fields%5B%5D=Name&fields%5B%5D=A%20B&filterByFormula=%7BName%7D%3D%22x%22&offset=rec1"
    assert stores.paged_url("/b/t") == "/b/t"


def test_pages_follow_their_tokens_and_failures_are_asked_again(spark, server):
    stores.register(spark)
    server.failing = 2
    laws = spark.read.format("paged_records").schema("id string, Name string, Year int, Tags string, Other string").options(url=f"{server.url}/base/table", pageSize=10, token="secret").load()
    got = laws.orderBy("Year").collect()
    assert [tuple(r) for r in got] == [(f"rec{k}", f"law{k}", 1900 + k, "a,b", None) for k in range(25)]
    assert len(server.asked) >= 5 and {a for _, a in server.asked} == {"Bearer secret"} and all("fields%5B%5D=Name" in p and "Family" not in p for p, _ in server.asked)


def test_formulas_are_read_side_by_side_and_filters_reach_the_store(spark, server):
    stores.register(spark)
    read = lambda **more: spark.read.format("paged_records").schema("id string, Name string, Family string").options(url=f"{server.url}/base/table", pageSize=5, **more).load()
    both = read(formulas='{Family}="a"\n{Family}="b"')
    assert both.rdd.getNumPartitions() == 2 and both.count() == 25
    server.asked.clear()
    assert [r.id for r in read().filter("Name = 'law7'").collect()] == ["rec7"] and len(server.asked) == 1
    assert "filterByFormula=%7BName%7D%3D%22law7%22" in server.asked[0][0]
    assert sorted(r.id for r in read().filter("Name IN ('law7', 'law9') AND Family = 'b'").collect()) == ["rec7", "rec9"]


def test_rows_are_read_by_windows(spark, server):
    stores.register(spark)
    read = lambda **more: spark.read.format("rest_rows").schema("name string, year int, live boolean").options(url=f"{server.url}/rest/v1", table="laws", pageSize=5, **more).load()
    for rows, parts in ((None, 1), (23, 5), (11, 3), (0, 1)):  # the last window goes on to the end, if there are more rows than were told
        df = read(order="name", rows=str(rows)) if rows is not None else read()
        assert df.rdd.getNumPartitions() == parts and sorted((r.year, r.name, r.live) for r in df.collect()) == [(k, f"n{k}", k % 2 == 0) for k in range(23)]
    server.asked.clear()
    assert [r.year for r in read().filter("name IN ('n3', 'n4')").orderBy("year").collect()] == [3, 4] and "name=in.(n3,n4)" in server.asked[0][0]


def test_answers_that_will_not_change_raise(spark, server):
    stores.register(spark)
    with pytest.raises(Exception, match="422"):
        spark.read.format("paged_records").schema("id string").option("url", f"{server.url}/missing").load().collect()
    assert len(server.asked) == 1
    with pytest.raises(Exception, match="schema"):
        spark.read.format("paged_records").option("url", server.url).load()


def test_batches_of_ten_that_may_be_sent_again(spark, server):
    stores.register(spark)
    server.lost = 2
    rows = spark.range(47).selectExpr("concat('law', id) AS Name", "id AS Year", "CASE WHEN id % 2 = 0 THEN 'x' END AS Note").repartition(3)
    write = rows.write.format("record_batches").option("url", f"{server.url}/base/table").mode("append")
    write.option("key", "Name").save()
    assert len(server.stored) == 47 and max(server.batches) <= 10 and server.stored[("law4",)] == {"Name": "law4", "Year": 4, "Note": "x"} and "Note" not in server.stored[("law5",)]
    write.option("key", "Name").save()
    assert len(server.stored) == 47
    for options in ({"key": ""}, {"key": "None"}):
        with pytest.raises(Exception, match="key"):
            write.options(**options).save()


def test_a_task_that_is_lost_leaves_no_row_twice(server):
    writer = stores.BatchWriter(StructType([StructField("Name", StringType())]), {"url": server.url, "key": "Name"})

    def rows(until):
        for k in range(25):
            if k == until:
                raise RuntimeError("lost")
            yield Row(Name=f"law{k}")

    with pytest.raises(RuntimeError):
        writer.write(rows(23))
    assert len(server.stored) == 20 and writer.write(rows(None)) == stores.Sent(25, 3) and len(server.stored) == 25
