import json

import pytest
from pyspark.sql import functions as F

from tessera import cli
from tessera.sources import readers, web
from tessera.streaming import ingest


def test_text_files(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"\xef\xbb\xbfhi\r\nyou")
    (tmp_path / "b.md").write_bytes(b"\xff\xfe")
    (tmp_path / "c.txt").write_bytes(b"a\0b")
    (tmp_path / "d.txt").write_bytes(b" \n")
    (tmp_path / "e.txt").write_bytes(b"x" * 50)
    (tmp_path / "f.txt").write_bytes(b"")
    rows = {r.file_name: r for r in readers.read_text_files(spark, f"file://{tmp_path}", limits=readers.Limits(text_bytes=40)).collect()}
    assert rows["a.txt"].text == "hi\nyou" and rows["a.txt"].code is None and rows["b.md"].suffix == ".md"
    assert [rows[n].code for n in ("b.md", "c.txt", "d.txt", "e.txt", "f.txt")] == ["INGEST_INVALID_ENCODING", "INGEST_UNSUPPORTED_CONTENT", "INGEST_EMPTY_FILE", "INGEST_FILE_TOO_LARGE", "INGEST_EMPTY_FILE"]


def test_binary_files(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.7")
    (tmp_path / "b.pdf").write_bytes(b"nope")
    (tmp_path / "c.pdf").write_bytes(b"")
    rows = {r.file_name: r.code for r in readers.read_binary_files(spark, f"file://{tmp_path}").collect()}
    assert rows == {"a.pdf": None, "b.pdf": "PDF_PARSE_FAILED", "c.pdf": "INGEST_EMPTY_FILE"}


def test_provider_responses_and_segments(spark, tmp_path):
    response = {"provider_metadata": {"name": "p", "case_id": "c"}, "candidates": [{"candidate_id": "x", "candidate_type": "claim", "epistemic_status": "verified"}], "warnings": [], "errors": []}
    (tmp_path / "p.json").write_text(json.dumps(response))
    row = readers.read_provider_responses(spark, f"file://{tmp_path}/p.json").first()
    assert (row.document_id, row.candidate_id, row.epistemic_status) == ("c", "x", "verified")
    folder = tmp_path / "m"
    folder.mkdir()
    segment = lambda n: {"sequence_no": n, "unit_type": "paragraph", "text": "t", "locator": {"block_no": 1}}
    for name, numbers in (("good", (0, 1)), ("gap", (0, 2)), ("none", ())):
        (folder / f"{name}.json").write_text(json.dumps({"schema_version": "1.0", "workspace_id": "w", "segments": [segment(n) for n in numbers]}))
    codes = {r.document_id.rsplit("/", 1)[1]: r.code for r in readers.read_segments(spark, f"file://{folder}").collect()}
    assert codes == {"good.json": None, "gap.json": "INGEST_INVALID_SEGMENTS", "none.json": "INGEST_INVALID_SEGMENTS"}


def test_requests_and_urls(spark):
    rows = [("1", "text", "p", None, None, None, "n", "blog"), ("2", "text", "p", "u", "1", "main", None, None), ("3", "what", None, "u", None, None, "n", "blog")]
    frame = spark.createDataFrame(rows, "request_id string, input_type string, path string, url string, page_selection string, content_selector string, source_name string, source_type string")
    found = {(r.request_id, r.code) for r in readers.request_findings(frame).collect()}
    assert found == {("2", "PATH_OR_URL"), ("2", "PAGES_ONLY_FOR_PDF"), ("2", "SELECTOR_ONLY_FOR_HTML"), ("2", "SOURCE_REQUIRED"), ("3", "UNKNOWN_INPUT_TYPE")}
    urls = spark.createDataFrame([(u,) for u in ("http://a.b/c?d", "https://u:p@a.b", "ftp://a", "/x", None)], "url string")
    assert [r.c for r in urls.select(readers.url_admission(F.col("url")).alias("c")).collect()] == [None] + ["WEB_INVALID_URL"] * 4
    with pytest.raises(ValueError):
        readers.Limits(text_bytes=0)
    assert readers.Limits().with_(pdf_pages=7, redirects=None).pdf_pages == 7 and readers.Limits().of("pdf") == 50 << 20


def test_blocked_addresses(spark):
    bad = ("127.0.0.1", "10.1.2.3", "169.254.1.1", "::1", "224.0.0.1", "0.0.0.0", "::ffff:192.168.0.1", "x")
    frame = spark.createDataFrame([(a,) for a in (*bad, "8.8.8.8")], "a string")
    assert [r.b for r in frame.select(web.is_blocked_address(F.col("a")).alias("b")).collect()] == [True] * len(bad) + [False]


def page(status=200, body=b"<p>x", kind="text/html; charset=utf-8", **headers):
    return status, {"content-type": kind, **{k.replace("_", "-"): v for k, v in headers.items()}}, lambda n: body[:n]


PAGES = {
    "http://ok/": page(), "http://hop/": page(302, location="http://ok/"), "http://loop/": page(301, location="/"), "http://in/": page(302, location="http://private/"), "http://bin/": page(kind="image/png"),
    "http://big/": page(body=b"x" * 200), "http://said/": page(content_length="999"), "http://gone/": page(404), "http://odd/": page(body=b"\xff"), "http://empty/": page(body=b" "),
}


def test_fetch():
    resolver = lambda host, port: ["10.0.0.1"] if host == "private" else ["8.8.8.8"]
    limits = readers.Limits(text_bytes=100, redirects=2)
    got = {u: web.fetch(u, limits, resolver, lambda url, timeout, address: PAGES[url]) for u in (*PAGES, "http://private/", "http://u@ok/")}
    assert got["http://hop/"]["text"] == "<p>x" and got["http://hop/"]["final_url"] == "http://ok/"
    assert {u.split("/")[2]: r["code"] for u, r in got.items() if r["code"]} == {
        "loop": "WEB_TOO_MANY_REDIRECTS", "in": "WEB_PRIVATE_ADDRESS_BLOCKED", "bin": "WEB_UNSUPPORTED_CONTENT_TYPE", "big": "WEB_RESPONSE_TOO_LARGE", "said": "WEB_RESPONSE_TOO_LARGE",
        "gone": "WEB_HTTP_ERROR", "odd": "INGEST_INVALID_ENCODING", "empty": "WEB_EMPTY_MAIN_CONTENT", "private": "WEB_PRIVATE_ADDRESS_BLOCKED", "u@ok": "WEB_INVALID_URL",
    }


def test_fetch_over_rows(spark):
    urls = spark.createDataFrame([("http://127.0.0.1/",), ("nonsense",)], "url string")
    assert {r.code for r in web.fetch_urls(urls).collect()} == {"WEB_PRIVATE_ADDRESS_BLOCKED", "WEB_INVALID_URL"}


def fixed_resolver(host, port):
    return ["10.0.0.1"] if host == "private" else ["8.8.8.8"]


def fixed_transport(url, timeout, address):
    assert address == "8.8.8.8"
    return PAGES[url]


def test_pages_as_a_data_source(spark):
    web.register(spark)
    read = spark.read.format("tessera_pages").options(resolver="tests.test_sources:fixed_resolver", transport="tests.test_sources:fixed_transport", maxBytes="100", redirects="2", partitions="3")
    urls = [*PAGES, "http://private/", "nonsense", "http://ok/"]
    frame = read.option("urls", "\n".join(urls)).load()
    rows = frame.collect()
    assert sorted(r.url for r in rows) == sorted(urls) and frame.rdd.getNumPartitions() == 3
    by = {r.url: r for r in rows}
    assert by["http://hop/"].redirects == ["http://hop/"] and by["http://hop/"].text == "<p>x" and by["http://ok/"].code is None
    assert (by["http://private/"].code, by["nonsense"].code, by["http://in/"].code) == ("WEB_PRIVATE_ADDRESS_BLOCKED", "WEB_INVALID_URL", "WEB_PRIVATE_ADDRESS_BLOCKED")


def test_one_host_is_asked_slowly():
    import time

    urls = ["http://a/1", "http://b/1", "http://a/2", "http://b/2", "http://a/3"]
    reader = web.PageReader({"urls": "\n".join(urls), "partitions": "2"})
    assert sorted(p.value for p in reader.partitions()) == [["http://a/1", "http://a/2", "http://a/3"], ["http://b/1", "http://b/2"]]
    began = time.monotonic()
    rows = list(web._politely(iter(urls), readers.Limits(), fixed_resolver, lambda *_: page(), 0.1))
    assert len(rows) == 5 and time.monotonic() - began >= 0.2


def test_the_connection_goes_to_the_checked_address():
    """The name in the url resolves to nothing; the page comes from the address given, asked for by that name."""
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Page(BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            body = f"{self.headers['Host']} {self.path}".encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(body)))
            self.send_header("ETag", "e1")
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Page)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        url = f"http://name.invalid:{server.server_port}/x?y=1"
        status, headers, read = web.transport(url, 5.0, "127.0.0.1")
        assert (status, headers["etag"], read(100).decode()) == (200, "e1", f"name.invalid:{server.server_port} /x?y=1")
        with pytest.raises(OSError):
            web.transport(url, 0.5, "192.0.2.1")
    finally:
        server.shutdown()


def test_streaming_ingest(spark, tmp_path):
    rows = spark.createDataFrame([("a", "one\n\ntwo"), ("b", "one\n\ntwo\n"), ("c", "three")], "document_id string, text string").withColumn("arrived_at", F.lit("2024-01-01").cast("timestamp"))
    rows.write.parquet(f"{tmp_path}/in")
    stream = ingest.watch_folder(spark, f"{tmp_path}/in")
    query = ingest.start_ingest(stream, f"{tmp_path}/out", f"{tmp_path}/state")
    assert query.awaitTermination(120)
    units = spark.read.parquet(f"{tmp_path}/out")
    assert units.count() == 3 and units.select("document_id").distinct().count() == 2
    counted = ingest.arrivals(ingest.watch_folder(spark, f"{tmp_path}/in")).writeStream.outputMode("complete").format("memory").queryName("arrived").trigger(availableNow=True).start()
    assert counted.awaitTermination(120) and spark.table("arrived").first().n_documents == 3


def test_cli(spark, tmp_path, capsys):
    assert cli.main(["schemas"]) == 0 and json.loads(capsys.readouterr().out)["status"] == "ok"
    (tmp_path / "a.txt").write_text("x\n\ny")
    assert cli.main(["parse", "text", f"file://{tmp_path}/a.txt", f"file://{tmp_path}/units"]) == 0
    assert json.loads(capsys.readouterr().out)["units"] == 2
    assert cli.main(["restore", f"file://{tmp_path}/s", f"file://{tmp_path}", "0"]) == 1
    assert json.loads(capsys.readouterr().out)["error_code"] == "BACKUP_NOT_FOUND"
