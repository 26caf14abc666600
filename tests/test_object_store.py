import hashlib
import hmac
import re
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qsl, unquote, urlsplit

import pytest

from coldtide import fixtures
from coldtide.plans.catalog import read
from coldtide.sources import options
from coldtide.sources.storage import ObjectStore, StoreError, encode

SECRET = "secret/key+1"


class Fake(BaseHTTPRequestHandler):
    """Lists and serves ``server.objects`` under one bucket, two keys a page."""

    def log_message(self, *_):
        pass

    def answer(self, status, body):
        self.send_response(status)
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body)

    def signed(self):
        auth = self.headers.get("Authorization")
        if not self.server.secret:
            return auth is None
        names = re.search("SignedHeaders=([^,]*)", auth)[1]
        scope = re.search("Credential=key/([^,]*)", auth)[1]
        where = urlsplit(self.path)
        canonical = "\n".join(["GET", where.path, where.query, *(f"{n}:{self.headers[n]}" for n in names.split(";")), "", names, hashlib.sha256(b"").hexdigest()])
        text = "\n".join(["AWS4-HMAC-SHA256", self.headers["x-amz-date"], scope, hashlib.sha256(canonical.encode()).hexdigest()])
        key = b"AWS4" + self.server.secret.encode()
        for part in scope.split("/"):
            key = hmac.new(key, part.encode(), hashlib.sha256).digest()
        return auth.endswith(hmac.new(key, text.encode(), hashlib.sha256).hexdigest())

    def do_GET(self):
        self.server.requests.append(self.path)
        if self.server.failures:
            self.server.failures -= 1
            return self.answer(503, b"slow down")
        if not self.signed():
            return self.answer(403, b"<Error>SignatureDoesNotMatch</Error>")
        where = urlsplit(self.path)
        path = unquote(where.path)
        if path == "/bucket/":
            q = dict(parse_qsl(where.query))
            keys = sorted(k for k in self.server.objects if k.startswith(q.get("prefix", "")))
            first = int(q.get("continuation-token", 0))
            items = "".join(f"<Contents><Key>{k.replace('&', '&amp;')}</Key><Size>{len(self.server.objects[k])}</Size></Contents>" for k in keys[first : first + 2])
            more = f"<NextContinuationToken>{first + 2}</NextContinuationToken>" if first + 2 < len(keys) else ""
            return self.answer(200, f'<ListBucketResult xmlns="http://s3.amazonaws.com/doc/2006-03-01/">{items}{more}</ListBucketResult>'.encode())
        body = self.server.objects.get(path.removeprefix("/bucket/"))
        return self.answer(404, b"<Error>NoSuchKey</Error>") if body is None else self.answer(200, body)


@pytest.fixture
def service():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Fake)
    server.objects, server.secret, server.failures, server.requests = {}, None, 0, []
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield server
    server.shutdown()
    server.server_close()


def settings_of(service, **more):
    return options.parse("splunks3://bucket/pre fix", {"endpoint": f"http://127.0.0.1:{service.server_port}", **more})


def test_pages_prefix_and_get(service):
    for k in ("pre fix/a/journal.gz", "pre fix/b&c/journal.gz", "pre fix/d/journal.zst", "pre fix/e/x.tsidx", "pre fixed/journal.gz"):
        service.objects[k] = k.encode()
    store = ObjectStore(settings_of(service))
    assert sorted(store.list()) == [("a/journal.gz", 20), ("b&c/journal.gz", 22), ("d/journal.zst", 21)]
    assert store.open("b&c/journal.gz").read() == b"pre fix/b&c/journal.gz"
    with pytest.raises(StoreError, match=r"reading \[nothing\] failed with status 404: <Error>NoSuchKey"):
        store.open("nothing")


def test_signature_token_and_retries(service):
    service.secret, service.failures = SECRET, 2
    service.objects["pre fix/a/journal.gz"] = b"x"
    store = ObjectStore(settings_of(service, access_key="key", secret_key=SECRET, session_token="to/ken"))
    assert list(store.list()) == [("a/journal.gz", 1)]
    with pytest.raises(StoreError, match="status 403"):
        list(ObjectStore(settings_of(service, access_key="key", secret_key="wrong")).list())


def test_addressing():
    s = options.parse("s3://bucket/p", {"endpoint": "http://h:9", "path_style": "false"})
    assert (ObjectStore(s).host, ObjectStore(s).base) == ("bucket.h:9", "")
    assert encode("a/b c~é", slash=False) == "a/b%20c~%C3%A9" and encode("a/b") == "a%2Fb"


def test_query_over_objects(spark, service, tmp_path):
    fixtures.build_events([(i, (fixtures.FIRST_DAY * 86_400 + i) * 1_000_000, i, "purchase", 0.5, '{"k": 1}') for i in range(20)], str(tmp_path))
    for path in tmp_path.rglob("*"):
        if path.is_file():
            service.objects["pre fix/" + path.relative_to(tmp_path).as_posix()] = path.read_bytes()
    df = read(spark, "splunks3://bucket/pre fix", endpoint=f"http://127.0.0.1:{service.server_port}")
    assert df.count() == 20 and df.select("splunk.index").distinct().first()[0] == "sales"


def test_a_body_that_breaks_off_is_an_error(service):
    service.objects["pre fix/a/journal.gz"] = b"0123456789"
    whole, Fake.answer = Fake.answer, lambda self, status, body: (self.send_response(status), self.send_header("Content-Length", str(len(body) + 5)), self.end_headers(), self.wfile.write(body))
    try:
        body = ObjectStore(settings_of(service)).open("a/journal.gz")
        assert body.read(4) == b"0123" and body.read(6) == b"456789"
        with pytest.raises(StoreError, match="broke off 5 bytes before its end"):
            body.read(4)
        with pytest.raises(StoreError, match="broke off"):
            ObjectStore(settings_of(service)).open("a/journal.gz").read()
        with pytest.raises(StoreError, match="broke off"):
            list(ObjectStore(settings_of(service)).list())
    finally:
        Fake.answer = whole
