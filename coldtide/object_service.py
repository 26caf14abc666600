"""An in-process object service for tests and queries: it lists and serves a
folder's files under one bucket and recomputes request signatures.

Executors on other hosts reach it by the driver's address.
"""

from __future__ import annotations

import os
import re
import threading
from datetime import datetime, timezone
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qsl, unquote, urlsplit
from xml.sax.saxutils import escape

from coldtide.sources import options
from coldtide.sources.storage import signed_headers

BUCKET, KEY, SECRET, REGION = "archive", "key", "secret/key+1", "eu-test-1"
PAGE = 100


class _Handler(BaseHTTPRequestHandler):
    def log_message(self, *_: object) -> None:
        pass

    def _answer(self, status: int, body: bytes, announced: int | None = None) -> None:
        self.send_response(status)
        self.send_header("Content-Length", str(len(body) if announced is None else announced))
        self.end_headers()
        self.wfile.write(body)

    def _signed(self, path: str, query: str) -> bool:
        """Whether the signature is that of this host, path, query and time."""
        told = self.headers.get("Authorization") or ""
        settings = options.parse(f"s3://{BUCKET}", {"region": REGION, "access_key": KEY, "secret_key": SECRET})
        try:
            moment = datetime.strptime(self.headers["x-amz-date"], "%Y%m%dT%H%M%SZ").replace(tzinfo=timezone.utc)
        except (KeyError, TypeError, ValueError):
            return False
        return told == signed_headers(settings, self.headers["Host"], path, query, moment)["Authorization"]

    def do_GET(self) -> None:
        where = urlsplit(self.path)
        if not self._signed(where.path, where.query):
            self._answer(403, b"<Error>SignatureDoesNotMatch</Error>")
            return
        top, path = self.server.folder, unquote(where.path).removeprefix(f"/{BUCKET}/")
        if path:
            try:
                with open(os.path.join(top, path), "rb") as held:
                    data = held.read()
            except OSError:
                self._answer(404, b"<Error>NoSuchKey</Error>")
                return
            short = re.search(r"/short/", f"/{path}")
            self._answer(200, data[: len(data) // 2] if short else data, len(data))
            return
        asked = dict(parse_qsl(where.query))
        keys = sorted(os.path.relpath(os.path.join(d, n), top) for d, _, names in os.walk(top) for n in names)
        keys = [k for k in keys if k.startswith(asked.get("prefix", ""))]
        first = int(asked.get("continuation-token", 0))
        items = "".join(f"<Contents><Key>{escape(k)}</Key><Size>{os.path.getsize(os.path.join(top, k))}</Size></Contents>" for k in keys[first : first + PAGE])
        more = f"<NextContinuationToken>{first + PAGE}</NextContinuationToken>" if first + PAGE < len(keys) else ""
        self._answer(200, f"<ListBucketResult>{items}{more}</ListBucketResult>".encode())


def serve(folder: str, host: str = "127.0.0.1") -> dict[str, str]:
    """Serve ``folder`` until the process ends; the settings that reach it.

    Objects below a folder named ``short`` break off at half of their length.
    """
    server = ThreadingHTTPServer((host, 0), _Handler)
    server.folder = folder
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return {"endpoint": f"http://{host}:{server.server_port}", "region": REGION, "access_key": KEY, "secret_key": SECRET, "path_style": "true"}
