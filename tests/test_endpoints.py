import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from docloom.__main__ import main
from docloom.config import Config
from docloom.sources.files import CHUNK_SCHEMA, TABLE_SCHEMA, fetch_pages, read_json, write_json
from docloom.sources.providers import ChatEndpoint, EmbeddingEndpoint, OfflineGenerator, OfflineVerifier, providers_of

PAGE = "<p>PART I</p><p>Item 1. Business</p>" + "".join(f"<p><b>Unit {c}</b></p><p>Unit {c} sold {i}0,000 pumps in 20{i:02}. Its costs were ${i}.5 million, after ${i}.1 million before. It is based in Dale and employs many people who build pumps and sell them.</p>" for i, c in enumerate("ABCDEFGH", 11))


@pytest.fixture
def server(monkeypatch):
    asked = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            out = PAGE.encode()
            self.send_response(200 if self.path.startswith("/page") else 404)
            self.send_header("Content-Length", str(len(out)))
            self.end_headers()
            self.wfile.write(out)

        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            asked.append((self.path, self.headers["Authorization"], body))
            if self.path.endswith("/embeddings"):
                reply = {"data": [{"index": i, "embedding": [3.0 * (i + 1), 4.0 * (i + 1)]} for i in reversed(range(len(body["input"])))]}
            else:
                asked_for = body["messages"][1]["content"]
                said = None if asked_for == "silent" else "said"
                if "passage:\n" in asked_for:
                    stand_in = OfflineVerifier() if body["model"] == "judge" else OfflineGenerator()
                    said = f"```json\n{stand_in.complete('', asked_for)}\n```"
                reply = {"choices": [{"message": {"content": said}}]}
            out = json.dumps(reply).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(out)))
            self.end_headers()
            self.wfile.write(out)

        def log_message(self, *_):
            return None

    monkeypatch.setenv("DOCLOOM_TEST_KEY", "k")
    http = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=http.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{http.server_port}/v1/", asked
    http.shutdown()


def test_chat(server, monkeypatch):
    url, asked = server
    chat = ChatEndpoint(url, "m", "DOCLOOM_TEST_KEY", temperature=0.0, max_tokens=7)
    assert chat.complete("be", "ask") == "said" and chat.complete("be", "silent") == ""
    path, key, body = asked[0]
    assert path == "/v1/chat/completions" and key == "Bearer k" and body["max_tokens"] == 7 and [m["role"] for m in body["messages"]] == ["system", "user"]
    monkeypatch.delenv("DOCLOOM_TEST_KEY")
    with pytest.raises(OSError):
        chat.complete("be", "ask")


def test_embeddings(server):
    url, asked = server
    embedder = EmbeddingEndpoint(url, "m", "DOCLOOM_TEST_KEY", dimension=2)
    assert embedder.embed(["a", "b"]) == [[0.6, 0.8], [0.6, 0.8]] and embedder.embed([]) == [] and len(asked) == 1


def test_a_run_with_endpoints(spark, server, tmp_path, monkeypatch):
    """Addresses fetched by executors, models and embeddings over HTTP, own prompts, settings from a file."""
    url, asked = server
    (tmp_path / "prompts").mkdir()
    (tmp_path / "prompts" / "comparison.txt").write_text("SYSTEM:\nCompare.\nUSER:\nquestion_type: comparison\ncount: {n}\nsection: {heading_path}\npassage:\n{chunk_text}")
    settings = {"models": {"chat_url": url, "chat_model": "writer", "verify_model": "judge", "embed_url": url, "embed_model": "e", "embed_dimension": 2, "key_variable": "DOCLOOM_TEST_KEY"}, "http_backoff_s": 0.0, "min_rows": 1}
    (tmp_path / "settings.json").write_text(json.dumps(settings))
    host = url.removesuffix("/v1/")
    spark.createDataFrame([(1, f"{host}/page1"), (2, f"{host}/gone"), (3, None)], "doc_id long, url string").write.parquet(str(tmp_path / "urls"))
    main([str(tmp_path / "urls"), str(tmp_path / "out"), "--url-table", "--agent", "me", "--config", str(tmp_path / "settings.json"), "--prompts", str(tmp_path / "prompts"), "--stages", str(tmp_path / "stages"), "--format", "jsonl"])
    rows = spark.read.json(str(tmp_path / "out"))
    assert rows.count() > 0 and {r["source_item"] for r in rows.select("source_item").distinct().collect()} == {"Item 1. Business"}
    chat = [b for p, _, b in asked if p.endswith("/chat/completions")]
    assert {b["model"] for b in chat} == {"writer", "judge"} and {b["temperature"] for b in chat if b["model"] == "judge"} == {0.0}
    assert any(b["messages"][0]["content"] == "Compare." for b in chat) and any(p.endswith("/embeddings") for p, _, _ in asked)
    fetched = {r["doc_id"]: (r["html"] is None, r["error"] is None) for r in fetch_pages(spark.read.parquet(str(tmp_path / "urls")), "me", Config(http_retries=1, http_backoff_s=0.0)).collect()}
    assert fetched == {1: (False, True), 2: (True, False), 3: (True, False)}
    monkeypatch.delenv("DOCLOOM_TEST_KEY")
    with pytest.raises(OSError):
        providers_of(Config.load(str(tmp_path / "settings.json")))


def test_strict_json(spark, tmp_path):
    rows = spark.createDataFrame([(1, "table_0000", "A", None, None, 0, 1, 2, ["a", "b"], [["1", ""]], "<table></table>")], TABLE_SCHEMA)
    write_json(rows, str(tmp_path / "t"))
    assert read_json(spark, str(tmp_path / "t"), TABLE_SCHEMA).collect() == rows.collect()
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.json").write_text('{"doc_id": "not a number"}\n')
    with pytest.raises(Exception):
        read_json(spark, str(tmp_path / "bad"), CHUNK_SCHEMA).collect()
