import hashlib
import io
import json
import urllib.error
from email.message import Message

import pytest

from grainmill.operators.combine import Combined
from grainmill.plans import build
from grainmill.sources import adapters, fetching, upstream
from grainmill.sources.fetching import Unavailable
from grainmill.streaming.redaction import redact_stream, without_repeats
from grainmill.operators.redact import fixture_tokens
from tests.test_operators import SCHEMA, record


def source(spark, name, rows, notice_paths=(), **kw):
    facts = {"files": [{"path": "rows.json", "sha256": "h"}], "notice_paths": list(notice_paths)}
    return build.Source(name, lambda s: (s.createDataFrame(rows, SCHEMA), facts | {}), "r" * 40, **kw)


def rows_of(n=30):
    return [record(source_id=str(i), document=f"document {i}", source_split="test" if i % 5 == 0 else "train") for i in range(n)]


def test_build_publishes_three_files_and_a_manifest(spark, tmp_path):
    out = tmp_path / "out"
    notice = tmp_path / "License.md"
    notice.write_text("free")
    assert build.build(spark, [source(spark, "s", rows_of(), [notice, tmp_path / "x.py"], files={"rows.json": "h"})], out) == 0
    manifest = json.loads((out / "manifest.json").read_text())
    assert manifest["complete"] and manifest["schema_version"] == 1 and sorted(manifest["files"]) == ["test.jsonl", "train.jsonl", "validation.jsonl"]
    for name, facts in manifest["files"].items():
        raw = (out / name).read_bytes()
        assert facts == {"rows": raw.count(b"\n"), "bytes": len(raw), "sha256": hashlib.sha256(raw).hexdigest()}
        for line in raw.splitlines():
            row = json.loads(line)
            assert list(row) == sorted(row) and row["metadata"]["split"] == name.split(".")[0] and len(row["messages"]) == 3
    assert sum(f["rows"] for f in manifest["files"].values()) == 30 == manifest["deduplication"]["input_records"]
    assert manifest["counts"]["test"]["records"] == 6 and (out / "upstream-notices/s/License.md").exists()
    with pytest.raises(FileExistsError):
        build.build(spark, [source(spark, "s", rows_of())], out)
    first = (out / "train.jsonl").read_bytes()
    assert build.build(spark, [source(spark, "s", rows_of()[::-1])], out, overwrite=True) == 0 and (out / "train.jsonl").read_bytes() == first


def test_failures_leave_the_output_alone(spark, tmp_path):
    out = tmp_path / "out"
    out.mkdir()
    (out / "old").write_text("kept")
    bad = source(spark, "s", rows_of(), files={"rows.json": "other"})
    assert build.build(spark, [bad], out, overwrite=True) == 2 and [p.name for p in out.iterdir()] == ["old"]
    status = json.loads((tmp_path / "out-source-status.json").read_text())
    assert status["sources"][0]["error_type"] == "ValueError" and "rows.json" in status["sources"][0]["reason"]

    def gone(s):
        raise Unavailable("secret tok", "http_401")

    both = [source(spark, "s", rows_of()), build.Source("t", gone)]
    assert build.build(spark, both, tmp_path / "p") == 2
    assert build.build(spark, both, tmp_path / "p", allow_partial=True) == 0
    assert json.loads((tmp_path / "p/manifest.json").read_text())["unavailable_sources"] == ["t"]
    assert build.build(spark, [source(spark, "s", [record(source_split="test")])], tmp_path / "q") == 2 and not (tmp_path / "q").exists()
    assert not [p for p in tmp_path.iterdir() if "staged" in p.name]


def test_a_split_of_several_parts_and_what_an_overwrite_leaves(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(build, "export", lambda combined, folder: build.json_rows(combined.messages()).repartition(3).select("split", "line").write.partitionBy("split").text(folder))
    out = tmp_path / "out"
    assert build.build(spark, [source(spark, "s", rows_of())], f"file://{out}") == 0
    manifest = json.loads((out / "manifest.json").read_text())["files"]
    parts = sorted(n for n in manifest if n.startswith("train-"))
    assert parts == [f"train-{i:05d}-of-{len(parts):05d}.jsonl" for i in range(len(parts))] and len(parts) > 1
    assert all(hashlib.sha256((out / n).read_bytes()).hexdigest() == f["sha256"] for n, f in manifest.items())
    monkeypatch.undo()
    assert build.build(spark, [source(spark, "s", rows_of())], out, overwrite=True) == 0
    assert sorted(p.name for p in out.glob("*.jsonl")) == ["test.jsonl", "train.jsonl", "validation.jsonl"]


class Reply(io.BytesIO):
    def __init__(self, status=200, body=b"", location=None):
        super().__init__(body)
        self.status, self.headers = status, Message()
        if location:
            self.headers["Location"] = location


class Net:
    """Answers by URL; keeps what was asked for, and with which token."""

    def __init__(self, replies):
        self.replies, self.asked = replies, []

    def __call__(self, request):
        self.asked.append((request.full_url, request.headers.get("Authorization")))
        got = self.replies.get(request.full_url, Reply(404))
        if isinstance(got, Exception):
            raise got
        return Reply(body=got) if isinstance(got, bytes) else got


HF = "https://huggingface.co"


def test_answers_follow_redirects_to_known_hosts_and_tell_the_token_to_the_first_alone():
    net = Net({f"{HF}/a": Reply(302, location="/b"), f"{HF}/b": Reply(307, location="https://cdn.hf.co/c"), "https://cdn.hf.co/c": b"data"})
    assert fetching.answer(f"{HF}/a", "tok", net).read() == b"data"
    assert net.asked == [(f"{HF}/a", "Bearer tok"), (f"{HF}/b", "Bearer tok"), ("https://cdn.hf.co/c", None)]
    bad = {"/x": Reply(301, location="https://evil.example/huggingface.co"), "/y": Reply(302, location="http://huggingface.co/z"), "/l": Reply(302, location="/l"), "/t": TimeoutError(), "/u": urllib.error.URLError("x"), "/401": Reply(401)}
    for path, reason in (("/x", "host_not_allowed"), ("/y", "host_not_allowed"), ("/l", "too_many_redirects"), ("/t", "TimeoutError"), ("/u", "URLError"), ("/401", "http_401"), ("/no", "http_404")):
        with pytest.raises(Unavailable) as e:
            fetching.answer(HF + path, "tok", Net({HF + k: v for k, v in bad.items()}))
        assert e.value.facts["reason"] == reason and "tok" not in str(e.value).split()
    assert fetching.allowed("x.hf.co") and not fetching.allowed("xhf.co") and not fetching.allowed(None)


def test_files_are_stored_whole_and_verified(tmp_path):
    sha = hashlib.sha256(b"data").hexdigest()
    net = Net({f"{HF}/f": b"data"})
    assert fetching.stored(f"{HF}/f", tmp_path, "a/x", sha, None, net) == (tmp_path / "a/x", sha)
    assert fetching.stored(f"{HF}/gone", tmp_path, "a/x", sha, None, net)[1] == sha and len(net.asked) == 1  # from the folder
    with pytest.raises(ValueError, match="checksum"):
        fetching.stored(f"{HF}/f", tmp_path, "a/x", "0", None, net)
    with pytest.raises(ValueError, match="checksum"):
        fetching.stored(f"{HF}/f", tmp_path, "a/y", "0", None, net)
    with pytest.raises(Unavailable):
        fetching.stored(f"{HF}/none", tmp_path, "b", None, None, net)
    assert [p.name for p in tmp_path.rglob("*") if p.is_file()] == ["x"]
    for name in ("/etc/x", "../x", "a/../../x"):
        with pytest.raises(ValueError):
            fetching.inside(name)
    assert build.masked("bad tok here", "tok") == "bad [REDACTED] here"
    for revision in ("main", "", None):
        with pytest.raises(ValueError):
            upstream.check_revision(revision)
    with pytest.raises(ValueError, match="locked"):
        upstream.check_revision("a" * 40, "b" * 40)
    assert upstream.check_revision("a" * 40, "a" * 40)


REV = {"aegis": "a" * 40, "wildguard": "b" * 40, "deepset": "c" * 40, "notinject": "d" * 40}


def parquet(tmp_path, rows):
    import pandas as pd

    pd.DataFrame(rows).to_parquet(tmp_path / "x.parquet")
    return (tmp_path / "x.parquet").read_bytes()


def published(tmp_path):
    """The files of all sources but the gated one, and where they are."""
    files, ids = {}, upstream.S.DATASET_IDS
    row = lambda i, **kw: {"id": f"i{i}", "prompt": f"prompt {i}", "response": f"response {i}", "prompt_label": "safe", "response_label": "unsafe"} | kw
    pages = {
        "aegis": {n: json.dumps([row(f"{n}{i}") for i in range(6)] + [row(9, prompt="REDACTED"), row(8, prompt_label=None)]).encode() for n in ("train.json", "refusals_train.json", "validation.json", "refusals_validation.json", "test.json")},
        "deepset": {f"data/{s}-0.parquet": parquet(tmp_path, [{"text": f"{s} text {i}", "label": i % 2} for i in range(4)]) for s in ("train", "test")},
        "notinject": {f"data/NotInject_{k}-0.parquet": parquet(tmp_path, [{"prompt": f"{k} benign {i}", "word_list": ["w"], "category": "c"} for i in range(3)]) for k in ("one", "two", "three")},
        "wildguard": {},
    }
    for name, own in pages.items():
        own = own | {"README.md": b"about", "other.bin": b"?"}
        card = {"license": "apache-2.0", "dataset_info": {"license": "cc-by-4.0"}}
        described = {"sha": REV[name], "cardData": card, "gated": name == "wildguard" and "auto", "siblings": [{"rfilename": n} for n in own]}
        files[f"{HF}/api/datasets/{ids[name]}/revision/{REV[name]}"] = json.dumps(described).encode()
        files |= {f"{HF}/datasets/{ids[name]}/resolve/{REV[name]}/{n}": body for n, body in own.items()}
    context = {"LICENSE": b"free", "NOTICE.md": b"note", "benchmark/README.md": b"about"}
    for split in ("train", "test"):
        line = lambda **kw: json.dumps({"context": f"{split} context, {len(kw)} {kw.get('question', kw.get('error'))}"} | kw)
        context[f"benchmark/email/{split}.jsonl"] = (json.dumps({"context": [f"{split} line one", "line two"], "question": "what?"}) + "\n\n" + line(question="[who]")).encode()
        context[f"benchmark/table/{split}.jsonl"] = json.dumps({"context": f"[{split}, table]", "question": ["how", "many?"]}).encode()
        context[f"benchmark/code/{split}.jsonl"] = line(error="e", code="c", context_url="u", context_author_url=None).encode()
        context |= {f"benchmark/{k}_attack_{split}.json": json.dumps({"B": [f"{k} {split} b0"], "A": [f"{k} {split} a0", f"{k} {split} a1"]}).encode() for k in ("text", "code")}
    files |= {f"https://raw.githubusercontent.com/microsoft/BIPIA/{adapters.CONTEXT_REVISION}/{n}": body for n, body in context.items()}
    return files, {n: hashlib.sha256(body).hexdigest() for n, body in context.items()}


def test_the_build_from_published_files_to_the_dataset(spark, tmp_path, monkeypatch):
    files, pinned = published(tmp_path)
    assert set(pinned) == set(upstream.PINNED)
    monkeypatch.setattr(upstream, "PINNED", pinned)
    monkeypatch.delenv("HF_TOKEN", raising=False)
    names = ["aegis", "deepset", "bipia", "notinject"]
    revisions = REV | {"bipia": adapters.CONTEXT_REVISION}
    lock = {"default_sources": names, "sources": [{"source": n, "revision": r} for n, r in revisions.items()]}
    (tmp_path / "lock.json").write_text(json.dumps(lock))
    args = ["--source-lock", str(tmp_path / "lock.json"), "--cache-dir", str(tmp_path / "cache"), "--output", str(tmp_path / "out")]
    net = Net(files)
    assert build.main(args, spark, net) == 0
    manifest = json.loads((tmp_path / "out/manifest.json").read_text())
    rows = [json.loads(x) for n in manifest["files"] for x in (tmp_path / "out" / n).read_text().splitlines()]
    by = lambda n: [r["metadata"] for r in rows if r["metadata"]["source"] == n]
    # 6 rows with two tasks and one with the response alone in each of five files; one prompt is the same in all five
    assert len(by("aegis")) == 5 * 6 * 2 + 1 and len(by("deepset")) == 8 and len(by("notinject")) == 9 and len(by("bipia")) == 2 * 2 * 4
    assert {m["split"] for m in by("notinject")} == {"test"} and manifest["deduplication"]["dropped_split_overlap"] == 4
    aegis = next(s for s in manifest["sources"] if s["source"] == "aegis")
    assert aegis["skipped"] == {"missing_label:prompt_moderation": 5, "redacted_prompt_rows": 5} and [f["rows"] for f in aegis["files"]] == [8] * 5
    told = json.loads(by("deepset")[0]["provenance"])
    assert told["license"] == "apache-2.0" and "cc-by-4.0" in told["license_notes"] and told["revision"] == REV["deepset"] and told["source_url"].endswith(told["file"])
    assert (tmp_path / "out/upstream-notices/bipia/LICENSE").read_bytes() == b"free" and (tmp_path / "out/upstream-notices/aegis/README.md").exists()
    context = next(s for s in manifest["sources"] if s["source"] == "bipia")
    assert context["original_context_counts"] == {f"{k}/{s}": n for k, n in (("code", 1), ("email", 2), ("table", 1)) for s in ("test", "train")}
    assert context["upstream_missing_author_urls"] == ["code/test/1/clean", "code/train/1/clean"]
    texts = {r["metadata"]["source_id"]: r["messages"][1]["content"] for r in rows if r["metadata"]["source"] == "bipia"}
    assert "test line one\nline two" in texts["email/test/1/clean"] and "[train, table]" in texts["table/train/1/clean"] and "Question: how\nmany?" in texts["table/train/1/clean"]
    assert any(k.startswith("email/train/2/injected/A-1/") for k in texts)

    # from the folder alone the second time, but for what describes the datasets
    asked = len(net.asked)
    lock["sources"][0]["files"] = [{"path": f["path"], "sha256": f["sha256"]} for f in aegis["files"]]
    (tmp_path / "lock.json").write_text(json.dumps(lock))
    assert build.main([*args, "--overwrite"], spark, net) == 0 and len(net.asked) == asked + 3
    cached = next((tmp_path / "cache").glob("*Aegis*/*/test.json"))
    cached.write_bytes(cached.read_bytes() + b"\n")
    assert build.main([*args, "--overwrite"], spark, net) == 2
    assert "test.json" in json.loads((tmp_path / "out-source-status.json").read_text())["sources"][0]["reason"]
    # a gated source without a token, and a context file that isn't as pinned
    (tmp_path / "cache/bipia" / adapters.CONTEXT_REVISION / "benchmark/code/test.jsonl").write_text("{}")
    more = [*args[:-1], str(tmp_path / "other"), "--sources", "wildguard", "bipia", "deepset", "--allow-partial"]
    assert build.main(more, spark, net) == 0
    left = {s["source"]: s for s in json.loads((tmp_path / "other/manifest.json").read_text())["sources"]}
    assert left["wildguard"]["reason"].startswith("gated") and "checksum" in left["bipia"]["reason"] and left["deepset"]["status"] == "included"


def test_metadata_of_another_revision_is_refused(spark, tmp_path):
    at = f"{HF}/api/datasets/{upstream.S.DATASET_IDS['deepset']}"
    with pytest.raises(ValueError, match="locked"):
        upstream.labelled(spark, "deepset", tmp_path, "e" * 40, None, Net({f"{at}/revision/{'e' * 40}": json.dumps({"sha": "f" * 40}).encode()}))
    with pytest.raises(ValueError, match="40 hexadecimal"):
        upstream.labelled(spark, "deepset", tmp_path, None, None, Net({at: b"{}"}))
    with pytest.raises(ValueError, match="checksums"):
        upstream.contexts(spark, tmp_path, "f" * 40)
    with pytest.raises(ValueError, match="unknown"):
        upstream.labelled(spark, "more", tmp_path)


def test_streams(spark, tmp_path):
    data = spark.createDataFrame([(1, "mail a@b.cd now", "2024-01-01 00:00:00"), (2, "none", "2024-01-01 00:00:01"), (3, "NONE ", "2024-01-01 00:00:02")], "id int, text string, ts string").selectExpr("id", "text", "timestamp(ts) ts")
    data.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(data.schema).parquet(f"{tmp_path}/in")
    q = redact_stream(stream, fixture_tokens).writeStream.format("memory").queryName("redacted").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r.id: r for r in spark.table("redacted").collect()}
    assert got[1].redacted_text == "mail <PRIVATE_EMAIL> now" and got[1].status == "FAIL" and got[2].status == "PASS"
    q = without_repeats(stream, "ts", "1 hour").writeStream.format("memory").queryName("fresh").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("fresh").count() == 2


def test_the_export_needs_no_positions_for_its_order(spark, tmp_path, monkeypatch):
    c = Combined(spark.createDataFrame(rows_of(), SCHEMA))
    want = {s: [r.example_id for r in c.shuffled().where(f"split = '{s}'").orderBy("pos").collect()] for s in ("train", "test")}
    monkeypatch.setattr(Combined, "shuffled", None)  # whole texts would be shuffled once more to meet them
    build.export(c, str(tmp_path / "out"))
    for split, ids in want.items():
        lines = [line for part in sorted((tmp_path / f"out/split={split}").glob("part-*")) for line in part.read_text().splitlines()]
        assert [json.loads(line)["metadata"]["example_id"] for line in lines] == ids
