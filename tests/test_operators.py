"""The cases that pin the operators' semantics, and random records against a plain version."""

import hashlib
import json
import math
import random
import threading
import unicodedata
import urllib.error
import urllib.request
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from grainmill import schemas as S
from grainmill.functions import spans as sp
from grainmill.functions import text as tx
from grainmill.operators import combine as cb
from grainmill.operators import metrics, redact
from grainmill.plans import latency
from grainmill.sources import adapters, scans
from grainmill.streaming import service

SCHEMA = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.CANONICAL.fields)


def record(**kw):
    base = dict(source="example", source_id="1", source_split="train", task="prompt_injection", instruction="judge", query="is it?", document="text", answer="no", group_texts=None, provenance=None) | kw
    base["group_texts"] = base["group_texts"] or [base["document"]]
    return tuple(base[f.name] for f in S.CANONICAL.fields)


def combined(spark, records, **kw):
    return cb.Combined(spark.createDataFrame(records, SCHEMA), **kw)


def kept(spark, records, **kw):
    return combined(spark, records, **kw).examples.collect()


def test_normalisation_and_json_equal_python(spark):
    texts = ["ﬁ", "Straße", "STRASSE", "Ａｂ", "a b\u0085c\x1cd e　f", "ςσΣ", "", " \t x \n", "a\x01b", "é́ İ ½ ÿ ÀÖ×", 'q"\\\n\x1b\x7f😀 \b\f\r\t', None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", tx.normalized(F.col("t")).alias("n"), tx.json_string(F.col("t")).alias("j"), tx.normalized_all(F.array("t", F.lit("Ab"))).alias("a")).orderBy("i").collect()
    for t, r in zip(texts, got):
        want = None if t is None else " ".join(unicodedata.normalize("NFKC", t).casefold().split())
        assert r.n == want and r.a == [want, "ab"]
        assert r.j == (None if t is None else json.dumps(t, ensure_ascii=False))


def test_space_class_is_pythons(spark):
    import re

    assert {c for c in map(chr, range(0x10000)) if re.fullmatch(tx.SPACE.replace("\\u", "\\u"), c)} == {c for c in map(chr, range(0x10000)) if c.isspace()}


def test_example_key(spark):
    df = spark.createDataFrame([("refusal", "A  b", 'x "y"', "Docé")], "t string, i string, q string, d string")
    got = df.select(tx.example_key(F.col("t"), *[tx.normalized(F.col(c)) for c in "iqd"])).first()[0]
    assert got == hashlib.sha256(json.dumps(["refusal", "a b", 'x "y"', "docé"], ensure_ascii=False).encode()).hexdigest()


def test_test_split_is_protected_across_sources_and_spelling(spark):
    got = kept(spark, [record(document="Same   DOCUMENT"), record(source="other", source_split="test", document="same document")])
    assert [(r.source, r.split) for r in got] == [("other", "test")]


def test_groups_join_through_others_and_lower_splits_go(spark):
    rows = [record(source_id="a", document="a", group_texts=["x"]), record(source_id="b", document="b", group_texts=["x", "y"]), record(source_id="c", document="c", group_texts=["y"], source_split="validation"), record(source_id="d", document="d")]
    c = combined(spark, rows, fraction=0.0)
    assert sorted((r.source_id, r.split) for r in c.examples.collect()) == [("c", "validation"), ("d", "train")]
    assert dict(map(tuple, c.audit().collect())) == {"input_records": 4, "document_groups": 2, "conflicting_example_keys": 0, "dropped_split_overlap": 2}
    assert c.overlap_by_source().collect()[0].n == 2


def test_conflicts(spark):
    both = [record(source_id="1", answer="yes"), record(source_id="2", answer="no")]
    c = combined(spark, both)
    assert c.examples.count() == 0 and dict(map(tuple, c.audit().collect()))["dropped_conflicting_labels"] == 2
    assert [r.answer for r in kept(spark, [record(answer="yes"), record(source_id="2", answer="no", source_split="test")])] == ["no"]
    assert len(kept(spark, [record(), record(task="refusal", answer="yes")])) == 2


def test_origins_and_provenance(spark):
    rows = [record(source_id="z"), record(source_id="b", provenance='{"license": "x"}'), record(source_id="b", provenance='{"license": "x"}'), record(source_id="c", provenance="{}")]
    (r,) = kept(spark, rows)
    assert r.source_id == "b" and r.provenance == '{"license": "x"}' and [(o.source_id, o.provenance) for o in r.origins] == [("b", '{"license": "x"}'), ("c", None), ("z", None)]


def test_chat_shape(spark):
    c = combined(spark, [record(instruction="I", query="Q", document="D", source_split="test")])
    (r,) = c.messages().collect()
    assert [(m.role, m.content) for m in r.messages] == [("system", S.SYSTEM_PROMPT), ("user", "<Instruct>: I\n\n<Query>: Q\n\n<Document>: D"), ("assistant", "no")]
    assert r.metadata.split == "test" and list(r.metadata.asDict()) == sorted(r.metadata.asDict())


def test_invalid_records_raise(spark):
    for bad in (record(source="notinject"), record(query=" "), record(task="x"), record(answer="maybe"), record(group_texts=["a", " "])):
        with pytest.raises(ValueError):
            combined(spark, [record(), bad])
    with pytest.raises(ValueError):
        combined(spark, [record()], fraction=1.0)


def plain_combine(records, seed=42, fraction=0.05):
    """The rules, written plainly from their description."""
    dig = lambda t: hashlib.sha256(tx.normalize(t).encode()).hexdigest()
    named = [dict(zip([f.name for f in S.CANONICAL.fields], r)) for r in records]
    label = {}
    anchors = [sorted({dig(t) for t in [*r["group_texts"], r["document"]]}) for r in named]
    changed = True
    for a in anchors:
        for x in a:
            label.setdefault(x, x)
    while changed:
        changed = False
        for a in anchors:
            least = min(label[x] for x in a)
            for x in a:
                if label[x] != least:
                    label[x], changed = least, True
    key = lambda r: hashlib.sha256(json.dumps([r["task"], *[tx.normalize(r[k]) for k in ("instruction", "query", "document")]], ensure_ascii=False).encode()).hexdigest()
    out, groups = set(), defaultdict(list)
    for r, a in zip(named, anchors):
        groups[label[a[0]]].append(r)
    for g, rows in groups.items():
        top = max(rows, key=lambda r: S.SPLIT_RANK[r["source_split"]])["source_split"]
        target = top
        if top == "train" and int(hashlib.sha256(f"{seed}:{g}".encode()).hexdigest()[:16], 16) / 2**64 < fraction:
            target = "validation"
        by = defaultdict(list)
        for r in rows:
            if r["source_split"] == top:
                by[key(r)].append(r)
        for k, same in by.items():
            if len({r["answer"] for r in same}) == 1:
                first = min(same, key=lambda r: tuple(r[c] for c in cb.ORDER))
                out.add((k, g, target, first["source_id"], first["answer"], len({(r["source"], r["source_id"], r["source_split"]) for r in same})))
    return out


def test_random_records_equal_the_plain_rules_in_any_order(spark):
    rng = random.Random(5)
    words = [f"W{i} x" for i in range(40)]
    rows = [
        record(source=rng.choice("ab"), source_id=str(i), source_split=rng.choice(S.SPLITS), task=rng.choice(S.TASKS[:2]), document=rng.choice(words).upper() if i % 3 else rng.choice(words), answer=rng.choice(S.ANSWERS),
               group_texts=[rng.choice(words) + rng.choice(["", " more"])]) for i in range(60)
    ] + [record(source_id=f"s{i}", document=f"single {i}") for i in range(100)]
    want = plain_combine(rows)
    rng.shuffle(rows)
    c = combined(spark, rows)
    got = {(r.example_id, r.group_id, r.split, r.source_id, r.answer, len(r.origins)) for r in c.examples.collect()}
    assert got == want and {r[2] for r in got} == set(S.SPLITS) and cb.leaking_groups(c.examples).count() == 0
    order = sorted((r.split, r.pos) for r in c.shuffled().collect())
    assert [p for s, p in order if s == "train"] == list(range(sum(s == "train" for s, _ in order)))


def test_labelled_sources(spark):
    cols = "file string, row_index long, id string, prompt string, response string, prompt_label string, response_label string"
    rows = [("f", 0, "0", "p", "r", "safe", "unsafe"), ("f", 1, None, "[redacted]", "r", "safe", "safe"), ("f", 2, "", " ", "r", "safe", "safe"), ("f", 3, "k", "p3", None, "unsafe", "safe"), ("f", 4, "m", "p4", " <Redacted> ", None, "safe"), ("f", 5, "n", "p5", "x", "", "")]
    df = spark.createDataFrame(rows, cols)
    got = sorted((r.source_id, r.task, r.answer, r.document) for r in adapters.records("aegis", df, "train").collect())
    assert got == [("f:0", "prompt_moderation", "no", "p"), ("f:0", "response_moderation", "yes", '{"user": "p", "assistant": "r"}'), ("f:k", "prompt_moderation", "yes", "p3")]
    skips = {r.reason: r.n for r in adapters.skip_counts(adapters.expanded("aegis", df, "train")).collect()}
    assert skips == {"redacted_prompt_rows": 1, "empty_prompt_rows": 1, "empty_response:response_moderation": 1, "missing_label:prompt_moderation": 2, "redacted_response:response_moderation": 1, "missing_label:response_moderation": 1}
    with pytest.raises(ValueError, match="unexpected label"):
        adapters.records("aegis", spark.createDataFrame([("f", 0, "0", "p", "r", "odd", "safe")], cols), "train")
    with pytest.raises(ValueError, match="missing"):
        adapters.records("aegis", df.drop("response"), "train")
    wild = spark.createDataFrame([("f", 0, "p", "r", "harmful", "unharmful", "refusal")], "file string, row_index long, prompt string, response string, prompt_harm_label string, response_harm_label string, response_refusal_label string")
    assert sorted((r.task, r.answer) for r in adapters.records("wildguard", wild, "test").collect()) == [("prompt_moderation", "yes"), ("refusal", "yes"), ("response_moderation", "no")]
    clean = spark.createDataFrame([("f", 0, "p", ["w"], "c")], "file string, row_index long, prompt string, word_list array<string>, category string")
    assert adapters.records("notinject", clean, "test").first().answer == "no"
    with pytest.raises(ValueError):
        adapters.records("notinject", clean, "train")


def test_context_pairs(spark):
    schema = "subtask string, split string, ordinal int, context array<string>, question string, error string, code string, context_url string, context_author_url string"
    contexts = spark.createDataFrame([("email", "train", i, [f"mail {i}", "end"], "q?", None, None, None, None) for i in range(5)] + [("code", "test", 0, ["fix"], None, "err", "x=1", "u", "")], schema)
    attacks = spark.createDataFrame([("text", "train", 0, "a-0", "DO"), ("text", "train", 1, "b-0", "GO"), ("code", "test", 0, "c-0", "RUN")], "kind string, split string, ord int, attack_name string, payload string")
    got = {r.source_id: r for r in adapters.context_records(contexts, attacks).collect()}
    assert len(got) == 12 and sum(r.answer == "yes" for r in got.values()) == 6
    for i in range(5):
        text = f"mail {i}\nend"
        start = hashlib.sha256(text.encode()).digest()[0] % 2 == 0
        name, payload = (("a-0", "DO"), ("b-0", "GO"))[i % 2]
        r = got[f"email/train/{i + 1}/injected/{name}/{'start' if start else 'end'}"]
        assert r.document == (f"{payload}\n{text}" if start else f"{text}\n{payload}") and r.group_texts == [text] and got[f"email/train/{i + 1}/clean"].document == text
    code = got["code/test/1/clean"]
    assert "Error:\nerr\n\nUser code:\nx=1" in code.instruction and json.loads(code.provenance)["license"] == "CC-BY-SA-4.0"
    assert adapters.lacking_author(contexts).count() == 1
    with pytest.raises(ValueError, match="overlap"):
        adapters.context_records(contexts, attacks.unionByName(attacks.limit(1).withColumn("split", F.lit("test"))))


def plain_spans(text, tokens):
    done, open_ = [], None

    def flush():
        nonlocal open_
        if open_:
            done.append(open_)
        open_ = None

    for raw, a, b in tokens:
        if raw == "O" or b <= a:
            flush()
            continue
        kind, _, label = raw.partition("-")
        label = label if "-" in raw else raw
        if kind in "IE" and open_ and open_[0] == label:
            open_ = (label, open_[1], b)
            if kind == "E":
                flush()
        elif kind in ("S", "E"):
            flush()
            done.append((label, a, b))
        elif kind in ("B", "I"):
            flush()
            open_ = (label, a, b)
        else:
            flush()
    flush()
    out, cursor, cut = [], 0, []
    for label, a, b in done:
        while a < b and text[a].isspace():
            a += 1
        while b > a and text[b - 1].isspace():
            b -= 1
        cut.append((label, a, b))
    for label, a, b in sorted(cut, key=lambda s: (s[1], -(s[2] - s[1]))):
        if a >= cursor and b > a:
            out.append((label, a, b))
            cursor = b
    return out


def test_random_tokens_equal_the_plain_state_machine(spark):
    rng, cases = random.Random(3), []
    for i in range(300):
        text = "".join(rng.choice("ab é\n　😀") for _ in range(14))
        tokens = [(rng.choice(["O", "B-x", "I-x", "E-x", "S-x", "B-y-z", "I-y-z", "E-y-z", "S", "Q-x"]), a, a + rng.choice([0, 1, 2, 3])) for a in sorted(rng.choices(range(11), k=6))]
        cases.append((i, text, tokens))
    df = spark.createDataFrame(cases, "i int, body string, tokens array<struct<label:string,start:int,end:int>>")
    spans = sp.bioes_spans(F.col("body"), F.col("tokens"))
    got = df.select("i", "body", spans.alias("s"), sp.apply_redactions(F.col("body"), spans).alias("r")).collect()
    for (i, text, tokens), r in zip(cases, sorted(got)):
        want = plain_spans(text, tokens)
        assert [(s.label, s.start, s.end) for s in r.s] == want and all(s.text == text[s.start : s.end] for s in r.s)
        out, cursor = "", 0
        for label, a, b in want:
            out, cursor = out + text[cursor:a] + f"<{label.upper()}>", b
        assert r.r == out + text[cursor:]


class Shout:
    def load(self):
        pass

    def classify(self, text):
        if text == "boom":
            raise ValueError("boom")
        return [("S-secret", i, i + 1) for i, c in enumerate(text) if c.isupper()]


class Broken(Shout):
    def load(self):
        raise redact.RedactorError("Failed to load ONNX privacy model: no file")


def test_classifier_gate_and_report(spark):
    df = spark.createDataFrame([("p", "a B c"), ("q", "none"), ("r", "boom"), ("s", "ABCDE")], "path string, text string")
    got = redact.redacted(redact.with_tokens(df, Shout), F.col("tokens"), max_tokens=2)
    rows = {r.path: r for r in redact.gate(got).collect()}
    assert rows["p"].redacted_text == "a <SECRET> c" and rows["p"].status == "FAIL" and rows["q"].status == "PASS" and rows["r"].error == "ValueError: boom"
    assert rows["s"].redacted_text == "<SECRET><SECRET>CDE"  # what is behind the cap stays
    assert redact.gate_exit_code(redact.gate(got.where("path in ('p', 'q')"))) == 1 and redact.gate_exit_code(redact.gate(got)) == 2
    assert redact.gate_exit_code(redact.gate(got.where("error is null"), ())) == 0
    lines = {r.path: r.line for r in redact.gate_report(redact.gate(got)).collect()}
    assert lines["q"].startswith("PASS q backend=onnx elapsed_ms=") and lines["q"].endswith("labels=-") and lines["p"].endswith("labels=SECRET")
    with pytest.raises(Exception, match="Failed to load ONNX privacy model"):
        redact.with_tokens(df, Broken).collect()
    with pytest.raises(redact.RedactorError, match="Failed to load ONNX privacy model"):
        redact.OnnxTokenClassifier(redact.RedactionOptions(model_id="/none")).load()
    assert redact.RedactionOptions.from_environment({"ORT_PROVIDERS": "A,B", "ONNX_MAX_TOKENS": "7"}).providers == ("A", "B")


def test_records_alike_in_the_order_of_an_example_are_told_apart_by_their_texts(spark):
    """Rows of one example that share source, id, task and split; repeated rows; and the same without ties."""
    tie = [record(document="Same  text", query="is IT?"), record(document="same text"), record(document="SAME TEXT"), record(document="same text")]
    got = kept(spark, tie)
    assert [(r.document, r.query, r.n_records) for r in got] == [("SAME TEXT", "is it?", 4)]
    got = kept(spark, [record(source_id="2", document="SAME text"), record(source_id="1", document="same text"), record(source_id="3", document="x")])
    assert sorted((r.document, r.source_id, r.n_records, len(r.origins)) for r in got) == [("same text", "1", 2, 2), ("x", "3", 1, 1)]


def test_the_latency_benchmark(spark, tmp_path, capsys):
    (tmp_path / "s.jsonl").write_text("\n".join(json.dumps({"id": i, "text": t}) for i, t in enumerate(["a B", "none", "boom"])) + "\n\n")
    seen = []

    class Counted(Shout):
        def classify(self, text):
            seen.append(text)
            return super().classify(text)

    with pytest.raises(ValueError, match="boom"):  # a warm-up isn't allowed to fail
        latency.measure(spark, f"{tmp_path}/s.jsonl", Counted)
    assert seen == ["a B", "none", "boom"]
    args = ["--samples", f"{tmp_path}/s.jsonl", "--query-count", "7", "--warmup-samples", "2"]
    assert latency.main(args, spark, Shout) == 1
    got = json.loads(capsys.readouterr().out)
    assert (got["scenario"], got["samples"], got["queries"], got["failures"]) == ("SingleStream", 3, 7, 2)
    assert got["cold_model_load_ms"] >= 0 and got["latency_ms"]["p50"] <= got["latency_ms"]["p99"] and got["samples_per_second"] > 0
    (tmp_path / "t.jsonl").write_text('{"id": "x", "text": "fine"}')
    assert latency.main(["--samples", f"{tmp_path}/t.jsonl", "--scenario", "Offline", "--query-count", "9"], spark, Shout) == 0
    assert json.loads(capsys.readouterr().out)["queries"] == 9
    (tmp_path / "none.jsonl").write_text("\n")
    with pytest.raises(ValueError, match="no samples"):
        latency.measure(spark, f"{tmp_path}/none.jsonl", Shout)


def test_the_redaction_service(spark):
    class Failing(Shout):
        def classify(self, text):
            if text == "down":
                raise redact.RedactorError("no model")
            return super().classify(text)

    own = service.Service(spark, Failing, redact.RedactionOptions(model_id="m", max_tokens=2))
    assert own.health()[1]["ready"] is False
    own.load()
    http = service.server(own)
    threading.Thread(target=http.serve_forever, daemon=True).start()

    def ask(path, body=None):
        request = urllib.request.Request(f"http://127.0.0.1:{http.server_port}{path}", None if body is None else body.encode())
        try:
            with urllib.request.urlopen(request, timeout=30) as got:
                return got.status, json.load(got)
        except urllib.error.HTTPError as e:
            return e.code, json.load(e)

    try:
        assert ask("/healthz") == (200, {"ok": True, "ready": True, "backend": "onnx", "decode_mode": "bioes_argmax", "model_id": "m", "onnx_model_file": "onnx/model_q4.onnx", "providers": [], "model_bytes": 0})
        status, got = ask("/redact", json.dumps({"text": "é B cDE"}))
        assert status == 200 and got.pop("elapsed_ms") > 0
        assert got == {"redacted_text": "é <SECRET> c<SECRET>E", "labels": ["SECRET"], "backend": "onnx", "model_id": "m", "onnx_model_file": "onnx/model_q4.onnx", "decode_mode": "bioes_argmax", "input_chars": 7, "output_chars": 21}
        assert ask("/redact", json.dumps({"text": "down"})) == (503, {"detail": "no model"})
        for bad in ("", "[]", "{", '{"text": 1}', '{"text": ""}', json.dumps({"text": "x" * 2_000_001})):
            assert ask("/redact", bad)[0] == 422, bad[:9]
        assert ask("/none")[0] == ask("/none", "{}")[0] == 404
    finally:
        http.shutdown()
        http.server_close()


#: Texts, tokens, and the spans expected of them.
TOKEN_CASES = [
    (1, "Ada Lovelace mail a@b.c", [("B-private_person", 0, 3), ("E-private_person", 3, 12), ("O", 13, 17), ("S-private_email", 17, 23)], [("private_person", 0, 12, "Ada Lovelace"), ("private_email", 18, 23, "a@b.c")]),
    (2, "one two three", [("I-x", 0, 3), ("I-x", 3, 7), ("E-y", 8, 13)], [("x", 0, 7, "one two"), ("y", 8, 13, "three")]),
    (3, "a b c d", [("B-x", 0, 1), ("B-y", 2, 3), ("I-x", 4, 5), ("O", 5, 5), ("Q-x", 6, 7)], [("x", 0, 1, "a"), ("y", 2, 3, "b"), ("x", 4, 5, "c")]),
    (4, "k-1 s", [("S-a-b", 0, 3), ("S", 4, 5)], [("a-b", 0, 3, "k-1"), ("S", 4, 5, "s")]),
    (5, "   ", [("S-x", 0, 3)], []),
    (6, "open end", [("B-x", 0, 4), ("I-x", 5, 8)], [("x", 0, 8, "open end")]),
    (7, "none", [], []),
    (8, "é😀z", [("S-x", 1, 2), ("S-x", 1, 3)], [("x", 1, 3, "😀z")]),
]


def test_spans_of_labelled_tokens(spark):
    rows = spark.createDataFrame([(i, t, k) for i, t, k, _ in TOKEN_CASES], "i int, body string, tokens array<struct<label:string,start:int,end:int>>")
    got = {r.i: [tuple(s) for s in r.s] for r in rows.select("i", sp.bioes_spans(F.col("body"), F.col("tokens")).alias("s")).collect()}
    assert got == {i: [(a, b, c, t, f"<{a.upper()}>") for a, b, c, t in want] for i, _, _, want in TOKEN_CASES}
    cases = [(" ab\t", 0, 4, (1, 3, "ab")), ("ab\u3000", 0, 3, (0, 2, "ab")), (" \n\x1c", 0, 3, (3, 3, ""))]
    rows = spark.createDataFrame([(t, ("x", a, b)) for t, a, b, _ in cases], "t string, s struct<label:string,start:int,end:int>")
    assert [tuple(r) for r in rows.select(sp.trimmed(F.col("t"), F.col("s")).alias("c")).select("c.start", "c.end", "c.text").collect()] == [w for *_, w in cases]


def test_redactions_of_many_spans(spark):
    """Neighbours, a span at either end, overlaps, and characters beyond the basic plane."""
    text = "😀" + "ab" * 3000 + "é"
    spans = [("x", 0, 1, "", "<X>")] + [("y", 1 + 2 * i, 2 + 2 * i, "", "<Y>") for i in range(3000)] + [("z", 3, 5, "", "<Z>"), ("w", 6000, 6002, "", "<W>")]
    row = spark.createDataFrame([(text, spans), ("none", [])], f"t string, s array<{S.SPAN.simpleString()}>").select(sp.apply_redactions(F.col("t"), F.col("s"))).collect()
    want, at = "", 0
    for _, a, b, _, mark in sorted(spans, key=lambda s: (s[1], s[1] - s[2])):
        if a >= at:
            want, at = want + text[at:a] + mark, b
    assert [r[0] for r in row] == [want + text[at:], "none"]


def test_latency_percentiles(spark):
    rng = random.Random(1)
    groups = {n: [rng.choice([rng.random() * 100, 5.0]) for _ in range(n)] for n in (1, 2, 3, 20, 101)}
    rows = [(n, v) for n, vs in groups.items() for v in vs] + [(1, None), (None, 2.0)]
    got = {r.g: r for r in metrics.latency_summary(spark.createDataFrame(rows, "g int, v double"), "v", "g").collect()}
    for n, vs in groups.items():
        vs = sorted(vs)
        for k, f in metrics.PERCENTILES.items():
            assert got[n][k] == vs[round((n - 1) * f)]
        assert math.isclose(got[n]["mean"], sum(vs) / n)
    assert got[None].p50 == 2.0
    none = metrics.run_summary(spark.createDataFrame([], "elapsed_ms double, error string"), 0).first()
    assert none.completed == 0 and none.p99_ms == 0.0 and none.samples_per_second == 0.0
    some = metrics.run_summary(spark.createDataFrame([(1.0, None), (3.0, "e")], "elapsed_ms double, error string"), 4).first()
    assert (some.completed, some.failures, some.samples_per_second, some.p50_ms) == (2, 1, 0.5, 1.0)


def test_scans_fail_on_what_they_do_not_read(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "x"}')
    schema = "id string"
    from pyspark.sql import types as T

    with pytest.raises(Exception, match="not a JSON list"):
        scans.json_array(spark, f"{tmp_path}/a.json", T.StructType([T.StructField("id", T.StringType())])).collect()
    with pytest.raises(ValueError, match="unsupported"):
        scans.scan(spark, f"{tmp_path}/a.csv", schema)
    (tmp_path / "s.jsonl").write_text("\n\n")
    with pytest.raises(ValueError, match="no samples"):
        scans.samples(spark, f"{tmp_path}/s.jsonl")
    (tmp_path / "m.json").write_text('{"b": ["x", "y"], "a": ["z"]}')
    assert [(r.ord, r.attack_name, r.payload) for r in scans.attacks(spark, f"{tmp_path}/m.json").orderBy("ord").collect()] == [(0, "a-0", "z"), (1, "b-0", "x"), (2, "b-1", "y")]
    files = spark.createDataFrame([("data/NotInject_one-0.parquet",)], "filename string")
    with pytest.raises(ValueError, match="missing"):
        scans.require_files(files, "notinject")


def test_record_fingerprints_equal_the_columns_definitions_in_one_pass(spark):
    texts = ["Straße  é\n", "STRASSE É", 'q"\\\n\x1b\x7f😀', "", "ﬁ ａ b", "plain"]
    data = [record(source_id=str(i), document=t, query=f"Is  it {t}?", group_texts=g) for i, t in enumerate(texts) for g in ([t], [t, "First\tLine"], ["x", "X", "y"], None)]
    df = spark.createDataFrame(data, SCHEMA)
    got = cb.fingerprinted(df)
    norm = {c: tx.normalized(F.col(c)) for c in ("instruction", "query", "document")}
    anchors = F.array_sort(F.array_distinct(F.concat(F.transform(tx.normalized_all(F.col("group_texts")), tx.digest), F.array(tx.digest(norm["document"])))))
    want = df.select("source_id", "group_texts", tx.digest(norm["document"]).alias("document_sha256"), tx.example_key(F.col("task"), *norm.values()).alias("example_id"), anchors.alias("anchors"))
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "regexp_replace" not in plan and plan.count("record_fingerprints") >= 1


def test_counts_and_orders_write_no_texts(spark, monkeypatch):
    written = []
    settle = cb.settle
    monkeypatch.setattr(cb, "settle", lambda df, name, *a: written.append((name, df.columns)) or settle(df, name, *a))
    c = cb.Combined(spark.createDataFrame([record(source_id=str(i), document=f"text {i % 7}", source_split=S.SPLITS[i % 3]) for i in range(20)], SCHEMA))
    for result in (c.audit(), c.overlap_by_source(), c.split_counts(), c.shuffled(), cb.group_leaks(c.chosen), c.conflicts):
        assert result.count() >= 0
    assert {r.source_id: r.document for r in c.examples.collect()}
    assert c.messages().count() == c.chosen.count() == 7
    assert written and not [n for n, columns in written if "document" in columns]  # texts are joined, not written
