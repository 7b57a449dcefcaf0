"""A token classification model from a local folder: a table of a label for each word, as an ONNX file made by hand."""

import json
import struct

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from grainmill.operators import redact

WORDS = {"?": 0, "Ada": 1, "Lovelace": 2, "mail": 3, "a@b.c": 4, "now": 5}
LABELS = ["O", "B-private_person", "E-private_person", "S-private_email"]
#: Each word's label.
MEANS = [0, 1, 2, 0, 3, 0]


def number(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def part(field, value):
    """A field of a protocol buffer: whole numbers as such, everything else by its length."""
    if isinstance(value, int):
        return number(field << 3) + number(value)
    data = value.encode() if isinstance(value, str) else value
    return number(field << 3 | 2) + number(len(data)) + data


def value_info(name, kind, *dims):
    shape = b"".join(part(1, part(1, d) if isinstance(d, int) else part(2, d)) for d in dims)
    return part(1, name) + part(2, part(1, part(1, kind) + part(2, shape)))


def table_model():
    weights = [float(MEANS[w] == k) for w in range(len(WORDS)) for k in range(len(LABELS))]
    tensor = part(1, len(WORDS)) + part(1, len(LABELS)) + part(2, 1) + part(8, "weights") + part(9, struct.pack(f"<{len(weights)}f", *weights))
    node = part(1, "weights") + part(1, "input_ids") + part(2, "logits") + part(4, "Gather")
    inputs = b"".join(part(11, value_info(n, 7, "batch", "tokens")) for n in ("input_ids", "attention_mask"))
    graph = part(1, node) + part(2, "table") + part(5, tensor) + inputs + part(12, value_info("logits", 1, "batch", "tokens", len(LABELS)))
    return part(1, 8) + part(8, part(1, "") + part(2, 13)) + part(7, graph)


@pytest.fixture
def folder(tmp_path):
    tokenizer = Tokenizer(models.WordLevel(WORDS, unk_token="?"))
    tokenizer.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    tokenizer.save(f"{tmp_path}/tokenizer.json")
    (tmp_path / "config.json").write_text(json.dumps({"id2label": {str(k): x for k, x in enumerate(LABELS)}}))
    (tmp_path / "onnx").mkdir()
    (tmp_path / "onnx/model_q4.onnx").write_bytes(table_model())
    return tmp_path


def test_a_model_is_loaded_described_and_run(spark, folder):
    options = redact.RedactionOptions.from_environment({"MODEL_ID": str(folder), "ONNX_MAX_TOKENS": "5"})
    model = redact.OnnxTokenClassifier(options)
    assert model.info()["providers"] == [] and model.info()["model_bytes"] == 0
    model.load()
    size = (folder / "onnx/model_q4.onnx").stat().st_size
    assert model.info()["providers"] == ["CPUExecutionProvider"] and model.info()["model_bytes"] == size and model.info()["model_path"].endswith("model_q4.onnx")
    (folder / "onnx/model_q4.onnx_data").write_bytes(b"more")
    assert model.info()["model_bytes"] == size + 4
    assert model.classify("Ada Lovelace é") == [("B-private_person", 0, 3), ("E-private_person", 4, 12), ("O", 13, 14)] and model.classify("") == []

    texts = ["é Ada Lovelace now", "mail a@b.c now mail now a@b.c", "nothing", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = redact.redacted(redact.with_tokens(df, lambda: redact.OnnxTokenClassifier(options)), F.col("tokens"), max_tokens=options.max_tokens)
    rows = {r.id: r for r in redact.gate(got).collect()}
    assert [rows[i].redacted_text for i in range(4)] == ["é <PRIVATE_PERSON> now", "mail <PRIVATE_EMAIL> now mail now a@b.c", "nothing", ""]
    assert [rows[i].status for i in range(4)] == ["PASS", "FAIL", "PASS", "PASS"] and all(r.error is None and r.elapsed_ms >= 0 for r in rows.values())


def test_a_folder_that_holds_no_model_is_an_error_of_its_own(folder):
    (folder / "onnx/model_q4.onnx").write_bytes(b"no model")
    with pytest.raises(redact.RedactorError, match="Failed to load ONNX privacy model"):
        redact.OnnxTokenClassifier(redact.RedactionOptions(model_id=str(folder))).load()
