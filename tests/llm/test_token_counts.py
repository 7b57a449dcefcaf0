import public_tokenizers
from tokenizers import Tokenizer

from grainmill.llm.token_counts import MergeCounter, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " ", "\n\n x", "a  b\t\tc", "it's <|endoftext|>we'LL", "naïve 😀 ﬁ  x y", "x" * 5000, "\x1c\x85z", "12345 ½ ²", "<|endoftext|>"]


def test_counts_equal_the_library_on_odd_texts_and_documents(spark, small):
    library = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    texts = ODD + [r.text for r in docs]
    frame = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    got = {r.doc_id: r for r in count_tokens(frame, PATH, 512).collect()}
    want = [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [got[i].n_tokens for i in range(len(texts))] == want
    assert all(got[i].n_bytes == len((t or "").encode()) and got[i].over_limit == (n > 512) for i, (t, n) in enumerate(zip(texts, want)))


def test_repeated_rows_and_an_empty_table(spark):
    rows = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    assert count_tokens(rows, PATH, 1).count() == 3
    assert count_tokens(rows.limit(0), PATH, 1).count() == 0


def test_merging_prefers_the_lowest_rank_then_the_leftmost():
    c = MergeCounter(PATH)
    assert c.merged(" the") == 1 and c.merged("") == 0 and c.merged("a") == 1
