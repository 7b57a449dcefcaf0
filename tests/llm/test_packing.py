import math
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from grainmill.llm import packing
from grainmill.llm.packing import assemble, pack_documents, plan

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "It's THE <|startoftext|> end, x.y. a", "é İ K K, \x85z", "<|ENDOFTEXT|> é. ", "wörter " * 9000, "a\tb\r\nc. d.. ,,"]


def check(rows, library, texts, capacity):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for i, t in texts.items():
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        for k, p in enumerate(sorted(by_doc[i], key=lambda p: p.piece)):
            part = ids[k * capacity : (k + 1) * capacity]
            assert (p.piece, p.start, p.length) == (k, k * capacity, len(part))
            assert p.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        assert sum(p.length for p in by_doc[i]) == len(ids)
    for s in by_seq.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
    return len(by_seq), sum(r.length for r in rows)


def test_pieces_equal_the_library_and_fill_sequences(spark, small):
    library = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(ODD)], docs.schema)
    rows = pack_documents(docs.union(odd), PATH, 4096).collect()
    texts = {r.doc_id: r.text for r in docs.union(odd).collect()}
    sequences, tokens = check(rows, library, texts, 4096)
    assert sequences <= math.ceil(tokens / 4096) + 1


def test_ids_of_random_texts_equal_the_library_whatever_is_remembered(monkeypatch):
    library, rng = Tokenizer.from_file(PATH), random.Random(5)
    pool = ["İ,", "İ.", "क़,", "a", "B", "é", "K", "K", "ß", "ñ,", "'s", "don't", "1", "½", "x.", ",", ".", " ", " ", "\t", "\n", "\r", "\xa0", "<|startoftext|>", "<", "|", "ʼn", "ά", "ͅ", "̈", "한", "ﬁ,", "𝒳,", ""]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 12))) for _ in range(6000)]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for most in (700_000, 100):
        monkeypatch.setattr(packing, "CACHE_WORDS", most)
        words = packing.WordIds(PATH)
        got = [ids.tolist() for start in range(0, 6000, 500) for ids in words.ids(pa.array(texts[start : start + 500]))]
        assert got == want
    assert words.ids(pa.array([], pa.string())) == []


def test_assembled_ids_repeats_and_an_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "d")], "doc_id long, text string")
    packed = pack_documents(docs, PATH, 4, with_ids=True)
    assert packed.count() == 3
    whole = assemble(packed).collect()
    assert sorted(sum((r.ids for r in whole), []))[:3] == [1, 1, 1] and all(len(r.ids) <= 4 for r in whole)
    assert pack_documents(docs.limit(0), PATH, 4).count() == 0


def first_fit_decreasing(lengths, capacity):
    gaps = []
    for x in sorted(lengths, reverse=True):
        k = next((k for k, g in enumerate(gaps) if g >= x), None)
        if k is None:
            gaps.append(capacity - x)
        else:
            gaps[k] -= x
    return len(gaps)


def test_plan_places_every_rank_once_and_prefers_exact_fills():
    rng = np.random.default_rng(3)
    for capacity, draw in ((64, lambda: rng.integers(1, 65, 500)), (100, lambda: rng.integers(1, 9, 700)), (50, lambda: np.array([26] * 9 + [24] * 3 + [8] * 7)), (10, lambda: np.array([4] * 8 + [3] * 4))):
        lengths = draw()
        counts = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True))}
        p = plan(counts, capacity)
        fill, placed = defaultdict(int), defaultdict(int)
        for k in range(len(p["length"])):
            L, low = int(p["length"][k]), int(p["low"][k])
            nxt = [int(p["low"][j]) for j in range(len(p["length"])) if p["length"][j] == L and p["low"][j] > low]
            high = min(nxt) if nxt else counts[L]
            for r in range(low, high):
                fill[int(p["sequence"][k]) + (r - low) // int(p["uses"][k])] += L
                placed[L] += 1
        assert dict(placed) == counts and max(fill.values()) <= capacity and len(fill) == int(p["sequences"][0])
        assert len(fill) <= first_fit_decreasing(lengths, capacity)
        if capacity == 100:  # short pieces leave no gap but the last
            assert len(fill) <= math.ceil(lengths.sum() / capacity) + 1


def test_a_triple_is_found_when_the_longest_pair_beside_a_length_reuses_it():
    """A gap of 52: beside 22 the longest pair is 22 and 8, but there is one 22; 16 and 14 fill it."""
    got = plan({100: 1, 14: 1, 29: 1, 16: 1, 33: 1, 22: 1, 8: 1, 4: 1}, 152)
    first = {int(length): int(n) for length, n, sequence in zip(got["length"], got["uses"], got["sequence"]) if sequence == 0}
    assert first == {100: 1, 22: 1, 16: 1, 14: 1}
