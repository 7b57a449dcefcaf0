import math
from collections import Counter, defaultdict

import corpus_pipeline as cp
from grainmill.llm.language_id import identify, train
from grainmill.llm.mixing import targets
from grainmill.runtime import settle
from tests.llm.test_lines import S, low
from tests.llm.test_minhash import brute


def test_stages_equal_brute_force(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    odd = spark.createDataFrame([(9001, "", None, None, 0), (9002, None, "en", "src1", 0), (9003, "12 %% 7", "en", "src2", 7)], docs.schema)
    docs = settle(docs.unionByName(odd), "odd")
    columns, seen = docs.columns, []
    for name, stage in cp.STAGES:
        before, docs = docs, settle(stage(spark, docs, tiny), name)
        seen.append((name, before.collect(), docs.collect()))
        if name != "best_fit_packing":
            assert docs.columns == columns
    (_, all_, spoken), (_, _, clean), (_, _, single), (_, _, mixed), (_, _, packed) = seen

    predicted = {r.doc_id: r for r in identify(settle(spark.createDataFrame(all_), "again"), train(spark.createDataFrame(all_))).collect()}
    assert {r.doc_id for r in spoken} == {i for i, r in predicted.items() if r.lang_pred != "und" and r.score >= cp.LEAST_LANGUAGE_SCORE}
    assert not {9001, 9002, 9003} & {r.doc_id for r in spoken} and len(spoken) > 0.98 * (len(all_) - 3)

    keys = Counter(k for r in spoken for k in {low(x.strip(S)) for x in r.text.split("\n")} if k)
    want = {r.doc_id: "\n".join(x for x in r.text.split("\n") if keys[low(x.strip(S))] < cp.LINE_DOCS) for r in spoken}
    assert {r.doc_id: r.text for r in clean} == want

    groups = [r.strip("()").split(", ") for r in brute([(r.doc_id, r.text) for r in clean], cp.SHINGLE_WORDS, cp.SIMILAR_PERCENT)]
    assert {r.doc_id for r in single} == {int(g[0]) for g in groups if g[0] == g[2]} and len(single) < len(clean)

    size, own = defaultdict(int), {r.doc_id: len(r.text.split()) for r in single}
    for r in single:
        size[r.source] += own[r.doc_id]
    names = sorted(size)
    goal = dict(zip(names, targets([size[n] for n in names], [1.0 + i % 3 for i in range(len(names))], 3)))
    taken, times = defaultdict(int), Counter(r.doc_id for r in mixed)
    for r in mixed:
        taken[r.source] += own[r.doc_id]
    assert max(times.values()) <= 3 and all(abs(taken[n] - goal[n]) <= max(own.values()) for n in names)
    texts = {r.doc_id: r for r in single}
    assert all(texts[r.doc_id] == r for r in mixed)

    assert Counter(r.doc_id for r in packed if r.piece == 0) == times
    fill = defaultdict(int)
    for r in packed:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 4096 and len(fill) <= math.ceil(sum(fill.values()) / 4096) + 1


def test_run_gives_the_last_stage_and_an_empty_table_passes(spark, tiny, tmp_path):
    assert cp.run(spark, tiny).count() > 0
    spark.read.parquet(f"{tiny}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
