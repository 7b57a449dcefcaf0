"""The five sources from their published files to canonical records, with facts for the manifest.

A labelled source is described by its repository's metadata, which must resolve to a full
revision, the locked one if there is one. Its files are chosen by name, stored under the
revision, scanned and adapted; every record's provenance names dataset, revision, file,
licence and licence notes. The context source is one pinned revision whose thirteen files
have pinned checksums, verified when fetched and when found.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainmill import schemas as S
from grainmill.sources import adapters, scans
from grainmill.sources.fetching import Unavailable, answer, ask, stored

CONTEXTS = "bipia"
REVISION = r"[0-9a-f]{40}"
#: Names of the notices to keep, in capitals.
NOTICES = ("README.MD", "LICENSE", "LICENSE.TXT", "LICENSE.MD", "NOTICE", "NOTICE.TXT")
#: Where datasets are described and stored.
DATASETS, DATASET_API = "https://huggingface.co/datasets", "https://huggingface.co/api/datasets"
CONTEXT_FILES = "https://raw.githubusercontent.com/microsoft/BIPIA"
#: The files of the context source and their SHA-256.
PINNED = {
    "LICENSE": "57cf81c45e0929899bc18051cf90134f00e55963ddecc7b37cfc5ea1494b1e8b",
    "NOTICE.md": "8bb119c94b51352a44c88b42c7f8101b0304885ae6cd1ef9c289ad78d409d68b",
    "benchmark/README.md": "2f743580c83f4eab058d655fc6fc5f9a2ee2889d6f8396a5f088fce8286f6e4f",
    "benchmark/email/train.jsonl": "82207193cb8ce06713eeb7c33ca0716446613512e2ad9303b302ba14d425ddd4",
    "benchmark/email/test.jsonl": "217b403faaa1d0cb12c24892bea39f4a0b9e2819919ac7e2b902006e28278cdb",
    "benchmark/table/train.jsonl": "ae1c3ff25733fb3ff1a35bda3009716f4d25a17ae6833c73521be0411d576494",
    "benchmark/table/test.jsonl": "3d5eaab192b80bada762e3cd7655583a14e5888ba8b845a01f0434e4ccc4291e",
    "benchmark/code/train.jsonl": "5e6879b621a5cefe265a5b41b7ed0be632536f658f6097baf85a28b9abcb3115",
    "benchmark/code/test.jsonl": "ed40b84f541352fb45753032a80750922de8d5e0b70997924df3d04cf942e058",
    "benchmark/text_attack_train.json": "63f95d3e67eac4178cdabdbdaf192cd05f2b6ed0702b578f1d30d556e5155670",
    "benchmark/text_attack_test.json": "75750e7b4e8b34e8f9d88d89b357aeaaf02bd07f9e493ccd37eda74a0cd7c7f8",
    "benchmark/code_attack_train.json": "fe515080b6da2b5c0b67ca7ba2a3b3c2ce57c48f45733c475ebc813cba118484",
    "benchmark/code_attack_test.json": "892545c5aaec0645b1ded65dc7816b3d70e9ef4eadcba2301a7a3db93676b6e0",
}


def check_revision(revision: str, wanted: str | None = None) -> str:
    if not re.fullmatch(REVISION, revision or ""):
        raise ValueError("a revision is a commit of 40 hexadecimal digits")
    if wanted is not None and revision != wanted:
        raise ValueError(f"revision {revision} is not the locked {wanted}")
    return revision


def is_notice(name: str) -> bool:
    return name.rsplit("/", 1)[-1].upper() in NOTICES


def licence(name: str, card: dict) -> tuple[str | None, str | None]:
    """The declared licence and what is to be noted about it."""
    if name != "deepset":
        return card.get("license"), None
    inner = (card.get("dataset_info") or {}).get("license", "cc-by-4.0")
    return card.get("license"), f"The card says {card.get('license')}, its dataset_info says {inner}. The two differ; keep the attribution."


def labelled(spark: SparkSession, name: str, folder: Path, revision: str | None = None, token: str | None = None, send: Callable = ask) -> tuple[DataFrame, dict]:
    """Canonical records of a labelled source and its facts. Dataset ids are taken for names, too."""
    name = {v: k for k, v in S.DATASET_IDS.items()}.get(name, name)
    if name not in S.DATASET_IDS:
        raise ValueError(f"unknown source: {name}")
    if revision is not None:
        check_revision(revision)
    dataset = S.DATASET_IDS[name]
    with answer(f"{DATASET_API}/{dataset}" + (f"/revision/{revision}" if revision else ""), token, send) as got:
        described = json.load(got)
    revision = check_revision(described.get("sha"), revision)
    declared, notes = licence(name, described.get("cardData") or {})
    facts = {"repo_id": dataset, "url": f"{DATASETS}/{dataset}", "revision": revision, "license": declared, "license_notes": notes, "gated": described.get("gated", False)}
    if facts["gated"] and not token:
        raise Unavailable(name, "gated_source_requires_authorized_token", **{k: facts[k] for k in ("url", "revision", "license")})
    base = Path(folder) / dataset.replace("/", "--") / revision
    names = [x["rfilename"] for x in described.get("siblings", [])]
    fetched = lambda n: stored(f"{DATASETS}/{dataset}/resolve/{revision}/{quote(n, safe='/')}", base, n, None, token, send)
    chosen = {r.filename: r.source_split for r in scans.require_files(spark.createDataFrame([(n,) for n in names], "filename string"), name).collect()}
    notices = [(n, *fetched(n)) for n in names if is_notice(n)]
    (base / "api.json").write_text(json.dumps(described, ensure_ascii=False, indent=2))
    frames, files, skipped = [], [], {}
    for n, split in chosen.items():
        path, sha = fetched(n)
        rows = scanned(spark, path).withColumn("file", F.lit(n))
        more = {"dataset": dataset, "revision": revision, "source_url": f"{DATASETS}/{dataset}/blob/{revision}/{n}", "license": declared, "license_notes": notes}
        frames.append(adapters.records(name, rows, split, more))
        for r in adapters.skip_counts(adapters.expanded(name, rows, split)).collect():  # a row for each reason
            skipped[r.reason] = skipped.get(r.reason, 0) + r.n
        files.append({"path": n, "source_split": split, "rows": rows.count(), "sha256": sha})
    facts |= {"files": files, "skipped": dict(sorted(skipped.items())), "notices": [{"path": n, "sha256": sha} for n, _, sha in notices], "notice_paths": [str(p) for _, p, _ in notices]}
    if name == S.EVALUATION_ONLY:
        facts |= {"evaluation_only": True, "notes": "The three official subsets, all benign and all held out."}
    return adapters.union_all(frames), facts


def scanned(spark: SparkSession, path: Path) -> DataFrame:
    """Rows of a source file with ``file, row_index``; JSON fields are strings as far as they are plain values."""
    at = f"file://{path.resolve()}"
    if path.suffix != ".json":
        return scans.scan(spark, at, T.StructType())
    fields = spark.read.option("multiLine", True).option("primitivesAsString", True).json(at).schema
    return scans.scan(spark, at, T.StructType([f for f in fields.fields if f.name not in ("file", "row_index")]))


def contexts(spark: SparkSession, folder: Path, revision: str | None = None, send: Callable = ask) -> tuple[DataFrame, dict]:
    """Clean and injected records of the context source and its facts. There is one revision."""
    if revision not in (None, adapters.CONTEXT_REVISION):
        raise ValueError(f"{CONTEXTS}: the checksums are those of revision {adapters.CONTEXT_REVISION}")
    revision = adapters.CONTEXT_REVISION
    base = Path(folder) / CONTEXTS / revision
    with ThreadPoolExecutor(4) as pool:
        had = dict(zip(PINNED, pool.map(lambda n: stored(f"{CONTEXT_FILES}/{revision}/{n}", base, n, PINNED[n], None, send), PINNED)))
    at = lambda n: f"file://{had[n][0].resolve()}"
    splits = ("train", "test")
    tag = lambda df, **values: df.withColumns({k: F.lit(v) for k, v in values.items()})
    pools = adapters.union_all([tag(scans.attacks(spark, at(f"benchmark/{kind}_attack_{split}.json")), kind=kind, split=split) for kind in ("text", "code") for split in splits])
    rows = adapters.union_all([context_lines(spark, at(f"benchmark/{kind}/{split}.jsonl"), kind, split) for kind in adapters.CONTEXT_KINDS for split in splits])
    counts = {f"{r.subtask}/{r.split}": r.n for r in rows.groupBy("subtask", "split").agg(F.count(F.lit(1)).alias("n")).collect()}
    lacking = adapters.lacking_author(rows).select(F.concat_ws("/", "subtask", "split", (F.col("ordinal") + 1).cast("string"), F.lit("clean")).alias("id"))
    notices = [n for n in PINNED if is_notice(n) or n == "NOTICE.md"]
    facts = {
        "repository": adapters.CONTEXT_REPOSITORY, "revision": revision, "supported_tasks": list(adapters.CONTEXT_KINDS), "original_context_counts": dict(sorted(counts.items())),
        "attack_template_counts": {f"{r.kind}/{r.split}": r.n for r in pools.groupBy("kind", "split").agg(F.count(F.lit(1)).alias("n")).collect()},
        "files": [{"path": n, "sha256": sha} for n, (_, sha) in had.items()], "notice_paths": [str(had[n][0]) for n in notices],
        "upstream_missing_author_urls": sorted(r.id for r in lacking.collect()),  # of one pinned file of contexts
    }
    return adapters.context_records(rows, pools), facts


def context_lines(spark: SparkSession, path: str, kind: str, split: str) -> DataFrame:
    """Contexts of a file; each text may be one string or a list of lines."""
    texts, links = ("context", "question", "error", "code"), ("context_url", "context_author_url")
    lines = scans.json_lines(spark, path, T.StructType([T.StructField(f, T.VariantType()) for f in texts] + [T.StructField(f, T.StringType()) for f in links]))
    listed = lambda c: F.coalesce(F.try_variant_get(c, "$", "array<string>"), F.array(F.try_variant_get(c, "$", "string")))
    one = lambda c: F.when(F.col(c).isNotNull(), adapters.joined_text(listed(c), c))
    return lines.select(F.lit(kind).alias("subtask"), F.lit(split).alias("split"), "ordinal", listed("context").alias("context"), *[one(c).alias(c) for c in texts[1:]], *links)


def fetch(spark: SparkSession, name: str, folder: Path, revision: str | None = None, token: str | None = None, send: Callable = ask) -> tuple[DataFrame, dict]:
    """Records and facts of one of the five sources."""
    return contexts(spark, folder, revision, send) if name == CONTEXTS else labelled(spark, name, folder, revision, token, send)
