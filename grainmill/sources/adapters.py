"""Upstream rows to canonical records: labelled safety sources, and injected/clean context pairs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill import schemas as S
from grainmill.functions.text import blank, first_byte_even, is_redacted, joined_text, json_object, source_id

_MODERATION = {"unsafe": "yes", "safe": "no"}
_HARM = {"harmful": "yes", "unharmful": "no"}
_REFUSAL = {"refusal": "yes", "compliance": "no"}
#: For each labelled source its tasks, label fields and the meaning of labels.
SPECS = {
    "aegis": (("prompt_moderation", "prompt_label", _MODERATION), ("response_moderation", "response_label", _MODERATION)),
    "wildguard": (("prompt_moderation", "prompt_harm_label", _HARM), ("response_moderation", "response_harm_label", _HARM), ("refusal", "response_refusal_label", _REFUSAL)),
}
#: The annotations that provenance keeps, where the input has them.
ANNOTATIONS = {
    "aegis": "id prompt_label response_label prompt_label_source response_label_source violated_categories",
    "wildguard": "adversarial prompt_harm_label response_harm_label response_refusal_label subcategory prompt_harm_agreement response_harm_agreement response_refusal_agreement",
    "deepset": "label",
    "notinject": "word_list category",
}


def missing_columns(name: str, columns: list[str]) -> list[str]:
    return sorted(set(S.REQUIRED_COLUMNS[name]) - set(columns))


def mapped(label: Column, meaning: dict[str, str]) -> Column:
    """Answer of a label; null for one outside the domain."""
    return F.create_map(*[F.lit(x) for kv in meaning.items() for x in kv])[label]


def instruction_for(name: str, task: Column) -> Column:
    own = S.AEGIS_POLICY if name == "aegis" else S.WILDGUARD_POLICY
    return F.when(task == "refusal", S.REFUSAL_POLICY).when(task == "prompt_injection", S.INJECTION_POLICY).otherwise(own)


def query_for(task: Column) -> Column:
    return (
        F.when(task == "prompt_moderation", S.PROMPT_QUERY).when(task == "refusal", S.REFUSAL_QUERY)
        .when(task == "prompt_injection", S.INJECTION_QUERY).otherwise(S.RESPONSE_QUERY)
    )


def provenance_json(name: str, columns: list[str], more: dict[str, str | None] | None = None) -> Column:
    """Dataset, file, row and the annotations the input has, null ones included, and what ``more`` says; fields in alphabetical order."""
    kept = [c for c in ANNOTATIONS[name].split() if c in columns]
    fields = {
        "dataset_id": F.lit(S.DATASET_IDS[name]), "file": F.col("file"), "row_index": F.col("row_index"),
        "original_annotations": F.struct(*kept) if kept else F.struct(F.lit(None).alias("none")),
    } | {k: F.lit(v).cast("string") for k, v in (more or {}).items()}
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def expanded(name: str, rows: DataFrame, split: str, more: dict[str, str | None] | None = None) -> DataFrame:
    """A row for each task of each input row (``entry`` from 0), with ``skip`` or ``violation`` where it gives no record.

    ``rows`` has ``file, row_index`` and the source's columns. The checks stand in the order
    redacted prompt, blank prompt, missing label, label domain, redacted and blank response.
    """
    if name not in S.REQUIRED_COLUMNS:
        raise ValueError(f"unknown source: {name}")
    if split not in S.SPLIT_RANK:
        raise ValueError(f"unknown split: {split}")
    if name == S.EVALUATION_ONLY and split != "test":
        raise ValueError(f"{name} is evaluation-only")
    if gone := missing_columns(name, rows.columns):
        raise ValueError(f"{name}: unexpected schema; missing {gone}")
    has = lambda c: F.col(c) if c in rows.columns else F.lit(None)
    prompt = F.coalesce(F.col("text" if name == "deepset" else "prompt"), F.lit(""))
    response = F.coalesce(has("response").cast("string"), F.lit(""))
    entry = lambda task, label, answer, domain: F.struct(F.lit(task).alias("task"), label.cast("string").alias("label"), answer.alias("answer"), domain.alias("in_domain"))
    if name in SPECS:
        specs = [entry(t, F.col(f), mapped(F.col(f), m), F.col(f).isin(*m)) for t, f, m in SPECS[name]]
    else:
        label = F.col("label") if name == "deepset" else F.lit(0)
        specs = [entry("prompt_injection", label, F.when(label == 1, "yes").otherwise("no"), label.isin(0, 1))]
    base = rows.select(
        F.lit(name).alias("source"), source_id(F.col("file"), has("id"), F.col("row_index")).alias("source_id"), F.lit(split).alias("source_split"),
        prompt.alias("__prompt"), response.alias("__response"), provenance_json(name, rows.columns, more).alias("provenance"), F.posexplode(F.array(*specs)).alias("entry", "__t"),
    )
    base = base.select("*", "__t.*").drop("__t")
    about_response = F.col("task").isin("response_moderation", "refusal")
    no_label = F.col("label").isNull() | ((F.col("label") == "") & F.lit(name in SPECS))
    skip = (
        F.when(is_redacted(F.col("__prompt")), "redacted_prompt_rows").when(blank(F.col("__prompt")), "empty_prompt_rows")
        .when(no_label, F.concat(F.lit("missing_label:"), "task")).when(~F.col("in_domain"), None)
        .when(about_response & is_redacted(F.col("__response")), F.concat(F.lit("redacted_response:"), "task"))
        .when(about_response & blank(F.col("__response")), F.concat(F.lit("empty_response:"), "task"))
    )
    prompt_gone = is_redacted(F.col("__prompt")) | blank(F.col("__prompt"))
    violation = F.when(~prompt_gone & ~no_label & ~F.coalesce(F.col("in_domain"), F.lit(False)), F.concat(F.lit("unexpected label: "), "task"))
    return base.withColumns({"skip": skip, "violation": violation})


def skip_counts(rows: DataFrame) -> DataFrame:
    """``reason, n`` of expanded rows. A prompt that is gone counts once for its input row, not for each task."""
    whole_row = F.col("skip").isin("redacted_prompt_rows", "empty_prompt_rows")
    once = rows.where(F.col("skip").isNotNull() & (~whole_row | (F.col("entry") == 0)))
    return once.groupBy(F.col("skip").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def records(name: str, rows: DataFrame, split: str, more: dict[str, str | None] | None = None) -> DataFrame:
    """Canonical records of a source file's rows; fails on a label outside its domain. ``more`` goes into their provenance."""
    full = expanded(name, rows, split, more)
    wrong = full.where("violation is not null").groupBy("violation").count().collect()  # a row for each task
    if wrong:
        raise ValueError(f"{name}: " + ", ".join(f"{r[0]} ({r[1]} rows)" for r in wrong))
    task = F.col("task")
    pair = json_object(user=F.col("__prompt"), assistant=F.col("__response"))
    document = F.when(task.isin("prompt_moderation", "prompt_injection"), F.col("__prompt")).otherwise(pair)
    return full.where("skip is null").select(
        "source", "source_id", "source_split", "task", instruction_for(name, task).alias("instruction"), query_for(task).alias("query"),
        document.alias("document"), "answer", F.array("__prompt").alias("group_texts"), "provenance",
    )


#: Licences and origins of the context kinds.
CONTEXT_KINDS = ("email", "table", "code")
CONTEXT_ORIGIN = {
    "email": "https://github.com/openai/evals/blob/main/evals/registry/data/invoices/match.jsonl",
    "table": "https://github.com/ppasupat/WikiTableQuestions",
    "code": "https://archive.org/details/stackexchange",
}
CONTEXT_REPOSITORY = "https://github.com/microsoft/BIPIA"
CONTEXT_REVISION = "a004b69ec0dd446e0afd461d98cb5e96e120a5d0"
LABEL_ORIGIN = "deterministic_clean_injected_adaptation_not_original_detector_labels"


def context_license(subtask: Column) -> Column:
    return F.when(subtask == "email", "MIT").otherwise("CC-BY-SA-4.0")


def context_query(subtask: Column, question: Column, error: Column, code: Column) -> Column:
    """The trusted task that a context belongs to."""
    fix = F.concat(F.lit("Fix the bug in the user's code using the external Stack Overflow answer.\n\nError:\n"), error, F.lit("\n\nUser code:\n"), code)
    ask = F.concat(F.lit("Answer the user's question using the external "), F.when(subtask == "email", "email").otherwise("table"), F.lit(".\n\nQuestion: "), question)
    return F.when(subtask == "code", fix).otherwise(ask)


def attack_pool_key(subtask: Column) -> Column:
    return F.when(subtask == "code", "code").otherwise("text")


def round_robin(contexts: DataFrame, attacks: DataFrame, keys: tuple[str, ...] = ("kind", "split")) -> DataFrame:
    """Each context (``ordinal``) with the attack whose ``ord`` is its ordinal modulo the pool's size.

    An equi-join on a computed number, not contexts times attacks. Attack pools are template
    lists of a benchmark; Spark broadcasts them by their size.
    """
    sizes = attacks.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    numbered = contexts.join(sizes, list(keys)).withColumn("ord", F.pmod(F.col("ordinal"), F.col("__n")).cast("int")).drop("__n")
    return numbered.join(attacks.withColumn("ord", F.col("ord").cast("int")), [*keys, "ord"])


def insertion_position(context: Column) -> Column:
    return F.when(first_byte_even(context), "start").otherwise("end")


def injected(context: Column, payload: Column, position: Column) -> Column:
    return F.when(position == "start", F.concat(payload, F.lit("\n"), context)).otherwise(F.concat(context, F.lit("\n"), payload))


def overlapping_attacks(attacks: DataFrame) -> DataFrame:
    """``kind, n``: payloads that stand in both splits of a kind."""
    side = lambda s: attacks.where(F.col("split") == s).select("kind", "payload")
    return side("train").intersect(side("test")).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def context_records(contexts: DataFrame, attacks: DataFrame) -> DataFrame:
    """A clean and an injected record for each context.

    ``contexts``: ``subtask, split, ordinal, context`` (an array of lines), ``question,
    error, code, context_url, context_author_url``. ``attacks``: ``kind, split, ord,
    attack_name, payload``. Fails if train and test share a payload.
    """
    shared = overlapping_attacks(attacks).collect()  # a row for each kind
    if shared:
        raise ValueError("attack templates overlap across splits: " + ", ".join(r[0] for r in shared))
    text = contexts.withColumn("context", joined_text(F.col("context"), "context")).withColumn("kind", attack_pool_key(F.col("subtask")))
    both = round_robin(text, attacks).withColumn("position", insertion_position(F.col("context")))
    line = (F.col("ordinal") + 1).cast("string")
    file = F.concat(F.lit("benchmark/"), "subtask", F.lit("/"), "split", F.lit(".jsonl"))
    id_ = F.concat_ws("/", "subtask", "split", line)
    origin = F.create_map(*[F.lit(x) for kv in CONTEXT_ORIGIN.items() for x in kv])
    link = F.concat(F.lit(f"{CONTEXT_REPOSITORY}/blob/{CONTEXT_REVISION}/"), file, F.lit("#L"), line)
    attribution = F.struct(
        link.alias("bipia_source_url"), context_license(F.col("subtask")).alias("context_license"), F.lit("MIT").alias("attack_license"), origin[F.col("subtask")].alias("original_context_source"),
        F.when(F.col("subtask") == "code", F.col("context_url")).alias("context_url"), F.when(F.col("subtask") == "code", F.col("context_author_url")).alias("context_author_url"),
    )

    def variant(kind: str, suffix: Column, document: Column, answer: str, attack: Column, position: Column) -> Column:
        adaptation = F.struct(F.lit(kind).alias("kind"), attack.alias("attack_name"), position.alias("position"))
        provenance = F.struct(
            F.lit(CONTEXT_REVISION).alias("revision"), F.col("subtask"), file.alias("original_file"), line.cast("int").alias("original_line"),
            context_license(F.col("subtask")).alias("license"), attribution.alias("attribution"), F.lit(LABEL_ORIGIN).alias("label_origin"), adaptation.alias("adaptation"),
        )
        return F.struct(F.concat(id_, suffix).alias("source_id"), document.alias("document"), F.lit(answer).alias("answer"), F.to_json(provenance).alias("provenance"))

    nothing = F.lit(None).cast("string")
    pairs = F.array(
        variant("original_clean_context", F.lit("/clean"), F.col("context"), "no", nothing, nothing),
        variant(
            "generated_by_inserting_original_attack_template", F.concat(F.lit("/injected/"), "attack_name", F.lit("/"), "position"),
            injected(F.col("context"), F.col("payload"), F.col("position")), "yes", F.col("attack_name"), F.col("position"),
        ),
    )
    query = context_query(F.col("subtask"), F.col("question"), F.col("error"), F.col("code"))
    out = both.withColumn("__q", query).select("*", F.explode(pairs).alias("r"))
    return out.select(
        F.lit("bipia").alias("source"), "r.source_id", F.col("split").alias("source_split"), F.lit("prompt_injection").alias("task"),
        F.concat(F.lit(S.CONTEXT_POLICY + S.TRUSTED_TASK), "__q").alias("instruction"), F.lit(S.CONTEXT_QUERY).alias("query"),
        "r.document", "r.answer", F.array("context").alias("group_texts"), "r.provenance",
    )


def lacking_author(contexts: DataFrame) -> DataFrame:
    """Code contexts whose author is not known."""
    author = F.col("context_author_url")
    return contexts.where((F.col("subtask") == "code") & (author.isNull() | (F.length(author) == 0)))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Canonical records of all sources."""
    return reduce(DataFrame.unionByName, frames)


def conversation_pairs(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, user, assistant``: user turns with the assistant turn right behind them.

    An equi-join on the turn's number, so a very long conversation is no one task's window.
    """
    user = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("user"))
    answer = turns.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("assistant"))
    return user.join(answer, ["conv_id", "turn"])
