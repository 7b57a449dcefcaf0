"""Inputs of the registered queries, made from the data tables, and the same in SQL.

Splits and answers that the tables don't have follow stated rules: documents whose id ends
in 9 are test, in 8 validation, else train; the answer is yes for odd ids. Each document is
anchored by its text and its first line, so groups form through shared first lines too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill import schemas as S
from grainmill.functions.text import blank
from grainmill.operators.combine import Combined
from grainmill.runtime import scratch_path, table


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def norm_sql(x: str) -> str:
    """Normalised text in DuckDB; equal to ours on these tables, which hold no compatibility characters."""
    return rf"trim(regexp_replace(replace(lower({x}), 'ß', 'ss'), '\s+', ' ', 'g'))"


#: White space of these tables as a string of SQL.
SPACES_SQL = "' ' || chr(9) || chr(10) || chr(13)"


def json_sql(x: str) -> str:
    r = f"replace(replace(replace({x}, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n')"
    return f"'\"' || {r} || '\"'"


def fixture_split(id_: Column) -> Column:
    return F.when(id_ % 10 == 9, "test").when(id_ % 10 == 8, "validation").otherwise("train")


SPLIT_SQL = "CASE doc_id % 10 WHEN 9 THEN 'test' WHEN 8 THEN 'validation' ELSE 'train' END"


def moderation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as canonical records."""
    text, first = F.col("text"), F.split("text", "\n")[0]
    return table(spark, sf_dir, "documents").where(~blank(text)).select(
        "source", F.concat(F.lit("documents.parquet:"), F.col("doc_id").cast("string")).alias("source_id"), fixture_split(F.col("doc_id")).alias("source_split"),
        F.lit("prompt_moderation").alias("task"), F.lit(S.AEGIS_POLICY).alias("instruction"), F.lit(S.PROMPT_QUERY).alias("query"), text.alias("document"),
        F.when(F.col("doc_id") % 2 == 1, "yes").otherwise("no").alias("answer"), F.array(text, F.when(blank(first), text).otherwise(first)).alias("group_texts"),
        F.concat(F.lit('{"doc_id": '), F.col("doc_id").cast("string"), F.lit("}")).alias("provenance"),
    )


def evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as records that are for evaluation only."""
    return table(spark, sf_dir, "benchmark").where(~blank(F.col("text"))).select(
        F.lit(S.EVALUATION_ONLY).alias("source"), F.concat(F.lit("benchmark.parquet:"), F.col("item_id").cast("string")).alias("source_id"), F.lit("test").alias("source_split"),
        F.lit("prompt_injection").alias("task"), F.lit(S.INJECTION_POLICY).alias("instruction"), F.lit(S.INJECTION_QUERY).alias("query"), F.col("text").alias("document"),
        F.lit("no").alias("answer"), F.array("text").alias("group_texts"), F.lit(None).cast("string").alias("provenance"),
    )


def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return moderation(spark, sf_dir).unionByName(evaluation(spark, sf_dir))


def combined(spark: SparkSession, sf_dir: str) -> Combined:
    """The combination of the canonical records."""
    return Combined(canonical(spark, sf_dir))


def written(spark: SparkSession, content: str, ending: str = "txt") -> str:
    """The path of a shared folder with one text file of that content."""
    path = scratch_path(spark, "fixture")
    spark.createDataFrame([(content,)], "value string").coalesce(1).write.option("lineSep", "\n").text(path)
    return path


CANON = f"""
canon AS (
  SELECT source, 'documents.parquet:' || doc_id AS source_id, {SPLIT_SQL} AS source_split, 'prompt_moderation' AS task,
         {quoted(S.AEGIS_POLICY)} AS instruction, {quoted(S.PROMPT_QUERY)} AS query, text AS document,
         CASE WHEN doc_id % 2 = 1 THEN 'yes' ELSE 'no' END AS answer,
         [text, CASE WHEN trim(string_split(text, chr(10))[1]) = '' THEN text ELSE string_split(text, chr(10))[1] END] AS group_texts
  FROM documents WHERE trim(replace(text, chr(10), ' ')) <> ''
  UNION ALL
  SELECT 'notinject', 'benchmark.parquet:' || item_id, 'test', 'prompt_injection', {quoted(S.INJECTION_POLICY)}, {quoted(S.INJECTION_QUERY)}, text, 'no', [text]
  FROM benchmark WHERE trim(replace(text, chr(10), ' ')) <> ''
), printed AS (
  SELECT *, CASE source_split WHEN 'test' THEN 2 WHEN 'validation' THEN 1 ELSE 0 END AS rank, sha256({norm_sql('document')}) AS document_sha256,
         sha256('[' || {json_sql('task')} || ', ' || {json_sql(norm_sql('instruction'))} || ', ' || {json_sql(norm_sql('query'))} || ', ' || {json_sql(norm_sql('document'))} || ']') AS example_id,
         list_sort(list_distinct(list_append(list_transform(group_texts, lambda t: sha256({norm_sql('t')})), sha256({norm_sql('document')})))) AS anchors
  FROM canon
), edges AS (
  SELECT DISTINCT anchors[1] AS a, unnest(anchors) AS b FROM printed
), reach(a, b) AS (
  SELECT DISTINCT b, b FROM edges
  UNION SELECT r.a, e.y FROM reach r JOIN (SELECT a AS x, b AS y FROM edges UNION SELECT b, a FROM edges) e ON r.b = e.x
), component AS (
  SELECT a, min(b) AS group_id FROM reach GROUP BY a
), grouped AS (
  SELECT printed.*, group_id FROM printed JOIN component ON anchors[1] = component.a
), facts AS (
  SELECT group_id, max(rank) AS highest, CASE max(rank) WHEN 2 THEN 'test' WHEN 1 THEN 'validation' ELSE 'train' END AS highest_split,
         CASE WHEN max(rank) = 0 AND ('0x' || substr(sha256('42:' || group_id), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0::DOUBLE < 0.05::DOUBLE THEN 'validation'
              WHEN max(rank) = 2 THEN 'test' WHEN max(rank) = 1 THEN 'validation' ELSE 'train' END AS target
  FROM grouped GROUP BY group_id
), staying AS (
  SELECT grouped.*, facts.target FROM grouped JOIN facts USING (group_id) WHERE rank = highest
), answers AS (
  SELECT example_id, count(DISTINCT answer) AS n_answers FROM staying GROUP BY example_id
), agreed AS (
  SELECT staying.* FROM staying JOIN answers USING (example_id) WHERE n_answers = 1
), firsts AS (
  SELECT * FROM agreed QUALIFY row_number() OVER (PARTITION BY example_id ORDER BY source, source_id, task, source_split, document) = 1
)
"""


def canon_sql(select: str) -> str:
    return f"WITH RECURSIVE {CANON} {select}"
