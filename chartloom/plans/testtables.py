"""Clinical tables derived from the generic test tables.

Each rule is plain SQL that Spark and DuckDB read the same way; ``{name}`` marks a test
table. The rules run over whole tables, so everything built on them grows with the data.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

CONDITIONS = """
SELECT CAST(o.o_custkey AS STRING) AS PATIENT,
       CAST(l.l_orderkey AS STRING) AS ENCOUNTER,
       CASE WHEN l.l_orderkey % 97 = 0 AND l.l_linenumber = 1 THEN NULL ELSE CAST(l.l_shipdate AS DATE) END AS START,
       CASE WHEN l.l_linestatus = 'O' THEN NULL ELSE CAST(l.l_shipdate AS DATE) + l.l_linenumber END AS STOP,
       l.l_partkey AS CODE,
       p.p_name AS DESCRIPTION
FROM {lineitem} l
JOIN {orders} o ON l.l_orderkey = o.o_orderkey
JOIN {part} p ON l.l_partkey = p.p_partkey
"""

CONCEPT = """
SELECT p_partkey AS concept_id,
       CAST(p_partkey AS STRING) AS concept_code,
       p_name AS concept_name,
       'SNOMED' AS vocabulary_id,
       CASE WHEN p_size % 10 = 0 THEN NULL ELSE 'S' END AS standard_concept
FROM {part}
UNION ALL
SELECT 1000000 + p_partkey,
       substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', CAST(p_partkey % 26 + 1 AS INT), 1)
         || lpad(CAST((7 * p_partkey) % 100 AS STRING), 2, '0') || '.' || CAST(p_partkey % 10 AS STRING),
       CASE p_partkey % 9
         WHEN 0 THEN 'Unspecified ' || p_name
         WHEN 1 THEN 'Personal history of ' || p_name
         WHEN 2 THEN 'Other specified ' || p_name || ', in remission'
         WHEN 3 THEN 'Screening for ' || p_name
         ELSE p_name END,
       'ICD10CM',
       NULL
FROM {part} WHERE p_partkey < 200
"""

CONCEPT_RELATIONSHIP = """
SELECT p_partkey AS concept_id_1, 1000000 + (31 * p_partkey) % 200 AS concept_id_2,
       'Mapped from' AS relationship_id
FROM {part} WHERE p_size % 7 <> 0
UNION ALL
SELECT p_partkey, 1000000 + (31 * p_partkey + 17) % 200, 'Mapped from'
FROM {part} WHERE p_size % 7 <> 0 AND p_size % 3 >= 1
UNION ALL
SELECT p_partkey, 1000000 + (31 * p_partkey + 34) % 200, 'Mapped from'
FROM {part} WHERE p_size % 7 <> 0 AND p_size % 3 >= 2
UNION ALL
SELECT 1000000 + (31 * p_partkey) % 200, p_partkey, 'Maps to'
FROM {part} WHERE p_size % 7 <> 0
"""

# Every fifth document is an encounter note, the rest alternate between the two patient
# strategies; every fifth patient has all its notes at the same instant.
NOTES_SYNTH = """
SELECT CAST(doc_id AS STRING) AS note_id,
       'r' || lpad(CAST(CAST(floor(doc_id / 100) AS BIGINT) AS STRING), 6, '0') AS run_id,
       CAST(CAST(floor(doc_id / 4) AS BIGINT) AS STRING) AS patient_id,
       CASE WHEN doc_id % 5 = 4 THEN 'encounter-multilabel'
            WHEN doc_id % 2 = 0 THEN 'multilabel' ELSE 'primary_dx' END AS strategy,
       CASE WHEN doc_id % 5 = 4 THEN 'v1-encounter-multilabel'
            WHEN doc_id % 2 = 0 THEN 'v1-multilabel'
            WHEN doc_id % 3 = 0 THEN 'v1-primary_dx' ELSE 'v2-primary_dx' END AS prompt_version,
       'template-writer' AS model,
       TIMESTAMP '2026-01-01 00:00:00' + INTERVAL '1' SECOND * CAST(
         doc_id - CASE WHEN CAST(floor(doc_id / 4) AS BIGINT) % 5 = 0 THEN doc_id % 4 ELSE 0 END AS INT) AS generated_at,
       text AS note_text,
       CASE WHEN doc_id % 5 = 4 OR doc_id % 2 = 0 THEN NULL
            WHEN doc_id % 4 = 1 THEN 'K06.8'
            ELSE upper(substr(lang, 1, 1)) || lpad(substr(source, 4), 2, '0') || '.' || CAST(doc_id % 10 AS STRING)
            END AS primary_code,
       CASE WHEN doc_id % 5 = 4 AND doc_id % 35 <> 4 THEN 'e' || CAST(doc_id AS STRING) END AS encounter_id,
       CASE WHEN doc_id % 7 = 0 THEN NULL ELSE CAST(floor(n_chars / 4) AS BIGINT) END AS input_tokens,
       CASE WHEN doc_id % 11 = 0 THEN NULL ELSE CAST(floor(n_chars / 3) AS BIGINT) END AS output_tokens,
       'STOP' AS finish_reason
FROM {documents}
"""

NOTES_LABELS = """
SELECT CAST(doc_id AS STRING) AS note_id, icd10_code, 'about ' || icd10_code AS icd10_description,
       icd10_code = 'K06.8' OR (is_family AND doc_id % 4 = 3) AS is_primary
FROM (
  SELECT doc_id, TRUE AS is_family,
         CASE WHEN doc_id % 13 = 5 THEN 'Z59.' || CAST(doc_id % 10 AS STRING)
              ELSE upper(substr(lang, 1, 1)) || lpad(substr(source, 4), 2, '0') || '.' || CAST(doc_id % 10 AS STRING)
              END AS icd10_code
  FROM {documents}
  UNION ALL
  SELECT d.doc_id, FALSE, 'Q00.' || CAST(d.doc_id % 3 AS STRING)
  FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id WHERE l.quality = 0
  UNION ALL
  SELECT d.doc_id, FALSE, 'Q00.9' FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id WHERE l.quality = 0
  UNION ALL
  SELECT d.doc_id, FALSE, 'T51' FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id WHERE l.toxic = 1
  UNION ALL
  SELECT doc_id, FALSE, 'Z56.0' FROM {documents} WHERE doc_id % 6 = 0
  UNION ALL
  SELECT doc_id, FALSE, 'z73.3' FROM {documents} WHERE doc_id % 11 = 0
  UNION ALL
  SELECT doc_id, FALSE, 'K06.8' FROM {documents} WHERE doc_id % 4 = 1
) coded
"""

# Half of the existing pairs by hash, and pairs of patients that do not exist.
OLD_SPLIT = """
SELECT key, CASE WHEN substr(md5(key), 2, 1) < 'd' THEN 'dev' ELSE 'test' END AS bucket
FROM (
  SELECT DISTINCT CAST(CAST(floor(doc_id / 4) AS BIGINT) AS STRING) || '::' ||
         CASE WHEN doc_id % 2 = 0 THEN 'multilabel' ELSE 'primary_dx' END AS key
  FROM {documents} WHERE doc_id % 5 <> 4
  UNION ALL
  SELECT 'gone-' || CAST(doc_id AS STRING) || '::multilabel' FROM {documents} WHERE doc_id % 50 = 0
) pairs
WHERE substr(md5(key), 1, 1) < '8'
"""

GENERATION_OUTCOME = """
SELECT CAST(doc_id AS STRING) AS note_id,
       'r' || lpad(CAST(CAST(floor(doc_id / 100) AS BIGINT) AS STRING), 6, '0') AS run_id,
       CASE WHEN doc_id % 29 = 3 THEN 'failed' ELSE 'ok' END AS status,
       CASE WHEN doc_id % 29 = 3 THEN 'service said no to ' || CAST(doc_id AS STRING) END AS error
FROM {documents}
"""

PREDICTION_REQUESTS = """
SELECT CAST(doc_id AS STRING) AS note_id,
       CASE WHEN doc_id % 17 = 0 THEN substr(text, 1, 7) ELSE text END AS note_text,
       CASE doc_id % 3 WHEN 0 THEN 'encounter' WHEN 1 THEN 'patient' ELSE source END AS model,
       CAST(CASE WHEN doc_id % 19 = 0 THEN 1.5 WHEN doc_id % 23 = 0 THEN -0.25 ELSE (doc_id % 11) / 10.0 END
            AS DOUBLE) AS threshold
FROM {documents}
"""

RULES = {
    "conditions": CONDITIONS,
    "concept": CONCEPT,
    "concept_relationship": CONCEPT_RELATIONSHIP,
    "notes_synth": NOTES_SYNTH,
    "notes_labels": NOTES_LABELS,
    "old_split": OLD_SPLIT,
    "generation_outcome": GENERATION_OUTCOME,
    "prediction_requests": PREDICTION_REQUESTS,
}


def test_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clinical_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A clinical table as Spark reads its rule."""
    rule = RULES[name]
    inputs = {t: test_table(spark, sf_dir, t) for t in sorted(set(re.findall(r"\{(\w+)\}", rule)))}
    return spark.sql(rule, **inputs)


def clinical_sql(name: str) -> str:
    """The same rule as SQL over the bare table names."""
    return re.sub(r"\{(\w+)\}", r"\1", RULES[name]).strip()
