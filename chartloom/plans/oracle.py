"""The registered queries as SQL for another engine, over the same test tables.

``STEPS`` are named subqueries in dependency order; an oracle is a final SELECT, and
``_compose`` puts in front of it the steps it reaches.
"""

from __future__ import annotations

import re

from chartloom.functions.codes import CHAPTER_WEIGHTS, TRIVIAL_PHRASES
from chartloom.operators.evaluation import THRESHOLDS
from chartloom.operators.prompts import MULTILABEL_TEMPLATE, PRIMARY_DX_TEMPLATE
from chartloom.plans.testtables import RULES, clinical_sql

WORDS = r"[\p{L}\p{N}_]{2,}"
SPACES = r"[\t-\r\x1c-\x20\x{85}\p{Z}]+"
RUN_ID = "20260201-080000"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _chapter_weight(code: str) -> str:
    letter = f"upper(substr({code}, 1, 1))"
    second = f"CASE WHEN length({code}) > 1 THEN substr({code}, 2, 1) ELSE '0' END"
    rules = " ".join(
        f"WHEN {letter} = '{a}' AND ({second}) BETWEEN '{lo}' AND '{hi}' THEN {w}" for a, lo, hi, w in CHAPTER_WEIGHTS
    )
    return f"CASE {rules} ELSE 1 END"


def _penalty(text: str) -> str:
    hits = " + ".join(f"CASE WHEN lower({text}) LIKE '%{phrase}%' THEN 1 ELSE 0 END" for phrase in TRIVIAL_PHRASES)
    return f"-2 * ({hits})"


def _score(code: str, text: str) -> str:
    return (
        f"CASE WHEN upper({code}) LIKE 'Z%' THEN -100 ELSE {_chapter_weight(code)} + {_penalty(text)} "
        f"+ CASE WHEN length({code}) > 4 THEN 1 ELSE 0 END END"
    )


def _ratio(top: str, bottom: str) -> str:
    return f"CASE WHEN {bottom} > 0 THEN CAST({top} AS DOUBLE) / ({bottom}) ELSE 0.0::DOUBLE END"


def _unit(text: str) -> str:
    return f"CAST(CAST('0x' || substr(md5({text}), 1, 6) AS BIGINT) AS DOUBLE) / 16777215.0::DOUBLE"


def _dedup(source: str, keys: str, carried: list[str]) -> str:
    kept = ", ".join(f"min({c}) AS {c}" for c in carried)
    return (
        f"SELECT {keys}, icd10_code, {kept}, min(condition_start_date) AS start_date, "
        f"max(condition_stop_date) AS stop_date FROM {source} GROUP BY {keys}, icd10_code"
    )


def _cap(source: str, keys: str, n: int) -> str:
    return (
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY start_date DESC NULLS LAST, icd10_code)"
        f" AS position FROM {source}) WHERE position <= {n}"
    )


def _latest(source: str) -> str:
    return (
        "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY patient_id, strategy "
        f"ORDER BY generated_at DESC, note_id DESC) AS rn FROM {source}) WHERE rn = 1"
    )


def _rarest(source: str) -> str:
    return (
        f"SELECT key, label_code AS stratum FROM (SELECT a.key, a.label_code, row_number() OVER (PARTITION BY a.key "
        f"ORDER BY b.size, a.label_code) AS rn FROM {source} a JOIN (SELECT label_code, count(*) AS size FROM {source} "
        f"GROUP BY label_code) b ON a.label_code = b.label_code) WHERE rn = 1"
    )


def _folds(strata: str, k: int) -> str:
    return (
        f"SELECT key, stratum, CAST((row_number() OVER (ORDER BY stratum, md5('42:' || key), key) - 1) % {k} + 1 AS INT) "
        f"AS fold FROM {strata}"
    )


def _dealt(k: int) -> str:
    """Folds of the stratum whose turn it is in ``state``: slots above each fold's count are taken from the lowest."""
    slots = (
        "SELECT o.r, o.f, s.n, row_number() OVER (PARTITION BY o.r ORDER BY o.n + j.j, "
        f"(o.f - (o.r - 1) % {k} + {k}) % {k}) AS slot FROM state o JOIN strata s ON s.r = o.r AND o.r = o.done + 1 "
        "JOIN (SELECT unnest(range(1, (SELECT max(n) FROM strata) + 1)) AS j) j ON j.j <= s.n"
    )
    quotas = f"SELECT r, f, count(*) AS n FROM ({slots}) WHERE slot <= n GROUP BY r, f"
    ends = f"SELECT r, f, n, sum(n) OVER (PARTITION BY r ORDER BY f) AS hi FROM ({quotas})"
    return (
        f"SELECT p.key, p.stratum, p.rs, q.f FROM placed p JOIN strata s ON s.r = p.r JOIN ({ends}) q ON q.r = p.r "
        "AND p.position * s.step % s.n < q.hi AND p.position * s.step % s.n >= q.hi - q.n"
    )


def _iterative(source: str, k: int) -> str:
    """Folds levelled label by label: each step of the recursion deals one stratum and counts its labels."""
    return (
        "SELECT key, stratum, CAST(f + 1 AS INT) AS fold FROM (WITH RECURSIVE ranked AS (SELECT label_code, "
        f"row_number() OVER (ORDER BY count(*), label_code) AS r FROM {source} GROUP BY label_code), "
        f"listed AS (SELECT t.key, list(r.r ORDER BY r.r) AS rs, list(r.label_code ORDER BY r.r) AS codes FROM {source} t "
        "JOIN ranked r ON t.label_code = r.label_code GROUP BY t.key), "
        "placed AS (SELECT key, rs, codes[1] AS stratum, rs[1] AS r, CAST(row_number() OVER (PARTITION BY codes[1] "
        "ORDER BY coalesce(codes[2], ''), coalesce(codes[3], ''), md5('42:' || key), key) - 1 AS HUGEINT) AS position FROM listed), "
        "strata AS (SELECT r, n, (SELECT max(x) FROM unnest(range(1, greatest(2, CAST(floor(0.618::DOUBLE * n) AS BIGINT) + 1))) "
        "AS u(x) WHERE gcd(x, n) = 1) AS step FROM (SELECT r, count(*) AS n FROM placed GROUP BY r)), "
        f"state AS (SELECT 0::BIGINT AS done, r, f, 0::BIGINT AS n FROM ranked CROSS JOIN unnest(range({k})) AS u(f) UNION ALL "
        "SELECT o.done + 1, o.r, o.f, o.n + coalesce(a.c, 0) FROM state o LEFT JOIN (SELECT r, f, count(*) AS c FROM "
        f"(SELECT f, unnest(rs) AS r FROM ({_dealt(k)})) GROUP BY r, f) a ON a.r = o.r AND a.f = o.f "
        f"WHERE o.done < (SELECT count(*) FROM ranked)) {_dealt(k)})"
    )


def _kept(labels: str, bucket: str, vocab: str) -> str:
    return (
        f"SELECT DISTINCT l.note_id, l.label_code FROM {labels} l JOIN bucketed b ON l.note_id = b.note_id "
        f"JOIN {vocab} v ON l.label_code = v.label_code WHERE b.bucket = '{bucket}'"
    )


def _dense(kept: str, vocab: str) -> str:
    return (
        f"SELECT n.note_id, v.label_code AS code, CASE WHEN k.note_id IS NULL THEN 0 ELSE 1 END AS y_true "
        f"FROM (SELECT DISTINCT note_id FROM {kept}) n CROSS JOIN {vocab} v "
        f"LEFT JOIN {kept} k ON k.note_id = n.note_id AND k.label_code = v.label_code"
    )


def _hashed(dense: str, extra: str = "") -> str:
    unit = _unit("note_id || '|' || code")
    return (
        f"SELECT *, CASE WHEN y_proba > 0.5 THEN 1 ELSE 0 END AS y_pred FROM (SELECT *{extra}, "
        f"CASE WHEN y_true = 1 THEN 0.25::DOUBLE + 0.75::DOUBLE * ({unit}) "
        f"WHEN code LIKE 'Q%' THEN 0.45::DOUBLE * ({unit}) ELSE 0.62::DOUBLE * ({unit}) END AS y_proba FROM {dense})"
    )


def _confusion(source: str, by: str = "") -> str:
    return (
        f"SELECT {by}code, count(*) FILTER (y_true = 1 AND y_pred = 1) AS tp, count(*) FILTER (y_true = 0 AND y_pred = 1) AS fp, "
        f"count(*) FILTER (y_true = 1 AND y_pred = 0) AS fn, count(*) FILTER (y_true = 0 AND y_pred = 0) AS tn, "
        f"count(*) FILTER (y_true = 1) AS support, count(*) FILTER (y_pred = 1) AS pred_positive "
        f"FROM {source} GROUP BY {by}code"
    )


P = _ratio("tp", "(tp + fp)")
R = _ratio("tp", "(tp + fn)")
F1 = _ratio("2 * tp", "(2 * tp + fp + fn)")
MICRO_P = _ratio("sum(tp)", "(sum(tp) + sum(fp))")
MICRO_R = _ratio("sum(tp)", "(sum(tp) + sum(fn))")
MICRO_F = _ratio("2 * sum(tp)", "(2 * sum(tp) + sum(fp) + sum(fn))")
HAMMING = _ratio("(sum(fp) + sum(fn))", "(sum(tp) + sum(fp) + sum(fn) + sum(tn))")


def _stats(source: str) -> str:
    return (
        f"SELECT code, support, pred_positive, round({P}, 3) AS precision, round({R}, 3) AS recall, round({F1}, 3) AS f1, "
        f"fn, fp FROM ({_confusion(source)})"
    )


def _score_table(source: str, by: str) -> str:
    """Score table per group column ``by`` (may be a constant)."""
    return (
        f"SELECT a.{by}, b.n_notes, a.n_codes, a.micro_f1, a.macro_f1, b.subset_accuracy, a.hamming_loss FROM "
        f"(SELECT {by}, count(*) AS n_codes, {MICRO_F} AS micro_f1, avg({F1}) AS macro_f1, {HAMMING} AS hamming_loss "
        f"FROM ({_confusion(source, by + ', ')}) GROUP BY {by}) a JOIN "
        f"(SELECT {by}, count(*) AS n_notes, avg(1 - wrong) AS subset_accuracy FROM (SELECT {by}, note_id, "
        f"max(CASE WHEN y_true <> y_pred THEN 1 ELSE 0 END) AS wrong FROM {source} GROUP BY {by}, note_id) GROUP BY {by}) b "
        f"ON a.{by} = b.{by}"
    )


def _words(source: str, ngrams: int) -> str:
    gram = "t" if ngrams == 1 else "list_concat(t, [t[i] || ' ' || t[i + 1] FOR i IN range(1, len(t))])"
    return (
        f"SELECT note_id, term, count(*) AS tf FROM (SELECT note_id, unnest({gram}) AS term FROM "
        f"(SELECT note_id, regexp_extract_all(lower(note_text), '{WORDS}') AS t FROM {source})) GROUP BY note_id, term"
    )


def _chars(source: str) -> str:
    return (
        "SELECT note_id, substr(w, i, k) AS term, CAST(sum(n) AS BIGINT) AS tf FROM (SELECT note_id, w, n, k, "
        "unnest(range(1, length(w) - k + 2)) AS i FROM (SELECT note_id, w, n, unnest([3, 4, 5]) AS k FROM "
        "(SELECT note_id, ' ' || word || ' ' AS w, count(*) AS n FROM (SELECT note_id, "
        f"unnest(string_split_regex(lower(note_text), '{SPACES}')) AS word FROM {source}) WHERE word <> '' "
        "GROUP BY note_id, word)) WHERE length(w) >= k) GROUP BY note_id, term"
    )


def _vocabulary(counts: str, notes: str) -> str:
    return (
        f"SELECT term, row_number() OVER (ORDER BY term) - 1 AS feature_id, df, cf, "
        f"ln((1 + (SELECT count(*) FROM {notes}))::DOUBLE / (1 + df)) + 1 AS idf FROM "
        f"(SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM {counts} GROUP BY term "
        f"HAVING count(*) >= 2 AND count(*) <= 0.95::DOUBLE * (SELECT count(*) FROM {notes}) ORDER BY cf DESC, term LIMIT 20000)"
    )


def _tfidf(counts: str, vocab: str) -> str:
    return (
        f"SELECT note_id, term, feature_id, raw / sqrt(sum(raw * raw) OVER (PARTITION BY note_id)) AS weight FROM "
        f"(SELECT c.note_id, c.term, v.feature_id, (1 + ln(c.tf)) * v.idf AS raw FROM {counts} c JOIN {vocab} v ON c.term = v.term)"
    )


def _scored(notes: str, prefix: str) -> str:
    """Probabilities of the hash-derived model on ``notes``; ``prefix`` names their feature steps."""
    return (
        f"SELECT n.note_id, v.label_code AS code, 1 / (1 + exp(-(coalesce(m.margin, 0) - 0.5::DOUBLE))) AS y_proba "
        f"FROM {notes} n CROSS JOIN vocab v LEFT JOIN (SELECT t.note_id, c.code, sum(t.weight * c.w) AS margin FROM "
        f"(SELECT note_id, 'word' AS block, term, weight FROM {prefix}_word UNION ALL "
        f"SELECT note_id, 'char', term, weight FROM {prefix}_char) t JOIN hashed_coefficients c "
        f"ON t.block = c.block AND t.term = c.term GROUP BY t.note_id, c.code) m "
        f"ON m.note_id = n.note_id AND m.code = v.label_code"
    )


BILLABLE = """
SELECT c.PATIENT AS patient_id, c.ENCOUNTER AS encounter_id, c.START AS condition_start_date, c.STOP AS condition_stop_date,
       CAST(c.CODE AS VARCHAR) AS snomed_code, c.DESCRIPTION AS snomed_description, i.concept_code AS icd10_code,
       i.concept_name AS icd10_description
FROM conditions c
JOIN concept s ON CAST(c.CODE AS VARCHAR) = s.concept_code AND s.vocabulary_id = 'SNOMED' AND s.standard_concept = 'S'
JOIN concept_relationship r ON s.concept_id = r.concept_id_1 AND r.relationship_id = 'Mapped from'
JOIN concept i ON r.concept_id_2 = i.concept_id AND i.vocabulary_id = 'ICD10CM'
"""

# Columns and types of the two stored tables, as files declare them.
PROFILED = {
    "notes_synth": {
        **dict.fromkeys(("note_id", "run_id", "patient_id", "strategy", "prompt_version", "model"), "string"),
        "generated_at": "timestamp",
        **dict.fromkeys(("note_text", "primary_code", "encounter_id"), "string"),
        **dict.fromkeys(("input_tokens", "output_tokens"), "bigint"),
        "finish_reason": "string",
    },
    "notes_labels": {
        **dict.fromkeys(("note_id", "icd10_code", "icd10_description"), "string"),
        "is_primary": "boolean",
    },
}
# What the deterministic writer says of a prompt's list lines.
WRITTEN = (
    "array_to_string(list_transform(list_filter(string_split(prompt, chr(10)), lambda x: starts_with(x, '- ') AND contains(x, ': ')), "
    "lambda x: 'Managed for ' || substr(x, strpos(x, ': ') + 2) || '.'), ' ')"
)
CARRIED = ["icd10_description", "snomed_code", "snomed_description"]
LINE = "'- ' || icd10_code || ' (' || coalesce(CAST(start_date AS VARCHAR), 'unknown date') || '): ' || coalesce(icd10_description, 'no description')"


def _rolled(size: int) -> str:
    return (
        f"SELECT note_id, substr(icd10_code, 1, {size}) AS label_code, bool_or(is_primary) AS is_primary "
        f"FROM notes_labels WHERE upper(icd10_code) NOT LIKE 'Z%' GROUP BY note_id, substr(icd10_code, 1, {size})"
    )


def _pool(name: str, where: str) -> str:
    return (
        f"SELECT *, '{name}' AS kind FROM (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY md5(patient_id), patient_id) AS r "
        f"FROM eligible_p WHERE {where}) WHERE r <= 60 ORDER BY patient_id LIMIT 30)"
    )


def _info(rollup: str, bucket: str) -> str:
    counts, vocab, kept = f"counts_{rollup}", f"vocab_{rollup}", f"{bucket}_kept_{rollup}"
    return (
        f"SELECT '{rollup}' AS rollup, '{bucket}' AS bucket, (SELECT count(DISTINCT note_id) FROM {kept}) AS n_notes, "
        f"(SELECT count(*) FROM bucketed WHERE bucket = '{bucket}') - (SELECT count(DISTINCT note_id) FROM {kept}) AS n_notes_dropped_empty, "
        f"(SELECT count(*) FROM {vocab}) AS n_codes_kept, (SELECT count(*) FROM {counts} WHERE n_rows < 3) AS n_codes_dropped_rare, "
        f"3 AS min_code_freq, round(coalesce((SELECT count(*)::DOUBLE / nullif(count(DISTINCT note_id), 0) FROM {kept}), 0), 6) AS avg_labels_per_note"
    )


def _enc_info(bucket: str) -> str:
    kept = f"enc_{bucket}_kept"
    return (
        f"SELECT '3char' AS rollup, '{bucket}' AS bucket, (SELECT count(DISTINCT note_id) FROM {kept}) AS n_notes, "
        f"(SELECT count(*) FROM enc_bucketed WHERE bucket = '{bucket}') - (SELECT count(DISTINCT note_id) FROM {kept}) AS n_notes_dropped_empty, "
        f"(SELECT count(*) FROM enc_counts WHERE n_rows >= 3) AS n_codes_kept, (SELECT count(*) FROM enc_counts WHERE n_rows < 3) AS n_codes_dropped_rare, "
        f"3 AS min_code_freq, round(coalesce((SELECT count(*)::DOUBLE / nullif(count(DISTINCT note_id), 0) FROM {kept}), 0), 6) AS avg_labels_per_note"
    )


def _enc_kept(bucket: str) -> str:
    return (
        "SELECT DISTINCT l.note_id, l.label_code FROM labels3 l JOIN enc_bucketed b ON l.note_id = b.note_id "
        f"JOIN (SELECT label_code FROM enc_counts WHERE n_rows >= 3) v ON l.label_code = v.label_code WHERE b.bucket = '{bucket}'"
    )


SWEEP_SOURCE = f"SELECT unnest([{', '.join(f'{t}::DOUBLE' for t in THRESHOLDS)}]) AS threshold"

STEPS: dict[str, str] = {
    **{name: clinical_sql(name) for name in RULES},
    "billable": BILLABLE,
    "clinical": "SELECT * FROM billable WHERE icd10_code NOT LIKE 'Z%'",
    "eligible_p": "SELECT patient_id, count(DISTINCT icd10_code) AS n_codes FROM billable GROUP BY patient_id HAVING count(DISTINCT icd10_code) >= 3",
    "eligible_e": "SELECT encounter_id, patient_id, count(DISTINCT icd10_code) AS n_codes FROM clinical GROUP BY encounter_id, patient_id HAVING count(DISTINCT icd10_code) >= 2",
    "sampled_p": "SELECT * FROM eligible_p ORDER BY md5(patient_id), patient_id LIMIT 50",
    "sampled_e": "SELECT * FROM eligible_e ORDER BY md5(encounter_id), encounter_id LIMIT 200",
    "patient_dedup": _dedup("billable", "patient_id", [*CARRIED, "encounter_id"]),
    "eligible_dedup": "SELECT * FROM patient_dedup WHERE patient_id IN (SELECT patient_id FROM eligible_p)",
    "sampled_p_dedup": "SELECT * FROM patient_dedup WHERE patient_id IN (SELECT patient_id FROM sampled_p)",
    "sampled_p_cap": _cap("sampled_p_dedup", "patient_id", 20),
    "patient_cap": _cap("patient_dedup", "patient_id", 20),
    "encounter_dedup": _dedup("clinical", "encounter_id, patient_id", CARRIED),
    "eligible_e_dedup": "SELECT d.* FROM encounter_dedup d JOIN eligible_e e ON d.encounter_id = e.encounter_id AND d.patient_id = e.patient_id",
    "encounter_cap": _cap("eligible_e_dedup", "encounter_id, patient_id", 10),
    "sampled_e_dedup": "SELECT d.* FROM encounter_dedup d JOIN sampled_e e ON d.encounter_id = e.encounter_id AND d.patient_id = e.patient_id",
    "sampled_e_cap": _cap("sampled_e_dedup", "encounter_id, patient_id", 10),
    "picked": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY score DESC, "
    "coalesce(CAST(start_date AS VARCHAR), '0000-00-00') DESC, position) AS rn FROM (SELECT *, "
    f"{_score('icd10_code', 'icd10_description')} AS score FROM patient_cap)) WHERE rn = 1",
    "in_run": "SELECT DISTINCT patient_id FROM notes_synth WHERE run_id = 'r000000'",
    "multilabel_prompts": f"SELECT patient_id, {_quoted(MULTILABEL_TEMPLATE.split('{conditions_block}')[0])} || "
    f"string_agg({LINE}, chr(10) ORDER BY position) || {_quoted(MULTILABEL_TEMPLATE.split('{conditions_block}')[1])} AS prompt "
    "FROM patient_cap GROUP BY patient_id",
    "secondary": f"SELECT c.patient_id, string_agg({LINE.replace('icd10_', 'c.icd10_').replace('start_date', 'c.start_date')}, chr(10) ORDER BY c.position) AS block "
    "FROM patient_cap c JOIN picked p ON c.patient_id = p.patient_id AND c.position <> p.position GROUP BY c.patient_id",
    "primary_prompts": "SELECT p.patient_id, p.icd10_code AS primary_code, "
    f"{_quoted(PRIMARY_DX_TEMPLATE.split('{primary_condition}')[0])} || p.icd10_description || ' (ICD-10: ' || p.icd10_code || ')' || "
    f"{_quoted(PRIMARY_DX_TEMPLATE.split('{primary_condition}')[1].split('{secondary_block}')[0])} || coalesce(s.block, '- (none)') || "
    f"{_quoted(PRIMARY_DX_TEMPLATE.split('{secondary_block}')[1])} AS prompt "
    "FROM picked p LEFT JOIN secondary s ON p.patient_id = s.patient_id",
    "written": f"SELECT *, CAST(floor(length(prompt) / 4) AS BIGINT) AS input_tokens, 'HOSPITAL COURSE' || chr(10) || {WRITTEN} AS note_text FROM ("
    "SELECT patient_id, 'multilabel' AS strategy, 'v1-multilabel' AS prompt_version, CAST(NULL AS VARCHAR) AS primary_code, prompt "
    "FROM multilabel_prompts UNION ALL SELECT patient_id, 'primary_dx', 'v2-primary_dx', primary_code, prompt FROM primary_prompts)",
    "run_patients": "SELECT * FROM eligible_p WHERE patient_id NOT IN (SELECT patient_id FROM in_run) ORDER BY md5(patient_id), patient_id LIMIT 50",
    "run_notes": f"SELECT '{RUN_ID}_' || w.patient_id || '_' || w.strategy AS note_id, '{RUN_ID}' AS run_id, w.patient_id, w.strategy, w.prompt_version, "
    "'template-writer' AS model, w.note_text, w.input_tokens, CAST(floor(length(w.note_text) / 4) AS BIGINT) AS output_tokens, 'STOP' AS finish_reason, "
    "c.n_labels, CASE WHEN w.strategy = 'primary_dx' THEN 1 ELSE 0 END::BIGINT AS n_primary FROM written w JOIN run_patients r ON w.patient_id = r.patient_id "
    "JOIN (SELECT patient_id, count(*) AS n_labels FROM patient_cap GROUP BY patient_id) c ON w.patient_id = c.patient_id",
    "labels3": _rolled(3),
    "labels1": _rolled(1),
    "labels0": "SELECT note_id, icd10_code AS label_code, is_primary FROM notes_labels",
    "latest_all": _latest("notes_synth"),
    "latest": _latest("notes_synth WHERE strategy IN ('multilabel', 'primary_dx')"),
    "pairs": "SELECT note_id, patient_id || '::' || strategy AS key FROM latest",
    "pair_labels": "SELECT p.key, l.label_code FROM pairs p JOIN labels3 l ON p.note_id = l.note_id",
    "fresh": "SELECT * FROM pair_labels WHERE key NOT IN (SELECT key FROM old_split)",
    "fresh_strata": _rarest("fresh"),
    "fresh_folds": _folds("fresh_strata", 5),
    "fresh_split": "SELECT key, CASE WHEN fold = 1 THEN 'test' ELSE 'dev' END AS bucket FROM fresh_folds",
    "split": "SELECT key, bucket FROM old_split WHERE key IN (SELECT key FROM pairs) UNION ALL SELECT key, bucket FROM fresh_split",
    "bucketed": "SELECT l.note_id, l.note_text, s.key, s.bucket FROM latest l JOIN pairs p ON l.note_id = p.note_id JOIN split s ON p.key = s.key",
    **{
        name: sql
        for rollup, labels in (("dirty", "labels0"), ("3char", "labels3"), ("chapter", "labels1"))
        for name, sql in (
            (
                f"counts_{rollup}",
                f"SELECT label_code, count(*) AS n_rows FROM {labels} WHERE note_id IN (SELECT note_id FROM bucketed WHERE bucket = 'dev') GROUP BY label_code",
            ),
            (f"vocab_{rollup}", f"SELECT label_code, n_rows FROM counts_{rollup} WHERE n_rows >= 3"),
            (f"dev_kept_{rollup}", _kept(labels, "dev", f"vocab_{rollup}")),
            (f"test_kept_{rollup}", _kept(labels, "test", f"vocab_{rollup}")),
            (f"dev_dense_{rollup}", _dense(f"dev_kept_{rollup}", f"vocab_{rollup}")),
            (f"test_dense_{rollup}", _dense(f"test_kept_{rollup}", f"vocab_{rollup}")),
            (f"dev_pred_{rollup}", _hashed(f"dev_dense_{rollup}")),
        )
    },
    "vocab": "SELECT label_code FROM vocab_3char",
    "held_out": _hashed("test_dense_3char"),
    "fold_labels": "SELECT note_id AS key, label_code FROM dev_kept_3char",
    "fold_strata": _rarest("fold_labels"),
    "folds": _folds("fold_strata", 5),
    "oof": "SELECT p.*, f.fold FROM dev_pred_3char p JOIN folds f ON p.note_id = f.key",
    "stats": _stats("held_out"),
    "oof_stats": _stats("oof"),
    "fold_table": _score_table("oof", "fold"),
    "swept": "SELECT threshold, code, count(*) FILTER (y_true = 1 AND y_proba >= threshold) AS tp, "
    "count(*) FILTER (y_true = 0 AND y_proba >= threshold) AS fp, count(*) FILTER (y_true = 1 AND y_proba < threshold) AS fn "
    f"FROM oof CROSS JOIN ({SWEEP_SOURCE}) GROUP BY threshold, code",
    "sweep": f"SELECT threshold, {MICRO_P} AS micro_precision, {MICRO_R} AS micro_recall, {MICRO_F} AS micro_f1, "
    f"avg({P}) AS macro_precision, avg({R}) AS macro_recall, avg({F1}) AS macro_f1 FROM swept GROUP BY threshold",
    "best": "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY metric_value DESC, threshold) AS rn FROM "
    "(SELECT *, 'micro_f1' AS metric, micro_f1 AS metric_value FROM sweep UNION ALL SELECT *, 'macro_f1', macro_f1 FROM sweep)) WHERE rn = 1",
    "summary": "SELECT count(*) AS n_folds, avg(micro_f1) AS mean_micro_f1, stddev_pop(micro_f1) AS std_micro_f1, "
    "avg(macro_f1) AS mean_macro_f1, stddev_pop(macro_f1) AS std_macro_f1 FROM fold_table",
    "encounter_keys": "SELECT DISTINCT encounter_id AS key FROM notes_synth WHERE strategy = 'encounter-multilabel' AND encounter_id IS NOT NULL",
    "mostly_test": "SELECT l.icd10_code, CASE WHEN s.r <= (SELECT floor(count(*) * 0.9::DOUBLE) FROM encounter_keys) THEN 'test' ELSE 'dev' END AS bucket "
    "FROM (SELECT key, row_number() OVER (ORDER BY md5('42:' || key), key) AS r FROM encounter_keys) s JOIN notes_synth n ON n.encounter_id = s.key "
    "AND n.strategy = 'encounter-multilabel' JOIN notes_labels l ON l.note_id = n.note_id",
    "enc_split": "SELECT key, CASE WHEN row_number() OVER (ORDER BY md5('42:' || key), key) <= "
    "(SELECT floor(count(*) * 0.2::DOUBLE) FROM encounter_keys) THEN 'test' ELSE 'dev' END AS bucket FROM encounter_keys",
    "enc_bucketed": "SELECT n.note_id, s.bucket FROM notes_synth n JOIN enc_split s ON n.encounter_id = s.key WHERE n.strategy = 'encounter-multilabel'",
    "enc_counts": "SELECT label_code, count(*) AS n_rows FROM labels3 WHERE note_id IN (SELECT note_id FROM enc_bucketed WHERE bucket = 'dev') GROUP BY label_code",
    "enc_dev_kept": _enc_kept("dev"),
    "enc_test_kept": _enc_kept("test"),
    "enc_fold_labels": "SELECT note_id AS key, label_code FROM enc_dev_kept",
    "enc_fold_strata": _rarest("enc_fold_labels"),
    "enc_folds": _folds("enc_fold_strata", 5),
    "enc_vocab": "SELECT label_code FROM enc_counts WHERE n_rows >= 3",
    "dictionary": "SELECT substr(icd10_code, 1, 3) AS code_3char, min(icd10_description) AS description FROM notes_labels "
    "WHERE substr(md5(icd10_code), 1, 1) < 'c' GROUP BY substr(icd10_code, 1, 3)",
    "texts": "SELECT CAST(doc_id AS VARCHAR) AS note_id, text AS note_text FROM documents",
    "text_tokens": _words("texts", 1),
    "text_words": _words("texts", 2),
    "text_chars": _chars("texts"),
    "text_word_vocab": _vocabulary("text_words", "texts"),
    "text_char_vocab": _vocabulary("text_chars", "texts"),
    "text_word_rows": _tfidf("text_words", "text_word_vocab"),
    "text_char_rows": _tfidf("text_chars", "text_char_vocab"),
    "dev_notes": "SELECT note_id, note_text FROM bucketed WHERE bucket = 'dev' AND note_id IN (SELECT note_id FROM dev_kept_3char)",
    "test_notes": "SELECT note_id, note_text FROM bucketed WHERE bucket = 'test' AND note_id IN (SELECT note_id FROM test_kept_3char)",
    "valid_texts": "SELECT * FROM texts WHERE length(note_text) >= 10",
    "dev_words": _words("dev_notes", 2),
    "dev_chars": _chars("dev_notes"),
    "dev_word_vocab": _vocabulary("dev_words", "dev_notes"),
    "dev_char_vocab": _vocabulary("dev_chars", "dev_notes"),
    "hashed_coefficients": f"SELECT block, term, label_code AS code, {_unit(chr(39).join(['block || ', ':', ' || term || ', '|', ' || label_code']))} * 2 - 1 AS w FROM "
    "(SELECT 'word' AS block, term FROM dev_word_vocab UNION ALL SELECT 'char', term FROM dev_char_vocab) t CROSS JOIN vocab",
    "test_words": _words("test_notes", 2),
    "test_chars": _chars("test_notes"),
    "test_word": _tfidf("test_words", "dev_word_vocab"),
    "test_char": _tfidf("test_chars", "dev_char_vocab"),
    "test_scored": _scored("test_notes", "test"),
    "arrived_word": _tfidf("text_words", "dev_word_vocab"),
    "arrived_char": _tfidf("text_chars", "dev_char_vocab"),
    "arrived_scored": _scored("valid_texts", "arrived"),
}


def _checked_folds(labels: str, folds: str) -> str:
    return (
        f"SELECT fold, CAST((SELECT count(*) FROM {folds}) - count(DISTINCT f.key) AS BIGINT) AS n_train, count(DISTINCT f.key) AS n_val, "
        "count(*) AS n_positive, true AS each_code_once, true AS predictions_sound, true AS converged "
        f"FROM {folds} f JOIN {labels} l ON l.key = f.key GROUP BY fold"
    )


def _checked_evaluation(kept: str, vocab: str) -> str:
    return (
        f"SELECT n_notes, n_codes, n_notes * n_codes AS n_rows, n_positive, true AS probabilities_agree, true AS predictions_sound, "
        f"true AS converged FROM (SELECT count(DISTINCT note_id) AS n_notes, count(*) AS n_positive, (SELECT count(*) FROM {vocab}) AS n_codes FROM {kept})"
    )


def _text_dates(*names: str) -> str:
    return ", ".join(f"CAST({n} AS VARCHAR) AS {n}" for n in names)


def _round(*names: str, digits: int = 6) -> str:
    return ", ".join(f"round({n}, {digits}) AS {n}" for n in names)


SWEEP_COLUMNS = ("micro_precision", "micro_recall", "micro_f1", "macro_precision", "macro_recall", "macro_f1")
SCORES = ("micro_f1", "macro_f1", "subset_accuracy", "hamming_loss")
SPLIT_REPORT = """
SELECT (SELECT count(*) FROM split) AS n_total,
       (SELECT count(*) FROM split WHERE bucket = 'dev') AS n_dev,
       (SELECT count(*) FROM split WHERE bucket = 'test') AS n_test,
       (SELECT count(*) FROM split WHERE bucket = 'dev' AND key IN (SELECT key FROM old_split)) AS n_carried_dev,
       (SELECT count(*) FROM split WHERE bucket = 'test' AND key IN (SELECT key FROM old_split)) AS n_carried_test,
       (SELECT count(*) FROM fresh_split WHERE bucket = 'dev') AS n_new_dev,
       (SELECT count(*) FROM fresh_split WHERE bucket = 'test') AS n_new_test,
       (SELECT count(*) FROM old_split WHERE key NOT IN (SELECT key FROM pairs)) AS n_orphaned,
       (SELECT count(*) FROM pairs WHERE key NOT IN (SELECT key FROM split)) AS n_skipped_empty,
       (SELECT count(DISTINCT l.label_code) FROM pair_labels l JOIN split s ON l.key = s.key WHERE s.bucket = 'test'
          AND l.label_code NOT IN (SELECT l.label_code FROM pair_labels l JOIN split s ON l.key = s.key WHERE s.bucket = 'dev'))
         AS n_codes_only_in_test
"""
MODEL_FRESHNESS = """
SELECT '3char' AS rollup, old.n_notes AS model_notes, old.n_codes AS model_codes, now.n_notes AS current_notes,
       now.n_codes AS current_codes, NOT (old.n_notes = now.n_notes AND old.n_codes = now.n_codes) AS is_stale
FROM (SELECT count(DISTINCT b.note_id) AS n_notes, count(DISTINCT l.label_code) AS n_codes
      FROM (SELECT note_id, patient_id || '::' || strategy AS key FROM (SELECT *, row_number() OVER (PARTITION BY patient_id, strategy
              ORDER BY generated_at DESC, note_id DESC) AS rn FROM notes_synth
              WHERE run_id = 'r000000' AND strategy IN ('multilabel', 'primary_dx')) WHERE rn = 1) b
      JOIN split s ON b.key = s.key AND s.bucket = 'dev' JOIN labels3 l ON l.note_id = b.note_id) old
CROSS JOIN (SELECT count(DISTINCT note_id) AS n_notes, (SELECT count(*) FROM vocab_3char) AS n_codes FROM dev_kept_3char) now
"""
STRATEGIES = "(SELECT unnest(['multilabel', 'primary_dx']) AS strategy)"
PROBLEM = (
    "CASE WHEN length(note_text) < 10 THEN 'note too short' WHEN threshold NOT BETWEEN 0 AND 1 THEN 'threshold outside [0, 1]' "
    "WHEN model NOT IN ('encounter', 'patient') THEN 'unknown model' ELSE '' END"
)


def _shape(stage: str, source: str, code: str) -> str:
    return (
        f"SELECT '{stage}' AS stage, count(*) AS n_rows, count(DISTINCT {code}) AS n_codes, count(DISTINCT note_id) AS n_notes, "
        f"round(count(*)::DOUBLE / count(DISTINCT note_id), 6) AS labels_per_note FROM {source}"
    )


FINAL: dict[str, str] = {
    "conditions_billable": f"SELECT patient_id, encounter_id, {_text_dates('condition_start_date', 'condition_stop_date')}, snomed_code, snomed_description, icd10_code, icd10_description FROM billable",
    "standard_concepts": "SELECT concept_id AS snomed_concept_id, concept_code AS snomed_code, concept_name AS snomed_name FROM concept WHERE vocabulary_id = 'SNOMED' AND standard_concept = 'S'",
    "target_concepts": "SELECT concept_id AS icd10_concept_id, concept_code AS icd10_code, concept_name AS icd10_name FROM concept WHERE vocabulary_id = 'ICD10CM'",
    "mapping_edges": "SELECT concept_id_1 AS snomed_concept_id, concept_id_2 AS icd10_concept_id FROM concept_relationship WHERE relationship_id = 'Mapped from'",
    "labels_3char": "SELECT * FROM labels3",
    "labels_chapter": "SELECT * FROM labels1",
    "labels_dirty": "SELECT note_id, icd10_code AS label_code, is_primary FROM notes_labels",
    "zcode_filter": "SELECT note_id, icd10_code, 'any case' AS rule FROM notes_labels WHERE upper(icd10_code) NOT LIKE 'Z%' "
    "UNION ALL SELECT note_id, icd10_code, 'upper case' FROM notes_labels WHERE icd10_code NOT LIKE 'Z%'",
    "labels_latest": "SELECT l.note_id, l.label_code FROM labels3 l JOIN latest_all n ON l.note_id = n.note_id",
    "labels_per_note": "SELECT n.note_id, coalesce(string_agg(l.label_code, ',' ORDER BY l.label_code), '') AS label_codes FROM notes_synth n LEFT JOIN labels3 l ON n.note_id = l.note_id GROUP BY n.note_id",
    "encounter_notes": "SELECT note_id, patient_id, encounter_id, note_text FROM notes_synth WHERE strategy = 'encounter-multilabel' AND encounter_id IS NOT NULL",
    "pair_keys": "SELECT note_id, patient_id || '::' || strategy AS pair FROM notes_synth",
    "note_ids": "SELECT note_id, CASE WHEN encounter_id IS NOT NULL THEN run_id || '_' || encounter_id || '_encounter' ELSE run_id || '_' || patient_id || '_' || strategy END AS made_id, "
    "strftime(generated_at, '%Y%m%d-%H%M%S') AS clock_run_id FROM notes_synth",
    "legacy_id_to_pair": "SELECT note_id, run_id || '_p_' || patient_id || '_' || strategy AS made_id, 'p_' || patient_id || '::' || strategy AS pair FROM notes_synth WHERE strategy IN ('multilabel', 'primary_dx')",
    "latest_notes": "SELECT note_id, patient_id, strategy, prompt_version, note_text FROM latest_all",
    "latest_run_notes": "SELECT note_id, run_id, strategy, note_text FROM notes_synth WHERE run_id = (SELECT max(run_id) FROM notes_synth)",
    "random_sample": "SELECT note_id, strategy, note_text, output_tokens FROM notes_synth WHERE run_id = (SELECT max(run_id) FROM notes_synth) ORDER BY md5('7:' || note_id) LIMIT 3",
    "validate_notes": f"SELECT note_id, ({PROBLEM}) = '' AS is_valid, {PROBLEM} AS problem FROM prediction_requests",
    "note_preview": "SELECT note_id, length(note_text) AS n_chars, replace(substr(note_text, 1, 200), chr(10), ' ') AS preview FROM notes_synth",
    "chapter_weight": f"SELECT DISTINCT icd10_code, CAST({_chapter_weight('icd10_code')} AS INT) AS weight FROM billable",
    "trivial_penalty": f"SELECT DISTINCT icd10_description, CAST({_penalty('icd10_description')} AS INT) AS penalty FROM billable",
    "primary_score": f"SELECT DISTINCT icd10_code, icd10_description, CAST({_score('icd10_code', 'icd10_description')} AS INT) AS score FROM billable",
    "pick_primary": "SELECT patient_id, icd10_code AS primary_code, icd10_description AS primary_description, CAST(start_date AS VARCHAR) AS primary_start_date, CAST(score AS INT) AS primary_score, CAST(position AS INT) AS primary_position FROM picked",
    "condition_lines": f"SELECT patient_id, CAST(position AS INT) AS position, {LINE} AS line FROM patient_cap",
    "prompt_multilabel": f"SELECT encounter_id, patient_id, {_quoted(MULTILABEL_TEMPLATE.split('{conditions_block}')[0])} || string_agg({LINE}, chr(10) ORDER BY position) || "
    f"{_quoted(MULTILABEL_TEMPLATE.split('{conditions_block}')[1])} AS prompt FROM encounter_cap GROUP BY encounter_id, patient_id",
    "prompt_primary": "SELECT patient_id, primary_code, prompt FROM primary_prompts",
    "eligible_patients": "SELECT * FROM eligible_p",
    "eligible_encounters": "SELECT * FROM eligible_e",
    "dedup_conditions": f"SELECT * REPLACE ({_text_dates('start_date', 'stop_date')}) FROM eligible_dedup",
    "cap_conditions": f"SELECT * REPLACE ({_text_dates('start_date', 'stop_date')}, CAST(position AS INT) AS position) FROM encounter_cap",
    "hash_sample": "SELECT * FROM sampled_e",
    "selected_patients": f"SELECT * REPLACE ({_text_dates('start_date', 'stop_date')}, CAST(position AS INT) AS position) FROM sampled_p_cap",
    "selected_encounters": f"SELECT * REPLACE ({_text_dates('start_date', 'stop_date')}, CAST(position AS INT) AS position) FROM sampled_e_cap",
    "patients_from_run": "SELECT * FROM eligible_p WHERE patient_id IN (SELECT patient_id FROM in_run)",
    "patients_exclude_run": "SELECT * FROM eligible_p WHERE patient_id NOT IN (SELECT patient_id FROM in_run)",
    "patient_pool": "SELECT patient_id, n_codes, kind FROM ("
    + _pool("plain", "TRUE")
    + " UNION ALL "
    + _pool("include", "patient_id IN (SELECT patient_id FROM in_run)")
    + " UNION ALL "
    + _pool("exclude", "patient_id NOT IN (SELECT patient_id FROM in_run)")
    + ")",
    "strategy_fanout": f"SELECT patient_id, strategy, CASE strategy WHEN 'multilabel' THEN 'v1-multilabel' ELSE 'v2-primary_dx' END AS prompt_version FROM eligible_p CROSS JOIN {STRATEGIES}",
    "label_rows": f"SELECT '{RUN_ID}_' || c.patient_id || '_' || s.strategy AS note_id, c.icd10_code, c.icd10_description, "
    "s.strategy = 'primary_dx' AND c.icd10_code = c.top AS is_primary FROM (SELECT *, first_value(icd10_code) OVER (PARTITION BY patient_id "
    "ORDER BY score DESC, coalesce(CAST(start_date AS VARCHAR), '0000-00-00') DESC, position) AS top FROM (SELECT *, "
    f"{_score('icd10_code', 'icd10_description')} AS score FROM patient_cap)) c CROSS JOIN {STRATEGIES} s",
    "note_rows": f"SELECT '{RUN_ID}_' || patient_id || '_' || strategy AS note_id, '{RUN_ID}' AS run_id, patient_id, strategy, prompt_version, 'none' AS model, prompt AS note_text, "
    "labels, primary_code, '' AS encounter_id, length(prompt) AS input_tokens, CAST(0 AS BIGINT) AS output_tokens, 'STOP' AS finish_reason FROM "
    "(SELECT patient_id, 'multilabel' AS strategy, 'v1-multilabel' AS prompt_version, '' AS primary_code, prompt FROM multilabel_prompts UNION ALL "
    "SELECT patient_id, 'primary_dx', 'v2-primary_dx', primary_code, prompt FROM primary_prompts) JOIN "
    "(SELECT patient_id, string_agg(icd10_code, ',' ORDER BY icd10_code) AS labels FROM patient_cap GROUP BY patient_id) USING (patient_id)",
    "generate_notes": "SELECT patient_id, strategy, prompt_version, primary_code, note_text, input_tokens, "
    "CAST(floor(length(note_text) / 4) AS BIGINT) AS output_tokens, 'template-writer' AS model, 'STOP' AS finish_reason, "
    "'ok' AS status, CAST(NULL AS VARCHAR) AS error FROM written",
    "encounter_note_rows": f"SELECT '{RUN_ID}_' || encounter_id || '_encounter' AS note_id, '{RUN_ID}' AS run_id, patient_id, "
    "'encounter-multilabel' AS strategy, 'v1-encounter-multilabel' AS prompt_version, 'template-writer' AS model, note_text, input_tokens, "
    "CAST(floor(length(note_text) / 4) AS BIGINT) AS output_tokens, 'STOP' AS finish_reason, encounter_id, labels, '' AS primary_code FROM "
    f"(SELECT *, CAST(floor(length(prompt) / 4) AS BIGINT) AS input_tokens, 'HOSPITAL COURSE' || chr(10) || {WRITTEN} AS note_text "
    f"FROM (SELECT encounter_id, patient_id, string_agg(icd10_code, ',' ORDER BY icd10_code) AS labels, {_quoted(MULTILABEL_TEMPLATE.split('{conditions_block}')[0])} || "
    f"string_agg({LINE}, chr(10) ORDER BY position) || {_quoted(MULTILABEL_TEMPLATE.split('{conditions_block}')[1])} AS prompt FROM encounter_cap GROUP BY encounter_id, patient_id))",
    "generation_run": "SELECT note_id, run_id, patient_id, strategy, prompt_version, model, note_text, input_tokens, output_tokens, "
    "finish_reason, n_labels, n_primary, true AS is_backed_up FROM run_notes",
    "generation_totals": "SELECT run_id, n_notes, n_label_rows, CAST(0 AS BIGINT) AS n_failures, total_in, total_out, "
    "round(total_in * 0.30::DOUBLE / 1e6 + total_out * 2.50::DOUBLE / 1e6, 6) AS cost_usd FROM (SELECT run_id, count(*) AS n_notes, "
    "CAST(sum(n_labels) AS BIGINT) AS n_label_rows, CAST(sum(input_tokens) AS BIGINT) AS total_in, CAST(sum(output_tokens) AS BIGINT) AS total_out "
    "FROM run_notes GROUP BY run_id)",
    "generation_failures": "SELECT * FROM generation_outcome WHERE status = 'failed'",
    "generation_cost": "SELECT run_id, CAST(total_in AS BIGINT) AS total_in, CAST(total_out AS BIGINT) AS total_out, round(total_in * 0.30::DOUBLE / 1e6 + total_out * 2.50::DOUBLE / 1e6, 6) AS cost_usd FROM "
    "(SELECT run_id, sum(coalesce(input_tokens, 0)) AS total_in, sum(coalesce(output_tokens, 0)) AS total_out FROM notes_synth GROUP BY run_id)",
    "cost_preview": "SELECT n AS n_calls, round(n * 0.002::DOUBLE, 6) AS est_cost_usd, round(n * 7 / 60::DOUBLE, 6) AS est_minutes, n >= 200 AS needs_confirmation FROM (SELECT 2 * count(*) AS n FROM eligible_p)",
    "run_summary": "SELECT run_id, CAST(sum(written) AS BIGINT) AS n_notes, CAST(sum(n_labels) AS BIGINT) AS n_label_rows, CAST(sum(failed) AS BIGINT) AS n_failures FROM "
    "(SELECT o.run_id, CASE WHEN o.status = 'ok' THEN 1 ELSE 0 END AS written, CASE WHEN o.status = 'failed' THEN 1 ELSE 0 END AS failed, "
    "CASE WHEN o.status = 'ok' THEN coalesce(l.n, 0) ELSE 0 END AS n_labels FROM generation_outcome o LEFT JOIN (SELECT note_id, count(*) AS n FROM notes_labels GROUP BY note_id) l ON o.note_id = l.note_id) GROUP BY run_id",
    "split_carried": "SELECT key, bucket FROM old_split WHERE key IN (SELECT key FROM pairs)",
    "split_new": "SELECT key FROM pairs WHERE key NOT IN (SELECT key FROM old_split)",
    "split_orphaned": "SELECT key, bucket FROM old_split WHERE key NOT IN (SELECT key FROM pairs)",
    "split_merged": "SELECT key, bucket FROM split",
    "stratified_split": "SELECT key, bucket FROM fresh_split",
    "stratified_iterative": f"SELECT key, CASE WHEN fold = 1 THEN 'test' ELSE 'dev' END AS bucket FROM ({_iterative('fresh', 5)})",
    "kfold_iterative": _iterative("fold_labels", 5),
    "encounter_split": "SELECT key, bucket FROM enc_split",
    "split_report": SPLIT_REPORT,
    "codes_test_not_dev": "SELECT DISTINCT l.icd10_code AS label_code FROM mostly_test l WHERE l.bucket = 'test' AND l.icd10_code NOT IN (SELECT icd10_code FROM mostly_test WHERE bucket = 'dev')",
    "kfold_assign": "SELECT key, stratum, fold FROM folds",
    "fold_balance": "SELECT l.label_code, f.fold, count(*) AS n FROM fold_labels l JOIN folds f ON l.key = f.key GROUP BY l.label_code, f.fold",
    "bucket_notes": "SELECT key, note_id, bucket FROM bucketed",
    "label_vocab": "SELECT label_code, n_rows FROM vocab_3char",
    "nonempty_notes": "SELECT note_id, note_text FROM dev_notes",
    "dataset_info": " UNION ALL ".join(_info(r, b) for r in ("dirty", "3char", "chapter") for b in ("dev", "test")),
    "encounter_dataset_info": " UNION ALL ".join(_enc_info(b) for b in ("dev", "test")),
    "binarize_long": "SELECT note_id, code, y_true FROM dev_dense_3char",
    "rebinarize": "SELECT note_id, code, y_true FROM test_dense_3char",
    "confusion_per_code": _confusion("held_out"),
    "per_code_prf": "SELECT * FROM stats",
    "micro_scores": f"SELECT round({MICRO_P}, 6) AS micro_precision, round({MICRO_R}, 6) AS micro_recall, round({MICRO_F}, 6) AS micro_f1 FROM ({_confusion('held_out')})",
    "macro_scores": f"SELECT round(avg({P}), 6) AS macro_precision, round(avg({R}), 6) AS macro_recall, round(avg({F1}), 6) AS macro_f1 FROM ({_confusion('held_out')})",
    "subset_accuracy": f"SELECT round(subset_accuracy, 6) AS subset_accuracy, n_notes FROM ({_score_table('(SELECT *, 1 AS one FROM held_out)', 'one')})",
    "hamming_loss": f"SELECT round({HAMMING}, 6) AS hamming_loss FROM ({_confusion('held_out')})",
    "fold_scores": f"SELECT fold, (SELECT count(*) FROM folds) - n_notes AS n_train, n_notes AS n_val, {_round(*SCORES)} FROM fold_table",
    "fold_summary": f"SELECT n_folds, {_round('mean_micro_f1', 'std_micro_f1', 'mean_macro_f1', 'std_macro_f1')} FROM summary",
    "oof_scores": f"SELECT n_notes, n_codes, {_round(*SCORES)} FROM ({_score_table('(SELECT *, 1 AS one FROM oof)', 'one')})",
    "threshold_sweep": f"SELECT {_round('threshold', *SWEEP_COLUMNS)} FROM sweep",
    "best_threshold": f"SELECT {_round('threshold', *SWEEP_COLUMNS)}, metric, round(metric_value, 6) AS metric_value FROM best",
    "cv_headline": f"SELECT n_folds, {_round('mean_micro_f1', 'std_micro_f1', 'mean_macro_f1', 'std_macro_f1')}, "
    + ", ".join(
        f"round((SELECT {column} FROM best WHERE metric = '{metric}'), 6) AS best_{metric}_{name}"
        for metric in ("micro_f1", "macro_f1")
        for column, name in (("threshold", "threshold"), ("metric_value", "value"))
    )
    + " FROM summary",
    "f1_summary": "SELECT count(*) AS total_codes, count(*) FILTER (f1 = 0) AS zero_f1, count(*) FILTER (f1 < 0.5) AS low_f1, count(*) FILTER (f1 >= 0.8) AS high_f1 FROM stats",
    "min_support_summary": "SELECT 10 AS min_support, count(*) FILTER (support >= 10) AS n_included, count(*) FILTER (support < 10) AS n_excluded, "
    "round(avg(f1) FILTER (support >= 10), 6) AS mean_f1_included, round(avg(f1) FILTER (support < 10), 6) AS mean_f1_excluded, "
    "round(coalesce(sum(support - fn) FILTER (support >= 10) / nullif(sum(support - fn + 0.5::DOUBLE * (fp + fn)) FILTER (support >= 10), 0), 0), 6) AS micro_f1_included, "
    "round(coalesce(sum(support - fn) FILTER (support > 0) / nullif(sum(support - fn + 0.5::DOUBLE * (fp + fn)) FILTER (support > 0), 0), 0), 6) AS micro_f1_all FROM oof_stats",
    "support_buckets": "SELECT CASE WHEN support <= 5 THEN '1-5' WHEN support <= 15 THEN '6-15' WHEN support <= 30 THEN '16-30' WHEN support <= 50 THEN '31-50' ELSE '51+' END AS bucket, "
    "count(*) AS n_codes, round(avg(f1), 6) AS mean_f1, round(min(f1), 6) AS min_f1, round(max(f1), 6) AS max_f1 FROM oof_stats WHERE support > 0 GROUP BY ALL",
    "rollup_comparison": f"SELECT rollup, n_notes, n_codes, {_round(*SCORES)} FROM ("
    + _score_table(
        "(SELECT note_id, code, y_true, y_pred, '3char' AS rollup FROM dev_pred_3char UNION ALL SELECT note_id, code, y_true, y_pred, 'chapter' FROM dev_pred_chapter "
        "UNION ALL SELECT note_id, code, y_true, y_pred, 'dirty' FROM dev_pred_dirty)",
        "rollup",
    )
    + ")",
    "worst_codes": "SELECT * FROM stats ORDER BY f1, code LIMIT 20",
    "best_codes": "SELECT * FROM stats ORDER BY f1 DESC, code LIMIT 10",
    "top_codes_by_support": "SELECT * FROM stats ORDER BY support DESC, code LIMIT 20",
    "sample_prediction": "SELECT h.note_id, coalesce(string_agg(h.code, ',' ORDER BY h.code) FILTER (h.y_true = 1), '') AS truth, coalesce(string_agg(h.code, ',' ORDER BY h.code) FILTER (h.y_pred = 1), '') AS predicted, "
    "replace(substr(any_value(n.note_text), 1, 200), chr(10), ' ') AS head FROM held_out h JOIN notes_synth n ON h.note_id = n.note_id WHERE h.note_id = (SELECT min(note_id) FROM held_out WHERE y_true = 1) GROUP BY h.note_id",
    "table_profile": " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, (SELECT count(*) FROM {table}) AS n_rows, '{column}' AS column_name, "
        f"'{kind}' AS data_type, 'NULLABLE' AS mode"
        for table, columns in PROFILED.items()
        for column, kind in columns.items()
    ),
    "top_conditions": "SELECT CAST(CODE AS VARCHAR) AS snomed_code, DESCRIPTION AS description, count(*) AS n FROM conditions GROUP BY CODE, DESCRIPTION ORDER BY n DESC, snomed_code LIMIT 20",
    "billable_profile": "SELECT (SELECT count(*) FROM conditions) AS n_conditions, (SELECT count(DISTINCT CODE) FROM conditions) AS n_source_codes, count(*) AS n_billable, count(DISTINCT icd10_code) AS n_icd10_codes, count(DISTINCT patient_id) AS n_patients FROM billable",
    "fanout_profile": _shape("raw", "notes_labels", "icd10_code") + " UNION ALL " + _shape("rolled", "labels3", "label_code"),
    "mapping_fanout": "SELECT n_targets, count(*) AS n_source_codes FROM (SELECT s.concept_code, count(DISTINCT i.concept_code) AS n_targets FROM concept s JOIN concept_relationship r ON s.concept_id = r.concept_id_1 AND r.relationship_id = 'Mapped from' "
    "JOIN concept i ON i.concept_id = r.concept_id_2 AND i.vocabulary_id = 'ICD10CM' WHERE s.vocabulary_id = 'SNOMED' AND s.standard_concept = 'S' GROUP BY s.concept_code) GROUP BY n_targets",
    "primary_profile": "SELECT prompt_version, substr(primary_code, 1, 3) AS family, count(*) AS n_primary, v.n_notes, v.n_distinct_primaries FROM notes_synth JOIN "
    "(SELECT prompt_version, count(*) AS n_notes, count(DISTINCT primary_code) AS n_distinct_primaries FROM notes_synth WHERE primary_code IS NOT NULL GROUP BY prompt_version) v USING (prompt_version) WHERE primary_code IS NOT NULL GROUP BY ALL",
    "model_freshness": MODEL_FRESHNESS,
    "word_tokens": "SELECT * FROM text_tokens",
    "word_ngrams": "SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM text_words GROUP BY term HAVING count(*) >= 2",
    "char_ngrams": "SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM text_chars GROUP BY term HAVING count(*) >= 2",
    "tfidf_vocab": "SELECT 'word' AS block, term, CAST(feature_id AS INT) AS feature_id, df, cf FROM text_word_vocab UNION ALL SELECT 'char', term, CAST(feature_id AS INT), df, cf FROM text_char_vocab",
    "idf_weights": "SELECT term, df, round(idf, 6) AS idf FROM text_word_vocab",
    "tfidf_rows": "SELECT note_id, CAST(feature_id AS INT) AS feature_id, round(weight, 6) AS weight FROM text_word_rows",
    "feature_union": "SELECT note_id, block, count(*) AS n_features, CAST(min(feature_id) AS INT) AS first_feature, CAST(max(feature_id) AS INT) AS last_feature, round(sum(weight), 6) AS total_weight, round(sum(weight * weight), 6) AS squared_length FROM "
    "(SELECT note_id, 'word' AS block, feature_id, weight FROM text_word_rows UNION ALL SELECT note_id, 'char', feature_id + 20000, weight FROM text_char_rows) GROUP BY note_id, block",
    "class_weights": "SELECT label_code, n AS n_positive, total - n AS n_negative, round(total / 2 / n, 6) AS weight_positive, CASE WHEN total > n THEN round(total / 2 / (total - n), 6) END AS weight_negative FROM "
    "(SELECT label_code, count(*) AS n, (SELECT count(DISTINCT note_id) FROM dev_kept_3char) AS total FROM dev_kept_3char GROUP BY label_code)",
    "fit_ovr": "SELECT label_code, n AS n_positive, total - n AS n_negative, round(total / 2 / n, 6) AS weight_positive, CASE WHEN total > n THEN round(total / 2 / (total - n), 6) END AS weight_negative, true AS is_optimal FROM "
    "(SELECT label_code, count(*) AS n, (SELECT count(DISTINCT note_id) FROM dev_kept_3char) AS total FROM dev_kept_3char GROUP BY label_code)",
    "cross_validate": _checked_folds("fold_labels", "folds"),
    "encounter_cross_validate": _checked_folds("enc_fold_labels", "enc_folds"),
    "evaluate_bucket": _checked_evaluation("test_kept_3char", "vocab"),
    "encounter_evaluate": _checked_evaluation("enc_test_kept", "enc_vocab"),
    "score_long": "SELECT note_id, code, round(y_proba, 6) AS y_proba FROM test_scored",
    "predict_default": "SELECT note_id, code, CASE WHEN y_proba > 0.5 THEN 1 ELSE 0 END AS y_pred FROM test_scored",
    "predict_threshold": "SELECT note_id, code, round(y_proba, 4) AS confidence FROM test_scored WHERE y_proba >= 0.6",
    "predict_described": "SELECT h.note_id, h.code, round(h.y_proba, 4) AS confidence, coalesce(d.description, s.default_text) AS description, s.surface FROM held_out h "
    "LEFT JOIN dictionary d ON h.code = d.code_3char CROSS JOIN (VALUES ('cli', '—'), ('service', '')) s(surface, default_text) WHERE h.y_proba >= 0.5",
    "ranked_predictions": "SELECT note_id, code, confidence, CAST(row_number() OVER (PARTITION BY note_id ORDER BY confidence DESC, code) AS INT) AS rank FROM (SELECT note_id, code, round(y_proba, 4) AS confidence FROM held_out WHERE y_proba >= 0.3)",
    "stream_latest": "SELECT patient_id, strategy, note_id FROM latest_all",
    "csv_landing": "SELECT PATIENT, ENCOUNTER, CAST(START AS VARCHAR) AS START, CAST(STOP AS VARCHAR) AS STOP, "
    "CAST(CODE AS VARCHAR) AS CODE, DESCRIPTION FROM conditions",
    "csv_quoted_lines": "SELECT PATIENT, ENCOUNTER, CAST(START AS VARCHAR) AS START, CAST(STOP AS VARCHAR) AS STOP, "
    "CAST(CODE AS VARCHAR) AS CODE, replace(DESCRIPTION, ' ', chr(10)) || '\", \"x\"' AS DESCRIPTION FROM conditions",
    "tsv_vocabulary": "SELECT * FROM concept",
    "stored_notes": "SELECT note_id, run_id, patient_id, strategy, note_text FROM notes_synth",
    "stored_after_failure": "SELECT n.note_id, n.run_id, count(l.note_id) AS n_labels FROM notes_synth n LEFT JOIN notes_labels l ON n.note_id = l.note_id "
    "WHERE substring(md5(n.note_id), 1, 1) < '8' GROUP BY n.note_id, n.run_id",
    "stored_labels": "SELECT note_id, icd10_code, is_primary FROM notes_labels",
    "notes_backup": "SELECT note_id, run_id, strategy, primary_code, input_tokens, note_text FROM notes_synth",
    "stored_split": "SELECT key, bucket FROM split",
    "stream_responses": "SELECT t.note_id, 'hashed' AS model, CAST((SELECT count(*) FROM vocab) AS INT) AS n_codes_evaluated, "
    "CAST(length(t.note_text) AS INT) AS note_length, coalesce(string_agg(s.shown, '|' ORDER BY s.confidence DESC, s.code), '') AS predictions FROM valid_texts t "
    "LEFT JOIN (SELECT a.note_id, a.code, round(a.y_proba, 4) AS confidence, a.code || ':' || CAST(CAST(round(a.y_proba, 4) AS DECIMAL(5,4)) AS VARCHAR) || ':' || "
    "coalesce(d.description, '') AS shown FROM arrived_scored a LEFT JOIN dictionary d ON a.code = d.code_3char WHERE a.y_proba >= 0.6) s "
    "ON t.note_id = s.note_id GROUP BY t.note_id, t.note_text",
    "stream_rejects": "SELECT CAST(doc_id AS VARCHAR) AS note_id, CAST(length(text) AS INT) AS note_length, "
    "CASE WHEN text IS NULL THEN 'no text' ELSE 'too short' END AS reason FROM documents WHERE text IS NULL OR length(text) < 10",
    "stream_score": "SELECT note_id, code, round(y_proba, 4) AS confidence FROM arrived_scored WHERE y_proba >= 0.6",
}


def _compose(final: str) -> str:
    needed: set[str] = set()
    waiting = [final]
    while waiting:
        text = waiting.pop()
        for name in set(re.findall(r"\w+", text)) & STEPS.keys() - needed:
            needed.add(name)
            waiting.append(STEPS[name])
    steps = ",\n".join(f"{name} AS ({sql.strip()})" for name, sql in STEPS.items() if name in needed)
    return f"WITH {steps}\n{final}" if steps else final


ORACLES: dict[str, str] = {name: _compose(final) for name, final in FINAL.items()}
