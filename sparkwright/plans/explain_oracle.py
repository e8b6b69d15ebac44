"""DuckDB twins of the explanation queries."""

from sparkwright.functions.text import EMAIL_PATTERN, PHONE_PATTERN
from sparkwright.operators.explain import DEFAULT_RULES as _R
from sparkwright.plans.fixtures import EXPLAIN_INPUT_SQL, LINEITEM_FEATURES_SQL

_FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "rf_code", "ls_code"]
_NL = "chr(10)"


def _pii(col):
    return f"(regexp_matches({col}, '{EMAIL_PATTERN}') OR regexp_matches({col}, '{PHONE_PATTERN}'))"


_FEATS_INDENT = (f"'{{' || {_NL} || " + f" || ',' || {_NL} || ".join(
    f"'  \"{f}\": ' || CAST({f} AS VARCHAR)" for f in _FEATS) + f" || {_NL} || '}}'")
_FEATS_FLAT = "'{' || " + " || ', ' || ".join(f"'\"{f}\": ' || CAST({f} AS VARCHAR)" for f in _FEATS) + " || '}'"
_FIXED4 = ("CAST(floor(floor(prob * 1e4 + 0.5) / 10000)::BIGINT AS VARCHAR) || '.' || "
           "lpad(CAST(floor(prob * 1e4 + 0.5)::BIGINT % 10000 AS VARCHAR), 4, '0')")
_PROMPT = (f"'Feature values:' || {_NL} || {_FEATS_INDENT} || {_NL} || {_NL} || 'Predicted class: ' || CAST(pred AS VARCHAR)"
           f" || {_NL} || 'Predicted probability for class 1: ' || {_FIXED4} || {_NL} || {_NL} || "
           "'Explain this prediction as JSON only.'")


def _prob(p):
    return (f"coalesce(CASE WHEN regexp_extract({p}, 'Predicted probability.*?:\\s*([0-9.]+)', 1) <> '' "
            f"THEN TRY_CAST(regexp_extract({p}, 'Predicted probability.*?:\\s*([0-9.]+)', 1) AS DOUBLE) END, 0.5::DOUBLE)")


def _cls(p):
    return (f"CASE WHEN regexp_extract({p}, 'Predicted class:\\s*([01])', 1) <> '' "
            f"THEN CAST(regexp_extract({p}, 'Predicted class:\\s*([01])', 1) AS INTEGER) "
            f"ELSE CAST({_prob(p)} >= 0.5 AS INTEGER) END")


def _tier(prob):
    return f"CASE WHEN {prob} >= 0.9 THEN 'high' WHEN {prob} >= 0.7 THEN 'medium' ELSE 'low' END"


def _step(cls, t):
    if t >= 0.7:
        return f"CASE WHEN {cls} = 1 THEN '{_R.escalate_step}' ELSE '{_R.review_step}' END"
    return f"'{_R.default_step}'"


def _label(cls):
    return f"CASE WHEN {cls} = 1 THEN '{_R.positive_label}' ELSE '{_R.negative_label}' END"


def _review(cls, prob):
    return f"({cls} = 1 AND {prob} < 0.8)"


def _response(p, t):
    prob, cls = _prob(p), _cls(p)
    return ("'{\"prediction_label\": \"' || " + _label(cls) + " || '\", \"confidence_level\": \"' || " + _tier(prob)
            + f" || '\", \"top_reason\": \"{_R.top_reason}\", \"second_reason\": \"{_R.second_reason}\", \"next_step\": \"' || "
            + _step(cls, t) + " || '\", \"requires_human_review\": ' || CASE WHEN " + _review(cls, prob)
            + " THEN 'true' ELSE 'false' END || '}'")


def _gated(p, t):
    return f"CASE WHEN NOT {_pii(p)} THEN {_response(p, t)} END"


_KEYS = ["confidence_level", "next_step", "prediction_label", "requires_human_review", "second_reason", "top_reason"]


def _error(raw):
    s = f"trim({raw}, ' ' || chr(10) || chr(9) || chr(13))"
    keys = "[" + ", ".join(f"'{k}'" for k in _KEYS) + "]"
    types = " AND ".join(
        f"coalesce(json_type({s}, '$.{k}'), '') = '{'BOOLEAN' if k == 'requires_human_review' else 'VARCHAR'}'"
        for k in _KEYS)
    return (f"CASE WHEN {raw} IS NULL THEN 'no_response' WHEN NOT coalesce(json_valid({s}), false) THEN 'json_error' "
            f"WHEN NOT coalesce(json_type({s}) = 'OBJECT' AND list_sort(json_keys({s})) = {keys} AND {types} "
            f"AND json_extract_string({s}, '$.confidence_level') IN ('low', 'medium', 'high'), false) THEN 'schema_error' END")


_RESP = EXPLAIN_INPUT_SQL + f""",
pp AS (SELECT *, {_PROMPT} AS prompt FROM ei),
rs AS (SELECT *, {_gated('prompt', 0.0)} AS raw_t0, {_gated('prompt', 0.7)} AS raw_t07,
              CASE WHEN {_pii('prompt')} THEN 'blocked' ELSE 'passed' END AS status FROM pp)"""

_UNION = _RESP + """,
ru AS (SELECT 'response' AS source, row_key AS id, raw_t0 AS raw FROM rs
       UNION ALL SELECT 'event_props', CAST(event_id AS VARCHAR), props FROM events
       UNION ALL SELECT 'conversation', conv_id || '|' || turn, text FROM conversations)"""

SQL = {
    "t1_pii_documents": f"SELECT doc_id, {_pii('text')} AS has_pii FROM documents",
    "t1_pii_conversations": f"SELECT conv_id, turn, {_pii('text')} AS has_pii FROM conversations",
    "t2_guardrail_status": f"SELECT doc_id, CASE WHEN {_pii('text')} THEN 'blocked' ELSE 'passed' END AS status FROM documents",
    "t3_prompt": f"WITH {EXPLAIN_INPUT_SQL} SELECT row_key, {_PROMPT} AS prompt FROM ei",
    "t3_prompt_edges": f"""WITH {LINEITEM_FEATURES_SQL}, ei AS (
            SELECT row_key, nullif(l_discount, 0) AS l_discount, l_tax / 100 AS l_tax, l_extendedprice * 1000 AS l_extendedprice,
                   l_quantity * 1e15 AS l_quantity, l_tax / 1e6 AS rf_code, -l_extendedprice * 1e9 AS ls_code,
                   1 / (1 + exp(-(l_extendedprice - 36000.0) / 9000.0)) AS prob, label AS pred FROM lf WHERE is_test)
        SELECT row_key, {_PROMPT.replace("|| CAST(l_discount AS VARCHAR)", "|| coalesce(CAST(l_discount AS VARCHAR), 'null')")} AS prompt FROM ei""",
    "t4_extract": f"WITH {_RESP} SELECT row_key, {_prob('prompt')} AS prob_parsed, {_cls('prompt')} AS class_parsed FROM pp",
    "t5_confidence_tier": f"WITH {_RESP} SELECT row_key, {_prob('prompt')} AS prob_parsed, {_tier(_prob('prompt'))} AS tier FROM pp",
    "t6_next_step": f"WITH {_RESP} SELECT row_key, {_step(_cls('prompt'), 0.0)} AS next_step_t0, "
                    f"{_step(_cls('prompt'), 0.7)} AS next_step_t07 FROM pp",
    "t7_review_flag": f"WITH {_RESP} SELECT row_key, {_review(_cls('prompt'), _prob('prompt'))} AS requires_review FROM pp",
    "t8_label_name": f"WITH {_RESP} SELECT row_key, {_label(_cls('prompt'))} AS prediction_label FROM pp",
    "t9_response_json": f"WITH {_RESP} SELECT row_key, raw_t0, raw_t07 FROM rs",
    "t10_validate": f"WITH {_UNION} SELECT source, id, ({_error('raw')}) IS NULL AS valid, {_error('raw')} AS error FROM ru",
    "t11_fallback_record": f"WITH {_UNION} SELECT source, id, " + ", ".join(
        f"CASE WHEN ({_error('raw')}) IS NULL THEN "
        + (f"CAST(json_extract(raw, '$.{k}') AS BOOLEAN)" if k == "requires_human_review"
           else f"json_extract_string(raw, '$.{k}')") + f" END AS {k}" for k in _KEYS) + " FROM ru",
    "t12_ab_compare": f"""WITH {_RESP} SELECT row_key, ({_error('raw_t0')}) IS NULL AS valid_temp0,
        ({_error('raw_t07')}) IS NULL AS valid_temp07,
        CASE WHEN coalesce(raw_t0, '') <> '' AND coalesce(raw_t07, '') <> '' AND trim(raw_t0) <> trim(raw_t07)
             THEN 'content varies' ELSE 'no difference' END AS key_diff,
        CASE WHEN ({_error('raw_t0')}) IS NULL THEN json_extract_string(raw_t0, '$.next_step') END AS next_step_t0,
        CASE WHEN ({_error('raw_t07')}) IS NULL THEN json_extract_string(raw_t07, '$.next_step') END AS next_step_t07
        FROM rs""",
    "t13_result_table": f"""WITH {_RESP} SELECT row_key, {_FEATS_FLAT} AS features, pred AS pred_class, prob, raw_t0,
        ({_error('raw_t0')}) IS NULL AS valid_temp0, status AS guardrail FROM rs""",
    "t14_guardrail_audit": f"""WITH r AS (SELECT CASE WHEN {_pii('text')} THEN 'blocked' ELSE 'passed' END AS status,
                                            {_gated('text', 0.0)} AS raw FROM documents)
        SELECT status, {_error('raw')} AS error, count(*) AS n FROM r GROUP BY ALL""",
}
