"""Guarded, schema-validated explanations of scored rows (T1-T14), as column operators.

The reference explains three rows one at a time; here every step is a column
expression over a scored table, so it runs on any number of rows:

    scored rows -> prompt text (T3) -> PII gate (T1, T2) -> responder -> raw JSON
                -> strict validation (T10) -> record or all-NULL fallback (T11)
                -> A/B comparison across temperatures (T12), result table (T13), audit (T14)

The default responder is the deterministic offline rule set (T4-T9). A caller
with a real service supplies ``responder=`` (a pandas function run through
``mapInPandas``, Arrow-batched); nothing is sent anywhere by default.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwright.functions.text import has_pii, json_strip

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's explanation contract.
# Response schema: six required keys, no others.
RESPONSE_KEYS = ["prediction_label", "confidence_level", "top_reason", "second_reason", "next_step",
                 "requires_human_review"]
CONFIDENCE_LEVELS = ["low", "medium", "high"]
# Prompt layout pieces.
PROMPT_HEADER = "Feature values:\n"
PROMPT_CLASS = "\n\nPredicted class: "
PROMPT_PROB = "\nPredicted probability for class 1: "
PROMPT_FOOTER = "\n\nExplain this prediction as JSON only."
# Offline responder patterns (probability and class read back from the prompt).
PROB_PATTERN = r"Predicted probability.*?:\s*([0-9.]+)"
CLASS_PATTERN = r"Predicted class:\s*([01])"
# ---------------------------------------------------------------------------

RESPONSE_DDL = ("prediction_label string, confidence_level string, top_reason string, second_reason string, "
                "next_step string, requires_human_review boolean")  # typed record of a valid response


@dataclass(frozen=True)
class ResponderRules:
    """Texts and cut-offs of the offline responder; defaults are the reference's fixed values."""
    positive_label: str = "above_median_price"
    negative_label: str = "below_median_price"
    top_reason: str = "Stone dimensions are the main driver of price."
    second_reason: str = "Quality grades (cut, clarity) add secondary signal."
    default_step: str = "Use standard pricing workflow."
    escalate_step: str = "Escalate to premium pricing analyst."
    review_step: str = "Route to standard catalog with QA check."
    high_cutoff: float = 0.9
    medium_cutoff: float = 0.7
    hot_temperature: float = 0.7
    review_below: float = 0.8


DEFAULT_RULES = ResponderRules()


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- T1 / T2
def pii_flag(df: DataFrame, text: str, out: str = "has_pii") -> DataFrame:
    return df.withColumn(out, has_pii(text))


def guardrail_status(pii: Column, raw: Column) -> Column:
    """'blocked' when the prompt has PII (the responder never sees it), 'failed' when no response."""
    return F.when(pii, F.lit("blocked")).when(raw.isNull(), F.lit("failed")).otherwise(F.lit("passed"))


# ---------------------------------------------------------------- T3
def python_float_text(c: str | Column) -> Column:
    """Decimal text of a double as Python prints it: plain between 1e-4 and 1e16 ('4.0', '0.0005', '20000000.0'),
    otherwise with a two-digit signed exponent ('1e-05'); NaN and infinities as json.dumps writes them."""
    s = _c(c).cast("double").cast("string")
    # the rare exponent form is a lambda: its text is built from several reads of s, which would swell the generated code
    return F.when(~s.contains("E"), s).otherwise(F.transform(F.array(s), _exponent_text)[0])


def _exponent_text(s: Column) -> Column:
    """'5.0E-4' (the shortest digits and an exponent) as Python prints it."""
    sign = F.when(s.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    digits = F.rtrim(F.regexp_replace(F.regexp_extract(s, r"^-?([0-9.]+)E", 1), r"\.", ""), F.lit("0"))
    e = F.regexp_extract(s, r"E(-?[0-9]+)$", 1).try_cast("int")
    whole = F.rpad(digits, F.greatest(e + 1, F.length(digits)), "0")
    large = F.concat(F.left(whole, e + 1), F.lit("."), F.when(F.length(whole) > e + 1, F.substring(whole, e + 2, F.lit(400))).otherwise("0"))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), F.lit(-1) - e), digits)
    power = F.concat(F.left(digits, F.lit(1)), F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substring(digits, 2, 400))).otherwise(""),
                     F.lit("e"), F.when(e < 0, "-").otherwise("+"), F.lpad(F.abs(e).cast("string"), F.greatest(F.length(F.abs(e).cast("string")), F.lit(2)), "0"))
    return F.concat(sign, F.when((e >= 0) & (e < 16), large).when((e < 0) & (e >= -4), small).otherwise(power))


def fixed4_text(p: str | Column) -> Column:
    """Probability with 4 decimals, rounded once (half up), computed in integers so every engine prints the same digits."""
    q = F.floor(_c(p).cast("double") * F.lit(1e4) + F.lit(0.5)).cast("bigint")
    return F.concat(F.floor(q / F.lit(10000)).cast("bigint").cast("string"), F.lit("."),
                    F.lpad((q % F.lit(10000)).cast("string"), 4, "0"))


def features_json(features: list[str], indent: bool) -> Column:
    """JSON object of the feature values in Python's json.dumps layout (key order kept, a missing value is null)."""
    if indent:
        items = [F.concat(F.lit(f'  "{f}": '), F.coalesce(python_float_text(f), F.lit("null"))) for f in features]
        return F.concat(F.lit("{\n"), F.concat_ws(",\n", *items), F.lit("\n}"))
    items = [F.concat(F.lit(f'"{f}": '), F.coalesce(python_float_text(f), F.lit("null"))) for f in features]
    return F.concat(F.lit("{"), F.concat_ws(", ", *items), F.lit("}"))


def render_prompt(features: list[str], pred: str | Column, prob: str | Column) -> Column:
    return F.concat(F.lit(PROMPT_HEADER), features_json(features, indent=True), F.lit(PROMPT_CLASS),
                    _c(pred).cast("int").cast("string"), F.lit(PROMPT_PROB), fixed4_text(prob), F.lit(PROMPT_FOOTER))


# ---------------------------------------------------------------- T4 - T9
def parsed_probability(prompt: str | Column) -> Column:
    """Probability read back from the prompt; 0.5 when absent or unparseable."""
    txt = F.regexp_extract(_c(prompt), PROB_PATTERN, 1)
    return F.coalesce(F.when(txt != "", txt.try_cast("double")), F.lit(0.5))


def parsed_class(prompt: str | Column, prob: Column) -> Column:
    """Class read back from the prompt; ``prob >= 0.5`` when absent."""
    txt = F.regexp_extract(_c(prompt), CLASS_PATTERN, 1)
    return F.when(txt != "", txt.cast("int")).otherwise((prob >= 0.5).cast("int"))


def confidence_tier(prob: Column, rules: ResponderRules = DEFAULT_RULES) -> Column:
    return (F.when(prob >= rules.high_cutoff, F.lit("high"))
            .when(prob >= rules.medium_cutoff, F.lit("medium")).otherwise(F.lit("low")))


def next_step(pred: Column, temperature: float | Column, rules: ResponderRules = DEFAULT_RULES) -> Column:
    t = temperature if isinstance(temperature, Column) else F.lit(float(temperature))
    hot = t >= rules.hot_temperature
    return (F.when(hot & (pred == 1), F.lit(rules.escalate_step))
            .when(hot, F.lit(rules.review_step)).otherwise(F.lit(rules.default_step)))


def review_flag(pred: Column, prob: Column, rules: ResponderRules = DEFAULT_RULES) -> Column:
    return (pred == 1) & (prob < rules.review_below)


def label_name(pred: Column, rules: ResponderRules = DEFAULT_RULES) -> Column:
    return F.when(pred == 1, F.lit(rules.positive_label)).otherwise(F.lit(rules.negative_label))


def _q(s: Column) -> Column:
    return F.concat(F.lit('"'), s, F.lit('"'))


def response_json(label: Column, tier: Column, step: Column, review: Column,
                  rules: ResponderRules = DEFAULT_RULES) -> Column:
    """The six-field response in Python json.dumps layout (', ' and ': ' separators).

    The field texts are plain (no quotes or escapes), so concatenation is exact."""
    parts = [(RESPONSE_KEYS[0], _q(label)), (RESPONSE_KEYS[1], _q(tier)), (RESPONSE_KEYS[2], _q(F.lit(rules.top_reason))),
             (RESPONSE_KEYS[3], _q(F.lit(rules.second_reason))), (RESPONSE_KEYS[4], _q(step)),
             (RESPONSE_KEYS[5], F.when(review, F.lit("true")).otherwise(F.lit("false")))]
    return F.concat(F.lit("{"), F.concat_ws(", ", *[F.concat(F.lit(f'"{k}": '), v) for k, v in parts]), F.lit("}"))


def offline_response(prompt: str | Column, temperature: float | Column,
                     rules: ResponderRules = DEFAULT_RULES) -> Column:
    """Deterministic responder: reads probability and class back from the prompt (T4) and applies T5-T9."""
    prob = parsed_probability(prompt)
    pred = parsed_class(prompt, prob)
    return response_json(label_name(pred, rules), confidence_tier(prob, rules), next_step(pred, temperature, rules),
                         review_flag(pred, prob, rules), rules)


def respond(df: DataFrame, prompt: str, temperature: float, out: str, rules: ResponderRules = DEFAULT_RULES,
            responder=None, pii_col: str | None = None, system_prompt: str = "") -> DataFrame:
    """Gate then respond: blocked prompts get a NULL response and never reach the responder.

    Adds ``out`` (raw text) and ``{out}_status``. ``pii_col`` names an existing PII flag for
    the prompt (see ``pii_flag``) so several temperatures share one regex scan.
    ``responder``: optional ``fn(system_prompt, prompts: pandas.Series, temperature) -> pandas.Series`` of
    raw text (NULL on failure), run per Arrow batch with ``mapInPandas``; the offline rules need no system prompt.
    """
    flag = pii_col or f"{out}_pii"
    gated = df if pii_col else df.withColumn(flag, has_pii(prompt))
    if responder is None:
        # Parse once into columns: inside CASE branches each reference would re-run the regex.
        parsed = gated.withColumn("__prob", parsed_probability(F.col(prompt)))
        parsed = parsed.withColumn("__cls", parsed_class(F.col(prompt), F.col("__prob")))
        p, c = F.col("__prob"), F.col("__cls")
        body = response_json(label_name(c, rules), confidence_tier(p, rules), next_step(c, temperature, rules),
                             review_flag(c, p, rules), rules)
        gated = parsed.withColumn(out, F.when(~F.col(flag), body)).drop("__prob", "__cls")
    else:
        schema = T.StructType(list(gated.schema.fields) + [T.StructField(out, T.StringType(), True)])

        def run(batches):
            for pdf in batches:
                allowed = ~pdf[flag].astype(bool)
                pdf[out] = None
                if allowed.any():
                    pdf.loc[allowed, out] = list(responder(system_prompt, pdf.loc[allowed, prompt], temperature))
                yield pdf
        gated = gated.mapInPandas(run, schema)
    gated = gated.withColumn(f"{out}_status", guardrail_status(F.col(flag), F.col(out)))
    return gated if pii_col else gated.drop(flag)


# ---------------------------------------------------------------- T10 / T11
# Variant schema of a valid response: an object with exactly these keys (the variant
# format keeps object keys sorted) and these value types.
EXPECTED_VARIANT_SCHEMA = "OBJECT<" + ", ".join(
    f"{k}: {'BOOLEAN' if k == 'requires_human_review' else 'STRING'}" for k in sorted(RESPONSE_KEYS)) + ">"


# The variant parser ignores text after a complete top-level value, so a response like
# '{...}]' could close a plain '[...]' wrapper early. A sentinel element after the text
# detects that: the parse must yield exactly [value, sentinel].
_SENTINEL = "#end-of-response#"


def _wrapped(raw: Column) -> Column:
    """The trimmed text parsed once, as the first element of ``[text, sentinel]``."""
    return F.try_parse_json(F.concat(F.lit("["), json_strip(raw), F.lit(f',"{_SENTINEL}"]')))


def validation_error(raw: str | Column, parsed: Column | None = None) -> Column:
    """NULL when valid, else 'no_response', 'json_error' or 'schema_error' (strict schema).

    ONE parse per response: the trimmed text wrapped as ``[text, sentinel]`` must parse
    to exactly those two elements, which rejects trailing text, early-closing brackets
    and second values that a bare parse would accept. The element's variant schema must then equal the expected
    object schema (exact key set and types), and the tier must be in the enum.
    ``parsed`` is the column that holds the parse already (see ``parse_and_validate``).
    """
    r = _c(raw)
    w = _wrapped(r) if parsed is None else parsed
    syntax_ok = (w.isNotNull() & (F.size(F.variant_get(w, "$", "array<variant>")) == 2)
                 & (F.variant_get(w, "$[1]", "string") == _SENTINEL))
    v = F.variant_get(w, "$[0]", "variant")
    schema_ok = (F.schema_of_variant(v) == EXPECTED_VARIANT_SCHEMA) & \
        F.variant_get(v, "$.confidence_level", "string").isin(*CONFIDENCE_LEVELS)
    return (F.when(r.isNull(), F.lit("no_response"))
            .when(~F.coalesce(syntax_ok, F.lit(False)), F.lit("json_error"))
            .when(~F.coalesce(schema_ok, F.lit(False)), F.lit("schema_error")))


def parse_and_validate(df: DataFrame, raw: str, prefix: str = "") -> DataFrame:
    """Adds ``{prefix}valid``, ``{prefix}error`` and the six typed fields, all NULL unless valid.

    The fields are read from the same parsed variant (no second parse)."""
    out = df.withColumn("__w", _wrapped(F.col(raw)))
    out = out.withColumn(f"{prefix}error", validation_error(raw, F.col("__w"))).withColumn(f"{prefix}valid", F.col(f"{prefix}error").isNull())
    fields = {}
    for k in RESPONSE_KEYS:
        t = "boolean" if k == "requires_human_review" else "string"
        fields[f"{prefix}{k}"] = F.when(F.col(f"{prefix}valid"), F.variant_get(F.col("__w"), f"$[0].{k}", t))
    return out.withColumns(fields).drop("__w")


# ---------------------------------------------------------------- T12 / T14
def ab_compare(df: DataFrame, raw_a: str, raw_b: str) -> DataFrame:
    """Validity of both responses, whether their content differs, and each next step."""
    a = parse_and_validate(df, raw_a, "a_")
    b = parse_and_validate(a, raw_b, "b_")
    ta, tb = F.btrim(F.col(raw_a)), F.btrim(F.col(raw_b))
    differs = (F.coalesce(F.col(raw_a), F.lit("")) != "") & (F.coalesce(F.col(raw_b), F.lit("")) != "") & (ta != tb)
    return b.withColumn("key_diff", F.when(F.coalesce(differs, F.lit(False)), F.lit("content varies"))
                        .otherwise(F.lit("no difference")))


def guardrail_audit(df: DataFrame, status: str, error: str) -> DataFrame:
    """Counts by (status, error class)."""
    return df.groupBy(status, error).agg(F.count(F.lit(1)).alias("n"))
