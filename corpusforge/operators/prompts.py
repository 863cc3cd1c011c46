"""Prompt rendering as column expressions.

A template is split once, on the driver, into literal pieces and ``{identifier}``
placeholders and becomes a single ``concat`` - no Python per row.  Braces that do not
enclose an identifier are literal text (so JSON examples inside a template just work);
an identifier that names no column is an error at plan time, not at run time.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLACEHOLDER = re.compile(r"\{([A-Za-z_][A-Za-z0-9_]*)\}")

# Fixed text of the default judge prompt.
JUDGE_PREAMBLE = "Judge the following example and respond with JSON only that matches the schema:\n"

BOOL_KNOBS = ["cta_present", "has_explicit_humility_phrase", "story_claims_verifiable"]
INT_KNOBS = ["emoji_count", "cliche_count", "buzzword_count", "seed"]


def placeholders(template: str) -> list[str]:
    return _PLACEHOLDER.findall(template)


def render(template: str, columns: list[str], values: dict[str, Column] | None = None) -> Column:
    """``concat`` of the template's literal parts and its placeholder columns (NULL -> '')."""
    values = values or {}
    parts: list[Column] = []
    pos = 0
    for m in _PLACEHOLDER.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        name = m.group(1)
        if name in values:
            c = values[name]
        elif name in columns:
            c = F.col(name)
        else:
            raise KeyError(f"template placeholder {{{name}}} has no column")
        parts.append(F.coalesce(c.cast("string"), F.lit("")))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts) if parts else F.lit("")


def _ascii_json(text: Column) -> Column:
    """JSON string literal in ASCII: characters beyond it (and DEL) as ``\\uXXXX`` code units."""
    def shown(c: Column) -> Column:
        units = F.hex(F.encode(c, "UTF-16BE"))
        wide = F.concat(F.lit("\\u"), F.lower(F.substring(units, 1, 4)),
                        F.when(F.length(units) > 4, F.concat(F.lit("\\u"), F.lower(F.substring(units, 5, 4))))
                        .otherwise(F.lit("")))
        return F.when(c.rlike(r"^[ -~]$"), c).otherwise(wide)
    # to_json escapes quotes, backslashes and control characters; its list brackets are cut off
    quoted = F.to_json(F.array(text))
    inner = F.substring(quoted, 2, 1 << 30)
    inner = F.substring(inner, F.lit(1), F.length(inner) - 1)
    return F.array_join(F.transform(F.split(inner, ""), shown), "")


def json_string_array(arr: Column) -> Column:
    """Python ``json.dumps(list_of_str)`` text: ``["a", "b"]`` (ASCII, ", " separator)."""
    return F.concat(F.lit("["), F.array_join(F.transform(arr, _ascii_json), ", "), F.lit("]"))


def _json_literal(text: Column) -> Column:
    """A string as a JSON literal, characters beyond ASCII as they are."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def spaced_json(value: Column, kind: T.DataType) -> Column:
    """JSON text of a column with ``", "`` and ``": "`` between the items, nulls kept."""
    if isinstance(kind, T.StructType):
        fields = [F.concat(F.lit(json.dumps(f.name, ensure_ascii=False) + ": "), spaced_json(value.getField(f.name), f.dataType))
                  for f in kind.fields]
        text = F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))
    elif isinstance(kind, T.ArrayType):
        text = F.concat(F.lit("["), F.array_join(F.transform(value, lambda x: spaced_json(x, kind.elementType)), ", "), F.lit("]"))
    elif isinstance(kind, T.MapType):
        pairs = F.transform(F.map_entries(value), lambda e: F.concat(
            _json_literal(e["key"].cast("string")), F.lit(": "), spaced_json(e["value"], kind.valueType)))
        text = F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))
    elif isinstance(kind, T.StringType):
        text = _json_literal(value)
    else:
        text = value.cast("string")
    return F.when(value.isNull(), F.lit("null")).otherwise(text)


def prompt_values(plan: DataFrame) -> DataFrame:
    """Booleans -> "true"/"false", counters -> integers, hashtags -> JSON text, NULL -> ""."""
    cols = []
    for f in plan.schema.fields:
        c = F.col(f.name)
        if f.name in BOOL_KNOBS:
            c = F.when(c.cast("boolean"), "true").otherwise("false")
        elif f.name in INT_KNOBS:
            c = c.cast("bigint")
        elif f.name == "hashtags":
            c = json_string_array(F.coalesce(c, F.array().cast("array<string>")))
        elif isinstance(f.dataType, T.StringType):
            c = F.coalesce(c, F.lit(""))
        cols.append(c.alias(f.name))
    return plan.select(*cols)


def judge_prompt(df: DataFrame, template: str | None = None, text_col: str = "text") -> Column:
    """Template over text / example / json / every field, or the default preamble +
    text (the row as JSON when the text is empty)."""
    row_json = spaced_json(F.struct(*[F.col(c) for c in df.columns]), df.schema)
    if template:
        values = {"text": F.coalesce(F.col(text_col), F.lit("")) if text_col in df.columns else F.lit(""),
                  "example": row_json, "json": row_json}
        for f in df.schema.fields:
            if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
                values[f.name] = spaced_json(F.col(f.name), f.dataType)
        return render(template, df.columns, values)
    text = F.col(text_col) if text_col in df.columns else F.lit(None).cast("string")
    body = F.when(text.isNotNull() & (text != ""), text).otherwise(row_json)
    return F.concat(F.lit(JUDGE_PREAMBLE), body)


def pair_prompt(pairs: DataFrame, template: str | None = None, context: list[str] = ()) -> Column:
    """G12 for a comparison: candidates, label and the named columns as ``context_<name>``, rendered
    by the template or as the payload's JSON under the default preamble."""
    payload = pairs.select("candidate_a", "candidate_b", "label", *[F.col(c).alias(f"context_{c}") for c in context])
    if template:
        return render(template, payload.columns, {f"context_{c}": F.col(c) for c in context} | {
            c: spaced_json(F.col(c), payload.schema[c].dataType) for c in ("candidate_a", "candidate_b")
            if not isinstance(payload.schema[c].dataType, T.StringType)})
    whole = F.struct("candidate_a", "candidate_b", "label", *[F.col(c).alias(f"context_{c}") for c in context])
    return F.concat(F.lit(JUDGE_PREAMBLE), spaced_json(whole, payload.schema))
