"""JSON-Schema -> one boolean Column (V1, V2, V4), or the list of broken rules (V3).

The schema is compiled on the driver into a tree of Spark expressions over a VARIANT
value (``try_parse_json`` of the raw JSON text), so validation is a plain ``filter``.
Missing keys and JSON nulls stay distinguishable: ``variant_get`` yields SQL NULL for an
absent key, and a JSON null is a variant whose type is ``VOID``.
Supported keywords: type, required, properties, additionalProperties (false), minLength,
maxLength, minimum, maximum, exclusiveMinimum, exclusiveMaximum, enum, const, pattern,
maxItems, minItems, items; annotations are skipped and any other keyword raises at plan time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_KEYWORDS = frozenset("type required properties additionalProperties minLength maxLength minimum maximum "
                      "exclusiveMinimum exclusiveMaximum enum const pattern maxItems minItems items".split())
_ANNOTATIONS = frozenset("$schema $id $comment title description default examples".split())
_NUMERIC = ("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE", "DECIMAL")


def check_schema(schema: dict) -> None:
    """V4: a response schema must declare ``type`` and ``properties``."""
    if not isinstance(schema, dict) or "type" not in schema or "properties" not in schema:
        raise ValueError("Schema must define 'type' and 'properties'")


def _all(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def _vtype(v: Column) -> Column:
    return F.schema_of_variant(v)


def _is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def _equals(v: Column, x) -> Column:
    """Whether a variant equals a JSON scalar; numbers compare by value, true is not 1."""
    ty = _vtype(v)
    if x is None:
        return ty == "VOID"
    if isinstance(x, bool):
        return (ty == "BOOLEAN") & (F.try_variant_get(v, "$", "boolean") == x)
    if isinstance(x, str):
        return (ty == "STRING") & (F.try_variant_get(v, "$", "string") == x)
    if isinstance(x, (int, float)):
        return reduce(lambda a, b: a | b, [ty.startswith(n) for n in _NUMERIC]) & (
            F.try_variant_get(v, "$", "double") == float(x))
    raise ValueError("enum and const support scalars only")


def _type_ok(t: str, v: Column) -> Column:
    if t == "object":
        return _is_object(v)
    if t == "array":
        return F.try_variant_get(v, "$", "array<variant>").isNotNull()
    ty = _vtype(v)
    if t == "string":
        return ty == "STRING"
    if t == "boolean":
        return ty == "BOOLEAN"
    if t == "null":
        return ty == "VOID"
    numeric = reduce(lambda a, b: a | b, [ty.startswith(n) for n in _NUMERIC])
    if t == "number":
        return numeric
    if t == "integer":   # 5.0 is an integer, true is not
        d = F.try_variant_get(v, "$", "double")
        return numeric & d.isNotNull() & (d == F.floor(d))
    raise ValueError(f"unsupported JSON type {t!r}")


def _key_path(k: str) -> str:
    return "$['" + k.replace("\\", "\\\\").replace("'", "\\'") + "']"


def _check_keywords(schema: dict) -> None:
    unknown = set(schema) - _KEYWORDS - _ANNOTATIONS
    if unknown or schema.get("additionalProperties") not in (None, True, False):
        raise ValueError(f"unsupported schema keywords: {sorted(unknown) or ['additionalProperties']}")


def _own_rules(schema: dict, v: Column) -> list[tuple[str, Column]]:
    """``(keyword, holds)`` for the keywords that concern a value itself, not its parts."""
    _check_keywords(schema)
    rules: list[tuple[str, Column]] = []
    t = schema.get("type")
    if t is not None:
        types = t if isinstance(t, list) else [t]
        rules.append(("type", reduce(lambda a, b: a | b, [_type_ok(x, v) for x in types])))
    if "enum" in schema:
        rules.append(("enum", reduce(lambda a, b: a | b, [_equals(v, x) for x in schema["enum"]], F.lit(False))))
    if "const" in schema:
        rules.append(("const", _equals(v, schema["const"])))
    s = F.try_variant_get(v, "$", "string")
    if "minLength" in schema:
        rules.append(("minLength", (_vtype(v) != "STRING") | (F.length(s) >= schema["minLength"])))
    if "maxLength" in schema:
        rules.append(("maxLength", (_vtype(v) != "STRING") | (F.length(s) <= schema["maxLength"])))
    if "pattern" in schema:
        rules.append(("pattern", (_vtype(v) != "STRING") | s.rlike(schema["pattern"])))
    d = F.try_variant_get(v, "$", "double")
    for name, holds in (("exclusiveMinimum", lambda x: d > x), ("exclusiveMaximum", lambda x: d < x),
                        ("minimum", lambda x: d >= x), ("maximum", lambda x: d <= x)):
        if name in schema:
            rules.append((name, d.isNull() | (_vtype(v) == "BOOLEAN") | holds(F.lit(float(schema[name])))))
    arr = F.try_variant_get(v, "$", "array<variant>")
    if "maxItems" in schema:
        rules.append(("maxItems", arr.isNull() | (F.size(arr) <= schema["maxItems"])))
    if "minItems" in schema:
        rules.append(("minItems", arr.isNull() | (F.size(arr) >= schema["minItems"])))
    return rules


def _extra_keys(schema: dict, v: Column) -> Column:
    keys = F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))
    return F.array_except(keys, F.array(*[F.lit(k) for k in (schema.get("properties") or {})]))


def _has_object_rules(schema: dict) -> bool:
    return isinstance(schema.get("properties"), dict) or "required" in schema or schema.get("additionalProperties") is False


def compile_value(schema: dict, v: Column) -> Column:
    """Validity of a present (non-SQL-NULL) variant value against ``schema``."""
    conds = [holds for _, holds in _own_rules(schema, v)]
    arr = F.try_variant_get(v, "$", "array<variant>")
    if isinstance(schema.get("items"), dict):
        item_schema = schema["items"]
        conds.append(arr.isNull() | F.forall(arr, lambda x: compile_value(item_schema, x)))
    if _has_object_rules(schema):
        obj_conds = []
        for k in schema.get("required", []):
            obj_conds.append(F.variant_get(v, _key_path(k), "variant").isNotNull())
        for k, sub in (schema.get("properties") or {}).items():
            child = F.try_variant_get(v, _key_path(k), "variant")
            obj_conds.append(child.isNull() | compile_value(sub, child))
        if schema.get("additionalProperties") is False:
            obj_conds.append(F.size(_extra_keys(schema, v)) == 0)
        conds.append(~_is_object(v) | _all(obj_conds))
    return _all(conds)


VIOLATIONS = "array<struct<path:string,rule:string>>"


def _violation(path: Column, rule: str) -> Column:
    return F.struct(path.alias("path"), F.lit(rule).alias("rule"))


def _list(violations: list[Column]) -> Column:
    return F.concat(*violations) if violations else F.array().cast(VIOLATIONS)


def value_violations(schema: dict, v: Column, path: Column) -> Column:
    """Every rule of ``schema`` that a present variant value breaks: ``array<struct<path, rule>>``.

    ``path`` is ``$`` for the whole, ``$.key`` and ``$.key[0]`` for parts.  A missing required key
    and a key too many are reported at their own path.  A value of the wrong type breaks ``type``;
    its other rules speak of the right type and are not broken by it.
    """
    none = F.array().cast(VIOLATIONS)
    out = [F.when(F.coalesce(holds, F.lit(False)), none).otherwise(F.array(_violation(path, rule)))
           for rule, holds in _own_rules(schema, v)]
    if isinstance(schema.get("items"), dict):
        item_schema = schema["items"]
        arr = F.try_variant_get(v, "$", "array<variant>")
        each = F.transform(arr, lambda x, i: value_violations(
            item_schema, x, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
        out.append(F.coalesce(F.flatten(each), none))
    if _has_object_rules(schema):
        here = lambda k: F.concat(path, F.lit("."), k if isinstance(k, Column) else F.lit(k))
        of_object = []
        for k in schema.get("required", []):
            of_object.append(F.when(F.variant_get(v, _key_path(k), "variant").isNull(), F.array(_violation(here(k), "required")))
                             .otherwise(none))
        for k, sub in (schema.get("properties") or {}).items():
            child = F.try_variant_get(v, _key_path(k), "variant")
            of_object.append(F.when(child.isNotNull(), value_violations(sub, child, here(k))).otherwise(none))
        if schema.get("additionalProperties") is False:
            of_object.append(F.coalesce(F.transform(F.array_sort(_extra_keys(schema, v)),
                                                    lambda k: _violation(here(k), "additionalProperties")), none))
        out.append(F.when(_is_object(v), _list(of_object)).otherwise(none))
    return _list(out)


def compile_violations(schema: dict, raw: Column) -> Column:
    """The rules that the JSON text ``raw`` breaks (none: valid); a text that doesn't parse breaks ``json``."""
    v = F.try_parse_json(raw)
    return F.when(v.isNull(), F.array(_violation(F.lit("$"), "json"))).otherwise(value_violations(schema, v, F.lit("$")))


def compile_schema(schema: dict, raw: Column) -> Column:
    """True iff the JSON text ``raw`` parses and satisfies ``schema`` (never NULL)."""
    v = F.try_parse_json(raw)
    return F.coalesce(v.isNotNull() & compile_value(schema, v), F.lit(False))
