"""JSON Schema compiled to Column predicates, quarantine, inference and versions."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KINDS = {"string": ("STRING",), "integer": ("BIGINT",), "number": ("BIGINT", "DOUBLE", "DECIMAL", "FLOAT"), "boolean": ("BOOLEAN",), "array": ("ARRAY",), "object": ("OBJECT",), "null": ("VOID",)}
_FORMATS = {"uri": r"^[A-Za-z][A-Za-z0-9+.-]*:\S+$", "date-time": r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}", "date": r"^\d{4}-\d{2}-\d{2}$", "email": r"^\S+@\S+$"}
#: Keywords that would change what is valid and are not compiled; a schema that has one is refused.
_REFUSED = {"if", "then", "else", "dependentSchemas", "dependentRequired", "unevaluatedItems", "unevaluatedProperties", "contains", "prefixItems", "$dynamicRef"}


def _is(kind: Column, *names: str) -> Column:
    return reduce(lambda a, b: a | b, [kind.startswith(n) for name in names for n in _KINDS[name]])


def _number(x: Column) -> Column:
    return F.try_variant_get(x, "$", "double")


def _equals(x: Column, kind: Column, value: object) -> Column:
    """Whether a variant equals a JSON value: 1 and 1.0 are equal, 1, "1" and true are not."""
    if value is None:
        return _is(kind, "null")
    if isinstance(value, bool):
        return _is(kind, "boolean") & (F.try_variant_get(x, "$", "boolean") == value)
    if isinstance(value, (int, float)):
        return _is(kind, "number") & (_number(x) == float(value))
    if isinstance(value, str):
        return _is(kind, "string") & (F.try_variant_get(x, "$", "string") == value)
    return F.to_json(x) == json.dumps(value, sort_keys=True, separators=(",", ":"))


class _Compiler:
    """A schema as one Column: the first violation of a variant as text, or null. Violations come in the order of the schema's
    keywords, depth first; those of array items by index, those of other properties by key."""

    def __init__(self, root: dict, formats: bool):
        self.root, self.formats = root, formats

    def _of_ref(self, ref: str, seen: tuple[str, ...]) -> dict:
        if ref in seen:
            raise ValueError(f"{ref} refers to itself")
        return reduce(lambda at, part: at[part.replace("~1", "/").replace("~0", "~")], [p for p in ref.lstrip("#").split("/") if p], self.root)

    def check(self, x: Column, path: list[Column], spec: dict | bool, seen: tuple[str, ...] = ()) -> Column:
        if isinstance(spec, bool):
            return F.lit(None).cast("string") if spec else self._error(path, "is not allowed")
        # value and kind are worked out once for all keywords
        node = F.array(F.struct(x.alias("x"), F.schema_of_variant(x).alias("kind")))
        return F.get(F.transform(node, lambda n: self._keywords(n["x"], n["kind"], path, spec, seen)), 0)

    @staticmethod
    def _error(path: list[Column], message: str | Column) -> Column:
        at = F.concat(*(p for part in path for p in (F.lit("/"), part))) if path else F.lit("<root>")
        return F.concat(at, F.lit(": "), F.lit(message) if isinstance(message, str) else message)

    def _keywords(self, x: Column, kind: Column, path: list[Column], spec: dict, seen: tuple[str, ...]) -> Column:
        found = []
        for word, value in spec.items():
            if word in _REFUSED:
                raise ValueError(f"a schema with {word} can't be checked")
            if (rule := getattr(self, "_on_" + word.lstrip("$"), None)) and word != "$defs":
                found += rule(x, kind, path, value, spec, seen)
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    def _when(self, bad: Column, path: list[Column], message: str | Column) -> list[Column]:
        return [F.when(F.coalesce(bad, F.lit(False)), self._error(path, message))]

    def _on_ref(self, x, kind, path, value, spec, seen):
        return [self._keywords(x, kind, path, self._of_ref(value, seen), (*seen, value))]

    def _on_type(self, x, kind, path, value, spec, seen):
        kinds = [value] if isinstance(value, str) else value
        right = _is(kind, *kinds)
        if "integer" in kinds:
            right |= _is(kind, "number") & (_number(x) == F.floor(_number(x)))
        return self._when(~right, path, f"is not of type {' or '.join(kinds)}")

    def _on_enum(self, x, kind, path, value, spec, seen):
        return self._when(~reduce(lambda a, b: a | b, [_equals(x, kind, v) for v in value], F.lit(False)), path, "is not one of the allowed values")

    def _on_const(self, x, kind, path, value, spec, seen):
        return self._when(~_equals(x, kind, value), path, "is not the allowed value")

    def _on_minimum(self, x, kind, path, value, spec, seen):
        return self._when(_is(kind, "number") & (_number(x) < float(value)), path, f"is less than the minimum of {value}")

    def _on_maximum(self, x, kind, path, value, spec, seen):
        return self._when(_is(kind, "number") & (_number(x) > float(value)), path, f"is greater than the maximum of {value}")

    def _on_exclusiveMinimum(self, x, kind, path, value, spec, seen):
        return self._when(_is(kind, "number") & (_number(x) <= float(value)), path, f"is less than or equal to the minimum of {value}")

    def _on_exclusiveMaximum(self, x, kind, path, value, spec, seen):
        return self._when(_is(kind, "number") & (_number(x) >= float(value)), path, f"is greater than or equal to the maximum of {value}")

    def _on_pattern(self, x, kind, path, value, spec, seen):
        return self._when(_is(kind, "string") & ~F.try_variant_get(x, "$", "string").rlike(value), path, "does not match its pattern")

    def _on_format(self, x, kind, path, value, spec, seen):
        if not self.formats or value not in _FORMATS:
            return []
        return self._when(_is(kind, "string") & ~F.try_variant_get(x, "$", "string").rlike(_FORMATS[value]), path, f"is not a '{value}'")

    def _on_minLength(self, x, kind, path, value, spec, seen):
        return self._when(_is(kind, "string") & (F.char_length(F.try_variant_get(x, "$", "string")) < value), path, "is too short")

    def _on_maxLength(self, x, kind, path, value, spec, seen):
        return self._when(_is(kind, "string") & (F.char_length(F.try_variant_get(x, "$", "string")) > value), path, "is too long")

    def _on_minItems(self, x, kind, path, value, spec, seen):
        return self._when(_is(kind, "array") & (F.size(_items(x)) < value), path, "is too short")

    def _on_maxItems(self, x, kind, path, value, spec, seen):
        return self._when(_is(kind, "array") & (F.size(_items(x)) > value), path, "is too long")

    def _on_required(self, x, kind, path, value, spec, seen):
        return [e for name in value for e in self._when(_is(kind, "object") & _get(x, name).isNull(), path, f"'{name}' is a required property")]

    def _on_anyOf(self, x, kind, path, value, spec, seen):
        return self._when(reduce(lambda a, b: a & b, [self.check(x, path, s, seen).isNotNull() for s in value]), path, "is not valid under any of the given schemas")

    def _on_allOf(self, x, kind, path, value, spec, seen):
        return [self.check(x, path, s, seen) for s in value]

    def _on_oneOf(self, x, kind, path, value, spec, seen):
        fits = reduce(lambda a, b: a + b, [self.check(x, path, s, seen).isNull().cast("int") for s in value])
        return self._when(fits == 0, path, "is not valid under any of the given schemas") + self._when(fits > 1, path, "is valid under several of the given schemas")

    def _on_not(self, x, kind, path, value, spec, seen):
        return self._when(self.check(x, path, value, seen).isNull(), path, "should not be valid under the given schema")

    def _on_properties(self, x, kind, path, value, spec, seen):
        return [F.when(_is(kind, "object") & _get(x, name).isNotNull(), self.check(_get(x, name), [*path, F.lit(name)], s, seen)) for name, s in value.items()]

    def _on_items(self, x, kind, path, value, spec, seen):
        errors = F.transform(_items(x), lambda e, i: self.check(e, [*path, i.cast("string")], value, seen))
        return [F.when(_is(kind, "array"), F.get(F.array_compact(errors), 0))]

    def _on_additionalProperties(self, x, kind, path, value, spec, seen):
        known = F.array(*[F.lit(k) for k in spec.get("properties", {})]).cast("array<string>")
        patterns = list(spec.get("patternProperties", {}))
        more = F.filter(F.map_entries(F.try_variant_get(x, "$", "map<string,variant>")), lambda e: ~F.array_contains(known, e["key"]) & ~reduce(lambda a, b: a | b, [e["key"].rlike(p) for p in patterns], F.lit(False)))
        if value is False:
            return self._when(_is(kind, "object") & (F.size(more) > 0), path, "has additional properties")
        return self._members(kind, more, path, value, seen)

    def _on_patternProperties(self, x, kind, path, value, spec, seen):
        entries = F.map_entries(F.try_variant_get(x, "$", "map<string,variant>"))
        named = lambda pattern: F.filter(entries, lambda e: e["key"].rlike(pattern))
        return [c for p, s in value.items() for c in self._members(kind, named(p), path, s, seen)]

    def _members(self, kind: Column, entries: Column, path: list[Column], spec: dict | bool, seen: tuple[str, ...]) -> list[Column]:
        if spec is True:
            return []
        errors = F.transform(entries, lambda e: self.check(e["value"], [*path, e["key"]], spec, seen))
        return [F.when(_is(kind, "object"), F.get(F.array_compact(errors), 0))]


def _get(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$['{name}']" if "'" not in name else f'$["{name}"]', "variant")


def _items(x: Column) -> Column:
    return F.try_variant_get(x, "$", "array<variant>")


def validate(df: DataFrame, schema_text: str, text: str = "text", out: str = "error", formats: bool = True) -> DataFrame:
    """df with the first violation as '/pointer: message' (<root> at the top), null for valid records.

    Array items, map values and what $ref points to are checked at any depth, with index or key in the pointer. Types are JSON's:
    5.0 is an integer, and enum compares type and value. Keywords: type, enum, const, minimum, maximum and their exclusive
    forms, pattern, format (unless formats is false: the 2020-12 draft takes it as a note), lengths, required, properties,
    additionalProperties, patternProperties, items, anyOf, allOf, oneOf, not, local $ref. Others that decide what is valid, and a
    $ref that leads to itself, are refused with ValueError. A null text is no JSON; other columns stay, whatever their names.
    """
    held = "_x_variant"
    check = _Compiler(schema := json.loads(schema_text), formats).check(F.col(held), [], schema)
    parsed = df.withColumn(held, F.try_parse_json(F.col(text)))
    return parsed.withColumn(out, F.when(F.col(held).isNull(), "<root>: is not JSON").otherwise(check)).drop(held)


def quarantine(validated: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(valid rows, invalid rows with a reason to partition by)."""
    good = validated.filter(F.col(error).isNull()).drop(error)
    return good, validated.filter(F.col(error).isNotNull()).withColumn("reason", F.regexp_replace(F.substring_index(error, ":", 1), "[^A-Za-z0-9_]+", "_"))


def infer_schema(data_type: T.DataType) -> dict:
    """JSON Schema of a Spark type, as inferred from data."""
    if isinstance(data_type, T.StructType):
        return {"type": "object", "properties": {f.name: infer_schema(f.dataType) for f in data_type}, "required": [f.name for f in data_type if not f.nullable], "additionalProperties": False}
    if isinstance(data_type, T.ArrayType):
        return {"type": ["array", "null"], "items": infer_schema(data_type.elementType)}
    if isinstance(data_type, T.MapType):
        return {"type": ["object", "null"], "additionalProperties": infer_schema(data_type.valueType)}
    name = "integer" if isinstance(data_type, T.IntegralType) else "number" if isinstance(data_type, T.NumericType) else "boolean" if isinstance(data_type, T.BooleanType) else "string"
    return {"type": [name, "null"], **({"format": "date-time"} if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)) else {})}


def latest_versions(schemas: DataFrame) -> DataFrame:
    """(username, platform, entity, version) with the greatest version, compared by its numbers."""
    p = F.transform(F.split("version", "[.]"), lambda x: x.try_cast("int"))
    return schemas.groupBy("username", "platform", "entity").agg(F.max_by("version", p).alias("version"))
