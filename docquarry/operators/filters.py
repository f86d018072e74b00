"""Filter specs: a Python dict of field conditions -> one boolean Column.

The spec follows the document-database form: ``{"status": "active", "age": {"$gte": 18}}``.
Nothing is parsed; the dict is folded into ``Column`` operators, so Catalyst sees ordinary
comparisons and pushes them to the scan.  An operator that is not known raises, it is never ignored.
Values of another kind than the literal (text against a number) do not match.
"""

from __future__ import annotations

import base64
import datetime as _dt
import decimal
import functools
import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docquarry.functions import types as dt
from docquarry.functions.variants import bound
from docquarry.operators.paths import Found, exists, is_null, lookup, path_tree, variant_path

_LITERAL_KEYS = {
    "$oid",
    "$date",
    "$numberInt",
    "$numberLong",
    "$numberDouble",
    "$numberDecimal",
    "$binary",
}
_COMPARE = {
    "$eq": lambda a, b: a == b,
    "$gt": lambda a, b: a > b,
    "$gte": lambda a, b: a >= b,
    "$lt": lambda a, b: a < b,
    "$lte": lambda a, b: a <= b,
}
_PLAIN_PREFIX = re.compile(r"\^([A-Za-z0-9 _:/#@,-]+)")
_EPOCH = _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)


def _as_date(body) -> _dt.datetime:
    if isinstance(body, Mapping):
        body = int(body["$numberLong"])
    if isinstance(body, int):
        return _EPOCH + _dt.timedelta(milliseconds=body)
    stamp = _dt.datetime.fromisoformat(body)
    return stamp.replace(tzinfo=_dt.timezone.utc) if stamp.tzinfo is None else stamp


def typed_literal(value):
    """Extended JSON literal -> Python value: ``{"$numberLong": "5"}`` -> ``5``."""
    if not isinstance(value, Mapping):
        return value
    if len(value) != 1 or next(iter(value)) not in _LITERAL_KEYS:
        raise ValueError(f"unsupported literal {dict(value)!r}")
    (key, body), = value.items()
    if key == "$oid":
        if not re.fullmatch("[0-9a-fA-F]{24}", body):
            raise ValueError(f"$oid must be 24 hex digits, got {body!r}")
        return body.lower()
    if key == "$date":
        return _as_date(body)
    if key in ("$numberInt", "$numberLong"):
        return int(body)
    if key == "$numberDouble":
        return float(body)
    if key == "$numberDecimal":
        return decimal.Decimal(body)
    return base64.b64decode(body["base64"])


def _kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, (int, float, decimal.Decimal)):
        return "number"
    if isinstance(value, str):
        return "text"
    if isinstance(value, (_dt.datetime, _dt.date)):
        return "date"
    if isinstance(value, (bytes, bytearray)):
        return "bytes"
    raise ValueError(f"unsupported literal {value!r}")


def _type_kind(dtype: T.DataType | None) -> str | None:
    if isinstance(dtype, T.BooleanType):
        return "bool"
    if isinstance(dtype, T.NumericType):
        return "number"
    if isinstance(dtype, T.StringType):
        return "text"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "date"
    if isinstance(dtype, T.BinaryType):
        return "bytes"
    return None


def _date_literal(value, dtype: T.DataType) -> Column:
    if not isinstance(value, _dt.datetime):
        value = _dt.datetime(value.year, value.month, value.day)
    if value.tzinfo is None:
        value = value.replace(tzinfo=_dt.timezone.utc)
    text = value.astimezone(_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(dtype, T.TimestampType):
        return F.lit(text + "Z").cast("timestamp")
    return F.lit(text).cast("timestamp_ntz")


def _typed_compare(op: str, found: Found, value) -> Column:
    dtype, column = found.dtype, found.value
    if dt.wrapper_of(dtype) == dt.OID:
        dtype, column = T.StringType(), column.getField(dt.OID)
    if _type_kind(dtype) != _kind(value):
        return F.lit(False)
    literal = _date_literal(value, dtype) if _kind(value) == "date" else F.lit(value)
    result = _COMPARE[op](column, literal)
    if op in ("$gt", "$gte") and isinstance(dtype, (T.FloatType, T.DoubleType)):
        result = result & ~F.isnan(column)
    return result


def _variant_compare(op: str, variant: Column, value) -> Column:
    compare, kind = _COMPARE[op], F.schema_of_variant(variant)
    read = lambda target: F.try_variant_get(variant, "$", target)
    group = _kind(value)
    if group == "text":
        return (kind == "STRING") & compare(read("string"), F.lit(value))
    if group == "bool":
        return (kind == "BOOLEAN") & compare(read("boolean"), F.lit(value))
    if group == "bytes":
        return (kind == "BINARY") & compare(read("binary"), F.lit(value))
    if group == "date":
        zoned = (kind == "TIMESTAMP") & compare(read("timestamp"), _date_literal(value, T.TimestampType()))
        local = kind.isin("TIMESTAMP_NTZ", "DATE")
        return zoned | (local & compare(read("timestamp_ntz"), _date_literal(value, T.TimestampNTZType())))
    exact = isinstance(value, int) and -(2**63) <= value < 2**63
    as_double = compare(read("double"), F.lit(float(value)))
    number = kind.rlike("^(DECIMAL|DOUBLE|FLOAT)") & as_double
    whole = compare(read("bigint"), F.lit(value).cast("long")) if exact else as_double
    return ((kind == "BIGINT") & whole) | number


def _compare(op: str, found: Found, value) -> Column:
    value = typed_literal(value)
    if value is None:
        if op == "$eq":
            return is_null(found)
        raise ValueError(f"{op} needs a non-null literal")
    if found.dtype is None:
        return F.lit(False)
    if isinstance(found.dtype, T.VariantType):
        return _variant_compare(op, found.value, value)
    return _typed_compare(op, found, value)


def _text_of(found: Found) -> Column | None:
    if isinstance(found.dtype, T.StringType):
        return found.value
    if isinstance(found.dtype, T.VariantType):
        return F.when(F.schema_of_variant(found.value) == "STRING", F.try_variant_get(found.value, "$", "string"))
    return None


def _regex(found: Found, pattern: str, options: str = "") -> Column:
    unknown = set(options) - set("imsx")
    if unknown:
        raise ValueError(f"unsupported $options {''.join(sorted(unknown))!r}")
    text = _text_of(found)
    if text is None:
        return F.lit(False)
    prefix = _PLAIN_PREFIX.fullmatch(pattern)
    if prefix and not options:
        return text.startswith(prefix.group(1))
    return text.rlike((f"(?{options})" if options else "") + pattern)


def _negate(found: Found, condition: Column) -> Column:
    """Everything the condition does not match, missing values included."""
    if found.dtype is None or isinstance(found.dtype, T.VariantType):
        return ~F.coalesce(condition, F.lit(False))
    return ~condition | found.value.isNull()


def _membership(found: Found, members) -> Column:
    if isinstance(members, (str, bytes, Mapping)) or not isinstance(members, Sequence):
        raise ValueError("$in and $nin need a list")
    literals = [typed_literal(m) for m in members]
    plain = [m for m in literals if m is not None]
    parts = [is_null(found)] if len(plain) < len(literals) else []
    kind = _type_kind(found.dtype)
    if kind in ("text", "number") and not isinstance(found.dtype, T.VariantType):
        plain = [m for m in plain if _kind(m) == kind]
        parts += [found.value.isin(plain)] if plain else []
    else:
        parts += [_compare("$eq", found, m) for m in plain]
    return functools.reduce(lambda a, b: a | b, parts, F.lit(False)) if parts else F.lit(False)


def _field(found: Found, condition) -> Column:
    if not isinstance(condition, Mapping) or next(iter(condition), None) in _LITERAL_KEYS:
        return _compare("$eq", found, condition)
    if not condition or not all(isinstance(k, str) and k.startswith("$") for k in condition):
        raise ValueError(f"sub-document equality is not supported: {dict(condition)!r}; use dotted paths")
    parts = []
    for op, operand in condition.items():
        if op in _COMPARE:
            parts.append(_compare(op, found, operand))
        elif op == "$ne":
            parts.append(~is_null(found) if operand is None else _negate(found, _compare("$eq", found, operand)))
        elif op == "$in":
            parts.append(_membership(found, operand))
        elif op == "$nin":
            hit = _membership(found, operand)
            parts.append(~hit if None in operand else _negate(found, hit))
        elif op == "$not":
            parts.append(~F.coalesce(_field(found, operand), F.lit(False)))
        elif op == "$exists":
            parts.append(exists(found) if operand else ~exists(found))
        elif op == "$regex":
            parts.append(_regex(found, operand, condition.get("$options", "")))
        elif op == "$regularExpression":
            parts.append(_regex(found, operand["pattern"], operand.get("options", "")))
        elif op == "$options" and "$regex" in condition:
            continue
        else:
            raise ValueError(f"unknown filter operator {op!r}")
    return functools.reduce(lambda a, b: a & b, parts)


def _paths(spec: Mapping) -> list[str]:
    """Every path a spec names."""
    found = []
    for key, operand in spec.items():
        if key in ("$and", "$or") and isinstance(operand, Sequence):
            found += [path for inner in operand if isinstance(inner, Mapping) for path in _paths(inner)]
        elif not key.startswith("$"):
            found.append(key)
    return found


def _condition(spec: Mapping, find: Callable[[str], Found]) -> Column | None:
    if not isinstance(spec, Mapping):
        raise ValueError("a filter spec must be a mapping")
    parts: list[Column] = []
    for key, operand in spec.items():
        if key in ("$and", "$or"):
            if not isinstance(operand, Sequence) or isinstance(operand, str) or not operand:
                raise ValueError(f"{key} needs a non-empty list")
            inner = [_condition(s, find) for s in operand]
            inner = [F.lit(True) if c is None else c for c in inner]
            join = (lambda a, b: a & b) if key == "$and" else (lambda a, b: a | b)
            parts.append(functools.reduce(join, inner))
        elif key.startswith("$"):
            raise ValueError(f"unknown filter operator {key!r}")
        else:
            parts.append(_field(find(key), operand))
    return functools.reduce(lambda a, b: a & b, parts) if parts else None


def condition(df: DataFrame, spec: Mapping, doc: str | None = None) -> Column | None:
    """Boolean Column of a filter spec; None for the empty spec, which matches everything."""
    return _condition(spec, lambda path: lookup(df, path, doc))


def _opened_type(tree: dict) -> str | None:
    """Type that opens the wanted names in one cast; None where Spark cannot tell or quote them all."""
    if any("`" in n or not n for n in tree) or len({n.lower() for n in tree}) < len(tree):
        return None
    below = {n: _opened_type(t) if t else "variant" for n, t in tree.items()}
    if None in below.values():
        return None
    return "struct<" + ", ".join(f"`{n}`: {t}" for n, t in below.items()) + ">"


def _found_in(opened: Column, tree: dict, path: str) -> Found:
    """A path in the cast of ``_opened_type``; below a whole value it goes on by name."""
    parts, value = path.split("."), opened
    while parts and tree:
        value, tree, parts = value.getField(parts[0]), tree[parts[0]], parts[1:]
    if parts:
        value = F.try_variant_get(value, variant_path(parts), "variant")
    return Found(value, T.VariantType())


def where(df: DataFrame, spec: Mapping, doc: str | None = None) -> DataFrame:
    """Documents that match the spec.

    What a spec names in a VARIANT is taken out by one cast.  Catalyst copies a document's expression to each place
    in a filter that uses it, so with a single use a document that is parsed from text is parsed once.
    """
    if doc is not None and isinstance(spec, Mapping) and isinstance(dt.field_type(df.schema, doc), T.VariantType):
        paths = _paths(spec)
        tree = path_tree(paths)
        opened = _opened_type(tree) if paths and all("" not in p.split(".") for p in paths) else None
        if opened is not None:
            value = F.try_variant_get(dt.column(doc), "$", opened)
            return df.filter(bound(value, lambda v: _condition(spec, lambda path: _found_in(v, tree, path))))
    wanted = condition(df, spec, doc)
    return df if wanted is None else df.filter(wanted)


def combine(base: Mapping, extra: Mapping) -> dict:
    """Conjunction of two specs; an empty base is just the other side."""
    return {"$and": [dict(base), dict(extra)]} if base else dict(extra)
