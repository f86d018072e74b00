"""Text of VARIANT values, whatever their nesting.

A value is laid out as a flat array of tokens: text that is finished, and containers that are still closed.
Each round opens every closed container one level, and a row goes through as many rounds as its own nesting asks
for; when text is written, what is finished at either end leaves the tokens.  So the expression has one copy of each rule, however deep a document is, and nothing is cut or refused.

JSON in one of the modes is the text Spark prints, with other text for some leaves: rounds only find the leaves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F, types as T

from docquarry.functions import types as dt

# Brackets of a schema text (quoted names are skipped) and of a JSON text (strings are skipped).
_SCHEMA_MARKS = "`[^`]*+`|[<>]"
_STRING = r'"(?:[^"\\]++|\\.)*+"'
_JSON_MARKS = _STRING + r"|[\[\]{}]"
# A leaf of a JSON text, and what stands between leaves: brackets, commas and names.
_LEAF = rf'(?:{_STRING}|[^\[\]{{}},:"]++)'
_BETWEEN = rf"(?:[\[\]{{}},]++|{_STRING}:)"
# A JSON text cut behind each leaf; what follows the last one is a piece too.
_PIECES = f"{_BETWEEN}*+{_LEAF}|{_BETWEEN}++"
# Kinds of leaves that every mode writes as Spark does.
_SAME_IN_ALL = ("STRING", "BOOLEAN", "VOID")
# Rounds of a turn, and tokens that are not worth setting aside after it.
_TURN, _FEW = 8, 16


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _nesting(text: Column, marks: str) -> Column:
    """Greatest number of open brackets in a text."""
    step = lambda m: F.when(m.isin("<", "[", "{"), 1).when(m.isin(">", "]", "}"), -1).otherwise(0)
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def count(state: Column, mark: Column) -> Column:
        now = state["now"] + step(mark)
        return F.struct(now.alias("now"), F.greatest(state["most"], now).alias("most"))

    return F.aggregate(F.regexp_extract_all(text, F.lit(marks), F.lit(0)), start, count, lambda s: s["most"])


def _schema_nesting(schema: Column) -> Column:
    """Rounds that open everything a schema text names; a few rounds too many cost less than the exact number."""

    def rounds(text: Column) -> Column:
        brackets = F.length(text) - F.length(F.replace(text, F.lit("<"), F.lit("")))
        return F.when(brackets <= 6, brackets).otherwise(_nesting(text, _SCHEMA_MARKS))

    return bound(schema, rounds)


def _rounds(tokens: Column, n: Column, open_up: Callable[[Column], Column]) -> Column:
    """Tokens after ``n`` rounds of opening."""
    counter = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(counter, tokens, lambda found, _: F.flatten(F.transform(found, open_up)))


def opened(value: Column, start: Column, open_up: Callable[[Column], Column]) -> Column:
    """Tokens of a VARIANT after all its containers were opened.

    ``start`` is the first token array and ``open_up`` turns a token into the tokens it opens to; a token is a struct with a
    field ``item`` that is NULL once it is finished.  The schema of the value tells how many rounds are
    needed, except below arrays of mixed content; what is still closed then is measured on its JSON text.
    """
    first = _rounds(start, _schema_nesting(F.schema_of_variant(value)), open_up)

    def rest(tokens: Column) -> Column:
        closed = F.filter(tokens, lambda t: t["item"].isNotNull())
        deepest = F.array_max(F.transform(closed, lambda t: _nesting(F.to_json(t["item"]), _JSON_MARKS)))
        return F.when(F.size(closed) > 0, _rounds(tokens, deepest, open_up)).otherwise(tokens)

    return bound(first, rest)


def _token(mark: Column, item: Column | None = None) -> Column:
    item = F.lit(None).cast("variant") if item is None else item
    return F.struct(mark.alias("mark"), item.alias("item"))


def _settled(state: Column, tokens: Column) -> Column:
    """The state after a round: what is finished before the first closed value and after the last one joins the text."""
    joined = lambda part: F.array_join(F.transform(part, lambda t: t["mark"]), "")

    def split(tokens: Column, ends: Column) -> Column:
        first, last = ends["first"], ends["last"]
        return F.struct(
            F.concat(state["head"], joined(F.slice(tokens, F.lit(1), first))).alias("head"),
            F.slice(tokens, first + 1, last - first + 1).alias("open"),
            F.concat(joined(F.slice(tokens, last + 2, F.size(tokens) - 1 - last)), state["tail"]).alias("tail"),
        )

    def ends(tokens: Column) -> Column:
        closed = F.transform(tokens, lambda t, at: F.when(t["item"].isNotNull(), at))
        first, last = F.coalesce(F.array_min(closed), F.size(tokens)), F.coalesce(F.array_max(closed), F.size(tokens) - 1)
        return F.struct(first.alias("first"), last.alias("last"))

    return bound(tokens, lambda found: bound(ends(found), lambda at: split(found, at)))


def _walked(value: Column, leaf_text) -> Column:
    """Text of a VARIANT: brackets and commas of arrays as in JSON, all else written by ``leaf_text(value, kind)``.

    Text that is finished at either end is carried as text, so a round costs what is still closed and a value is never looked
    at with all that is below it.
    """

    def mark(before: Column, at: Column) -> Column:
        return F.when(at == 0, before).otherwise(F.concat(F.lit(","), before))

    def whole(token: Column, left: str, children: Column, right: str) -> Column:
        start = F.array(_token(F.concat(token["mark"], F.lit(left))))
        return F.concat(start, children, F.array(_token(F.lit(right))))

    def open_up(token: Column) -> Column:
        item = token["item"]
        leaf = F.coalesce(leaf_text(item, F.schema_of_variant(item)), F.lit(""))
        finished = F.array(_token(F.concat(token["mark"], leaf)))
        element = lambda x, at: _token(mark(F.lit(""), at), x)
        elements = lambda found: whole(token, "[", F.transform(found, element), "]")
        opened = bound(dt.as_array(item), lambda found: F.when(found.isNull(), finished).otherwise(elements(found)))
        return F.when(item.isNull(), F.array(token)).otherwise(opened)

    def turn(state: Column, _: Column) -> Column:
        tokens = F.flatten(F.transform(state["open"], open_up))
        return F.when(F.size(state["open"]) == 0, state).otherwise(_settled(state, tokens))

    def text(value: Column) -> Column:
        start = F.struct(F.lit("").alias("head"), F.array(_token(F.lit(""), value)).alias("open"), F.lit("").alias("tail"))
        # As many rounds as there are brackets are enough; those after the last closed value do nothing.
        brackets = bound(F.to_json(value), lambda json: F.length(json) - F.length(F.translate(json, "[{", "")))
        return F.aggregate(F.sequence(F.lit(1), brackets + 1), start, turn, lambda s: F.concat(s["head"], s["tail"]))

    return bound(value, text)


def _leaves(value: Column, brackets: Column) -> Column:
    """The leaves of a VARIANT, in the order of its JSON text; as many rounds as that has brackets open everything.

    Rounds are made in turns, and leaves at either end are set aside after each, unless they are few.
    """
    # Inside a container, or the leaf itself.
    open_up = lambda item: F.coalesce(F.map_values(dt.as_object(item)), dt.as_array(item), F.array(item))

    def closed(item: Column) -> Column:
        # Asks for no field, so nothing inside is laid out anew.
        held_as = lambda kind: F.try_variant_get(item, "$", kind).isNotNull()
        return held_as("struct<>") | held_as("array<struct<>>")

    def state(head: Column, open: Column, tail: Column) -> Column:
        return F.struct(head.alias("head"), open.alias("open"), tail.alias("tail"))

    def split(before: Column, tokens: Column, marks: Column) -> Column:
        first = F.array_position(marks, True).cast("int") - 1
        last = F.size(marks) - F.array_position(F.reverse(marks), True).cast("int")
        head, tail = F.slice(tokens, F.lit(1), first), F.slice(tokens, last + 2, F.size(tokens) - 1 - last)
        inner = F.slice(tokens, first + 1, last - first + 1)
        return state(F.concat(before["head"], head), inner, F.concat(tail, before["tail"]))

    def settled(before: Column, tokens: Column) -> Column:
        return (
            F.when(~F.exists(tokens, closed), state(F.concat(before["head"], tokens), none, before["tail"]))
            .when(F.size(tokens) <= _FEW, state(before["head"], tokens, before["tail"]))
            .otherwise(bound(F.transform(tokens, closed), lambda marks: split(before, tokens, marks)))
        )

    def turn(before: Column, _: Column) -> Column:
        after = bound(_rounds(before["open"], F.lit(_TURN), open_up), lambda tokens: settled(before, tokens))
        return F.when(F.size(before["open"]) == 0, before).otherwise(after)

    none, root = F.array().cast("array<variant>"), F.array(value)
    turns = F.sequence(F.lit(1), (brackets / _TURN).cast("int") + 1)
    deep = F.aggregate(turns, state(none, root, none), turn, lambda s: F.concat(s["head"], s["tail"]))
    return F.when(brackets <= _TURN, _rounds(root, brackets, open_up)).otherwise(deep)


def _rewritten(value: Column, same: tuple[str, ...], leaf_text) -> Column:
    """JSON text of a VARIANT with the text ``leaf_text(leaf, kind)`` for its leaves.

    Leaves of the kinds ``same`` and those without such a text are as Spark prints them.
    """

    def put(piece: Column, leaf: Column, kind: Column) -> Column:
        before = F.regexp_extract(piece, f"^{_BETWEEN}*+", 0)
        other = F.coalesce(F.concat(before, leaf_text(leaf, kind)), piece)
        return F.when(leaf.isNull() | kind.isin(*same), piece).otherwise(other)

    def text(value: Column, json: Column) -> Column:
        unbracketed = F.replace(F.replace(json, F.lit("["), F.lit("")), F.lit("{"), F.lit(""))
        leaves = bound(F.octet_length(json) - F.octet_length(unbracketed), lambda n: _leaves(value, n))
        pieces = F.regexp_extract_all(json, F.lit(_PIECES), F.lit(0))
        texts = F.zip_with(pieces, leaves, lambda p, x: bound(F.schema_of_variant(x), lambda kind: put(p, x, kind)))
        return F.array_join(texts, "")

    # Laid out anew, so that the text and the leaves keep the fields in the same order.
    whole = F.try_variant_get(value, "$", "variant")
    return bound(whole, lambda value: bound(F.to_json(value), lambda json: text(value, json)))


def needs_walk(kind: Column, text: Column) -> Column:
    """True where the cell text of a VARIANT is not just its cast to string."""
    padded = text.endswith("0") & text.contains(".") & kind.startswith("DECIMAL")
    return kind.rlike("^(ARRAY|TIMESTAMP|BINARY|DOUBLE|FLOAT)") | padded


def _cast_text(value: Column, kind: Column) -> Column:
    """Text of a VARIANT that prints as its cast; NULL for a VARIANT null."""
    from docquarry.functions.values import plain_number_text

    text = F.try_variant_get(value, "$", "string")
    number = lambda text: F.replace(plain_number_text(text), F.lit("Infinity"), F.lit("inf"))
    return (
        F.when(kind == "VOID", F.lit(None).cast("string"))
        .when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), number(text))
        .otherwise(text)
    )


def scalar_text(value: Column, kind: Column) -> Column:
    """Cell text of a VARIANT that is no array; NULL for a VARIANT null."""
    from docquarry.functions.values import hex_text, rfc3339

    zoned, local = F.try_variant_get(value, "$", "timestamp"), F.try_variant_get(value, "$", "timestamp_ntz")
    return (
        F.when(kind == "TIMESTAMP", rfc3339(zoned, T.TimestampType()))
        .when(kind == "TIMESTAMP_NTZ", rfc3339(local, T.TimestampNTZType()))
        .when(kind == "BINARY", hex_text(F.try_variant_get(value, "$", "binary")))
        .otherwise(_cast_text(value, kind))
    )


def render_variant(value: Column) -> Column:
    """Cell text of a VARIANT: arrays as ``[a,b]``, objects as JSON text, scalars as themselves."""
    absent = value.isNull() | F.is_variant_null(value)
    return F.when(absent, F.lit(None).cast("string")).otherwise(_walked(value, scalar_text))


def _instant_leaf(leaf: Column, kind: str, dtype: T.DataType, mode: str) -> Column:
    """JSON of a VARIANT instant; never NULL text for a value outside the readable range."""
    from docquarry.functions.values import LAST_RFC3339_MS, epoch_millis, rfc3339

    def text(value: Column) -> Column:
        millis, readable = epoch_millis(value, dtype), F.concat(F.lit('"'), rfc3339(value, dtype, bound), F.lit('"'))
        counted = F.concat(F.lit('{"$date":{"$numberLong":"'), millis.cast("string"), F.lit('"}}'))
        if mode == "plain":
            return readable
        if mode == "canonical":
            return counted
        inside = millis.between(0, LAST_RFC3339_MS)
        return F.when(inside, F.concat(F.lit('{"$date":'), readable, F.lit("}"))).otherwise(counted)

    return bound(F.try_variant_get(leaf, "$", kind), text)


def _typed_leaf(leaf: Column, kind: Column, mode: str) -> Column:
    """JSON of the kinds that no JSON text gives a VARIANT: instants and bytes; NULL for all others."""
    from docquarry.functions.values import hex_text

    data = F.try_variant_get(leaf, "$", "binary")
    if mode == "plain":
        binary = F.concat(F.lit('"'), hex_text(data), F.lit('"'))
    else:
        binary = F.concat(F.lit('{"$binary":{"base64":"'), F.base64(data), F.lit('","subType":"00"}}'))
    return (
        F.when(kind == "TIMESTAMP", _instant_leaf(leaf, "timestamp", T.TimestampType(), mode))
        .when(kind == "TIMESTAMP_NTZ", _instant_leaf(leaf, "timestamp_ntz", T.TimestampNTZType(), mode))
        .when(kind == "DATE", _instant_leaf(leaf, "date", T.DateType(), mode))
        .when(kind == "BINARY", binary)
    )


def _canonical_leaf(leaf: Column, kind: Column) -> Column:
    """Canonical JSON of a VARIANT scalar; NULL where it is as Spark prints it."""
    from docquarry.functions.values import canonical_double_text

    def whole(number: Column) -> Column:
        key = F.when(number.between(-(2**31), 2**31 - 1), "Int").otherwise("Long")
        return F.concat(F.lit('{"$number'), key, F.lit('":"'), number.cast("string"), F.lit('"}'))

    def double(number: Column) -> Column:
        return F.concat(F.lit('{"$numberDouble":"'), canonical_double_text(number), F.lit('"}'))

    fractional = kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")
    return (
        F.when(kind == "BIGINT", bound(F.try_variant_get(leaf, "$", "bigint"), whole))
        .when(fractional, bound(F.try_variant_get(leaf, "$", "double"), double))
        .otherwise(_typed_leaf(leaf, kind, "canonical"))
    )


def _readable_leaf(leaf: Column, kind: Column, mode: str) -> Column:
    """Plain or relaxed JSON of a VARIANT scalar; NULL where it is as Spark prints it."""
    from docquarry.functions.values import canonical_double_text

    def endless(number: Column) -> Column:
        wrapped = F.concat(F.lit('{"$numberDouble":"'), canonical_double_text(number), F.lit('"}'))
        shown = F.lit("null") if mode == "plain" else wrapped
        return F.when(F.isnan(number) | (F.abs(number) == float("inf")), shown)

    double = bound(F.try_variant_get(leaf, "$", "double"), endless)
    return F.when(kind.isin("DOUBLE", "FLOAT"), double).otherwise(_typed_leaf(leaf, kind, mode))


def readable_json(value: Column, mode: str) -> Column:
    """Plain or relaxed JSON text of a VARIANT.

    Only a value whose schema names an instant, bytes or a double, or may hide one below an array of mixed
    content, is walked; all others print as they are.
    """
    walked = lambda v: F.schema_of_variant(v).rlike("TIMESTAMP|DATE|BINARY|DOUBLE|FLOAT|VARIANT")
    text = lambda v: _rewritten(v, _SAME_IN_ALL + ("BIGINT",), lambda leaf, kind: _readable_leaf(leaf, kind, mode))
    return bound(value, lambda v: F.when(walked(v), text(v)).otherwise(F.to_json(v)))


def canonical_json(value: Column) -> Column:
    """Canonical JSON text of a VARIANT.

    Whole numbers that fit 32 bits become ``$numberInt``, larger ones ``$numberLong``, all other
    numbers ``$numberDouble`` (a decimal from JSON text cannot be told from any other).
    """
    return bound(value, lambda v: F.when(v.isNotNull(), _rewritten(v, _SAME_IN_ALL, _canonical_leaf)))
