"""Value -> text, as Column expressions.

Everything here is built from JVM-side functions, so a flatten of any width stays one narrow
projection.  NULL stands for "missing or null" and comes back as NULL; callers decide whether it
becomes an empty cell.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F, types as T

from docquarry.functions import types as dt

# Fixed value: fraction digits that write out the smallest double in full.
DOUBLE_FRACTION_DIGITS = 345
_NTZ_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
# The first and the first no longer writable instant of RFC 3339 (years 0000 to 9999),
# and the last such millisecond.
_RFC3339_FROM = "TIMESTAMP_NTZ'0000-01-01 00:00:00'"
_RFC3339_TO = "TIMESTAMP_NTZ'+10000-01-01 00:00:00'"
LAST_RFC3339_MS = 253402300799999


def written_out(value: Column) -> Column:
    """Double in positional digits with a point and without padding: ``1000.``, ``0.00015``.

    Java's ``%f`` pads the digits of its shortest form with zeros, so no digit is invented.  It is
    slow; callers keep it for values that Spark prints with an exponent.
    """
    return F.rtrim(F.format_string(f"%.{DOUBLE_FRACTION_DIGITS}f", value), F.lit("0"))


def double_text(value: Column) -> Column:
    """Shortest positional form of a double: ``2.5``, ``100000000000000000000``, ``-0``.

    Every branch works on the same printed text, which Spark then evaluates once.
    """
    text = value.cast("string")
    return (
        F.when(text.contains("E"), F.rtrim(written_out(value), F.lit(".")))
        .when(text.endswith(".0"), F.left(text, F.length(text) - 2))
        .when(text.endswith("Infinity"), F.replace(text, F.lit("Infinity"), F.lit("inf")))
        .otherwise(text)
    )


def canonical_double_text(value: Column) -> Column:
    """Positional double text that always shows it is a double: ``1.0``, ``Infinity``."""
    text, whole = value.cast("string"), written_out(value)
    exponent = F.when(whole.endswith("."), F.concat(whole, F.lit("0"))).otherwise(whole)
    return F.when(text.contains("E"), exponent).otherwise(text)


def _without_padding(text: Column) -> Column:
    return F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))


def plain_number_text(text: Column) -> Column:
    """Number text as JSON prints it -> positional digits: no exponent, no trailing ``.0``."""
    return (
        F.when(text.contains("E"), F.rtrim(written_out(text.try_cast("double")), F.lit(".")))
        .when(text.contains("."), _without_padding(text))
        .otherwise(text)
    )


def decimal_text(value: Column, dtype: T.DecimalType) -> Column:
    """Decimal digits without the padding zeros of a fixed scale."""
    if dtype.scale == 0:
        return value.cast("string")
    text = value.cast("string")
    # Outside ANSI mode Spark prints decimals below 1e-6 with an exponent: -1.23E-10.
    sign = F.when(text.startswith("-"), "-").otherwise("")
    digits = F.translate(F.substring_index(text, "E", 1), "-.", "")
    zeros = F.repeat(F.lit("0"), F.substring_index(text, "E-", -1).try_cast("int") - 1)
    tiny = F.concat(sign, F.lit("0."), zeros, digits)
    return _without_padding(F.when(text.contains("E"), tiny).otherwise(text))


def hex_text(value: Column) -> Column:
    """Bytes as lowercase hex."""
    return F.lower(F.hex(value))


def epoch_millis(value: Column, dtype: T.DataType) -> Column:
    """Milliseconds since the epoch, rounded down; zone-free timestamps are taken as UTC."""
    if isinstance(dtype, T.TimestampNTZType):
        micros = F.timestamp_diff("MICROSECOND", F.expr(_NTZ_EPOCH), value)
    elif isinstance(dtype, T.DateType):
        return F.unix_date(value).cast("long") * 86_400_000
    else:
        return F.unix_millis(value)
    return F.call_function("div", micros - F.pmod(micros, F.lit(1000)), F.lit(1000))


def rfc3339(value: Column, dtype: T.DataType, held: Callable = lambda value, use: use(value)) -> Column:
    """RFC 3339 UTC text with milliseconds; out-of-range instants become epoch-ms digits.

    The text is assembled from a zone-free timestamp, so it does not depend on the session zone.  Compiled code computes what
    is used twice once; inside a lambda nothing does, so ``variants.bound`` can be given as ``held``.
    """
    if isinstance(dtype, T.TimestampNTZType):
        wall = value
    elif isinstance(dtype, T.DateType):
        wall = value.cast("timestamp_ntz")
    else:
        wall = F.timestamp_add("MICROSECOND", F.unix_micros(value), F.expr(_NTZ_EPOCH))

    def iso(text: Column) -> Column:
        whole = F.concat(text, F.lit(".000Z"))
        return F.when(F.length(text) == 19, whole).otherwise(F.concat(F.rpad(text, 23, "0"), F.lit("Z")))

    def written(wall: Column) -> Column:
        in_range = (wall >= F.expr(_RFC3339_FROM)) & (wall < F.expr(_RFC3339_TO))
        text = held(F.translate(wall.cast("string"), " ", "T"), iso)
        return F.when(in_range, text).otherwise(epoch_millis(value, dtype).cast("string"))

    return held(wall, written)


def wrapper_text(value: Column, key: str) -> Column:
    """Text of a wrapped value (object id, pattern, internal timestamp, ...)."""
    inner = value.getField(key)
    if key == dt.REGEX:
        text = F.concat(F.lit("/"), inner.getField("pattern"), F.lit("/"), inner.getField("options"))
    elif key == dt.TIMESTAMP:
        text = F.concat(inner.getField("t").cast("string"), F.lit("."), inner.getField("i").cast("string"))
    elif key in (dt.MIN_KEY, dt.MAX_KEY, dt.DB_POINTER):
        text = F.lit("")
    else:
        text = inner
    return F.when(value.isNotNull(), text)


def render(value: Column, dtype: T.DataType) -> Column:
    """Value of any document type as cell text; NULL for missing and null."""
    from docquarry.functions.jsonmodes import embedded_json
    from docquarry.functions.variants import render_variant

    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return value
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return double_text(value.cast("double"))
    if isinstance(dtype, T.DecimalType):
        return decimal_text(value, dtype)
    if isinstance(dtype, T.BinaryType):
        return hex_text(value)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return rfc3339(value, dtype)
    if isinstance(dtype, T.ArrayType):
        cells = F.transform(value, lambda x: F.coalesce(render(x, dtype.elementType), F.lit("")))
        return F.concat(F.lit("["), F.array_join(cells, ","), F.lit("]"))
    if isinstance(dtype, T.VariantType):
        return render_variant(value)
    if dt.wrapper_of(dtype):
        return wrapper_text(value, dt.wrapper_of(dtype))
    if isinstance(dtype, (T.StructType, T.MapType)):
        return F.when(value.isNotNull(), embedded_json(value, dtype))
    if isinstance(dtype, T.NullType):
        return F.lit(None).cast("string")
    return value.cast("string")
