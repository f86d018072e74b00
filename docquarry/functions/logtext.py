"""Text rules over connection strings and error messages, as Column expressions."""

from __future__ import annotations

import functools

from pyspark.sql import Column, functions as F

# Ordered message rules; the first rule with a hit decides.
# (words, category, severity, retryable, retry delay in seconds)
ERROR_RULES = (
    (("connection", "network", "timeout"), "Network", "Error", True, 5),
    (("authentication", "unauthorized", "auth"), "Authentication", "Critical", False, None),
    (("permission", "access denied", "forbidden"), "Database", "Critical", False, None),
    (("file", "disk", "space"), "File System", "Error", True, 10),
    (("serialize", "parse", "json"), "Serialization", "Warning", True, 1),
    (("memory", "oom", "resource"), "Resource", "Error", True, 30),
)
UNKNOWN_ERROR = ("Unknown", "Error", True, 5)

# Ordered message rules for the process exit code.
EXIT_RULES = (
    (("output", "overwrite"), 6),
    (("uri", "connection", "mongodb connection"), 4),
    (("schema", "query"), 5),
    (("invalid", "required", "must be", "cannot be"), 2),
)
OPERATIONAL_FAILURE = 1

# Accepted connection-string schemes, size units.
URI_SCHEMES = ("mongodb://", "mongodb+srv://")
SIZE_UNITS = ("B", "KB", "MB", "GB", "TB")


def _rule(message: Column, word_lists) -> Column:
    """Number of the first rule with a word in the message; the count of rules when none has."""
    lowered = F.lower(message)
    chain = None
    for number, words in enumerate(word_lists):
        hit = functools.reduce(lambda a, b: a | b, [lowered.contains(w) for w in words])
        chain = F.when(hit, number) if chain is None else chain.when(hit, number)
    return chain.otherwise(len(word_lists))


def _by_rule(message: Column, word_lists, results, dtype: str) -> Column:
    """Result of the deciding rule.  Columns that share a message share its rule number in the plan."""
    table = F.array(*[F.lit(r).cast(dtype) for r in results])
    return F.when(message.isNotNull(), F.get(table, _rule(message, word_lists)))


def _error_attribute(message: Column, place: int, dtype: str) -> Column:
    results = [rule[place] for rule in ERROR_RULES] + [UNKNOWN_ERROR[place - 1]]
    return _by_rule(message, [rule[0] for rule in ERROR_RULES], results, dtype)


def error_category(message: Column) -> Column:
    return _error_attribute(message, 1, "string")


def error_severity(message: Column) -> Column:
    return _error_attribute(message, 2, "string")


def error_retryable(message: Column) -> Column:
    return _error_attribute(message, 3, "boolean")


def error_retry_delay(message: Column) -> Column:
    """Seconds to wait before a retry, NULL when the error is not retryable."""
    return _error_attribute(message, 4, "int")


def exit_code(message: Column) -> Column:
    codes = [code for _, code in EXIT_RULES] + [OPERATIONAL_FAILURE]
    return _by_rule(message, [words for words, _ in EXIT_RULES], codes, "int")


def valid_uri(text: Column) -> Column:
    """True when the text starts with an accepted connection-string scheme."""
    return functools.reduce(lambda a, b: a | b, [text.startswith(s) for s in URI_SCHEMES])


def mask_credentials(text: Column) -> Column:
    """Replace the user-info part of every URI in the text with ``***``."""
    return F.regexp_replace(text, r"://[^@/\s]+@", "://***@")


def _two_decimals(size: Column, unit: int) -> Column:
    """``size / unit`` with two decimals, ties to even, in whole-number arithmetic."""
    div = lambda a, b: F.call_function("div", a, F.lit(b))
    scaled = (size % unit) * 100
    twice = (scaled % unit) * 2
    floor = div(scaled, unit)
    up = (twice > unit) | ((twice == unit) & (floor % 2 == 1))
    hundredths = div(size, unit) * 100 + floor + F.when(up, 1).otherwise(0)
    cents = F.lpad((hundredths % 100).cast("string"), 2, "0")
    return F.concat(div(hundredths, 100).cast("string"), F.lit("."), cents)


def format_bytes(size: Column) -> Column:
    """Human-readable size, base 1024: ``512 B``, ``1.50 KB``; TB is the largest unit."""
    size = size.cast("long")
    *middle, largest = list(enumerate(SIZE_UNITS))[1:]
    text = lambda power, unit: F.concat(_two_decimals(size, 1024**power), F.lit(f" {unit}"))
    result = F.when(size < 1024, F.concat(size.cast("string"), F.lit(f" {SIZE_UNITS[0]}")))
    for power, unit in middle:
        result = result.when(size < 1024 ** (power + 1), text(power, unit))
    return F.when(size.isNotNull(), result.otherwise(text(*largest)))
