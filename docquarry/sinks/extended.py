"""Binary elements of values given as canonical Extended JSON text.

This is the form in which schemaless values reach the binary encoder: their text is made by the JVM, nesting has
no limit, and each value carries its own type.
"""

from __future__ import annotations

import base64
import json
import struct

# Element type bytes of the binary format.
_DOUBLE, _STRING, _DOCUMENT, _ARRAY, _BINARY = b"\x01", b"\x02", b"\x03", b"\x04", b"\x05"
_BOOLEAN, _DATETIME, _NULL, _INT32, _INT64 = b"\x08", b"\x09", b"\x0a", b"\x10", b"\x12"
_int32, _int64, _double = struct.Struct("<i").pack, struct.Struct("<q").pack, struct.Struct("<d").pack


def _text(value: str) -> bytes:
    body = value.encode("utf-8")
    return _int32(len(body) + 1) + body + b"\0"


def _framed(body: bytes) -> bytes:
    return _int32(len(body) + 5) + body + b"\0"


def _name(name: str) -> bytes:
    body = name.encode("utf-8")
    if b"\0" in body:
        raise ValueError(f"a field name of a binary document cannot hold a zero byte: {name!r}")
    return body + b"\0"


def _binary(body: dict) -> bytes:
    data = base64.b64decode(body["base64"])
    return _int32(len(data)) + bytes([int(body["subType"], 16)]) + data


#: Type and payload of what a wrapper holds, by its key.
_WRAPPED = {
    "$numberInt": (_INT32, lambda body: _int32(int(body))),
    "$numberLong": (_INT64, lambda body: _int64(int(body))),
    "$numberDouble": (_DOUBLE, lambda body: _double(float(body))),
    "$date": (_DATETIME, lambda body: _int64(int(body["$numberLong"]))),
    "$binary": (_BINARY, _binary),
}


def value_payload(value) -> tuple[bytes, bytes]:
    """Type byte and payload of a parsed value.

    Containers are finished from the inside out with a stack of their own, so nesting is not bounded by Python's.
    """
    scalar = _scalar(value)
    if scalar is not None:
        return scalar
    # (name, type, children still to do, bytes of the elements done)
    stack = [(b"", *_opened(value))]
    while True:
        name, code, left, done = stack[-1]
        for inner, child in left:
            scalar = _scalar(child)
            if scalar is None:
                stack.append((_name(inner), *_opened(child)))
                break
            done += (scalar[0], _name(inner), scalar[1])
        else:
            body = _framed(b"".join(done))
            stack.pop()
            if not stack:
                return code, body
            stack[-1][-1].extend((code, name, body))


def _opened(value) -> tuple:
    if isinstance(value, dict):
        return _DOCUMENT, iter(value.items()), []
    return _ARRAY, ((str(i), x) for i, x in enumerate(value)), []


def _scalar(value) -> tuple[bytes, bytes] | None:
    """Type and payload of anything but a document or an array."""
    if isinstance(value, dict):
        if len(value) != 1:
            return None
        ((key, body),) = value.items()
        if key not in _WRAPPED:
            return None
        code, payload = _WRAPPED[key]
        return code, payload(body)
    if isinstance(value, str):
        return _STRING, _text(value)
    if isinstance(value, list):
        return None
    if value is None:
        return _NULL, b""
    if isinstance(value, bool):
        return _BOOLEAN, bytes([value])
    raise ValueError(f"canonical text wraps its numbers; {value!r} is bare")


def text_payload(text: str | None) -> tuple[bytes, bytes]:
    """Type byte and payload of a canonical JSON text; NULL text is a null."""
    return (_NULL, b"") if text is None else value_payload(json.loads(text))


def text_document(text: str | None) -> bytes:
    """A whole binary document from canonical JSON text; anything but an object is refused."""
    code, body = text_payload(text)
    if code != _DOCUMENT:
        raise ValueError("a binary document is an object; this one is null, a scalar or an array")
    return body
