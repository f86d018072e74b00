"""A small independent reader of binary documents, for tests only."""

import struct


def _cstring(data, at):
    end = data.index(b"\0", at)
    return data[at:end].decode(), end + 1


def _string(data, at):
    (size,) = struct.unpack_from("<i", data, at)
    assert data[at + 3 + size] == 0
    return data[at + 4 : at + 3 + size].decode(), at + 4 + size


def _decimal(raw):
    bits = int.from_bytes(raw, "little")
    sign, exponent, digits = bits >> 127, ((bits >> 113) & 0x3FFF) - 6176, bits & ((1 << 113) - 1)
    return ("decimal", (-1) ** sign * digits, exponent)


def _value(kind, data, at):
    fixed = {0x01: "<d", 0x09: "<q", 0x10: "<i", 0x11: "<Q", 0x12: "<q"}
    if kind in fixed:
        (value,) = struct.unpack_from(fixed[kind], data, at)
        at += struct.calcsize(fixed[kind])
        if kind == 0x09:
            return ("date", value), at
        if kind == 0x11:
            return ("timestamp", value >> 32, value & 0xFFFFFFFF), at
        return (value if kind != 0x10 else ("int32", value)), at
    if kind == 0x02:
        return _string(data, at)
    if kind in (0x0D, 0x0E):
        text, at = _string(data, at)
        return ({0x0D: "code", 0x0E: "symbol"}[kind], text), at
    if kind in (0x03, 0x04):
        document, at = document_at(data, at)
        return (document if kind == 0x03 else [document[str(i)] for i in range(len(document))]), at
    if kind == 0x05:
        (size,) = struct.unpack_from("<i", data, at)
        return bytes(data[at + 5 : at + 5 + size]), at + 5 + size
    if kind == 0x07:
        return ("oid", data[at : at + 12].hex()), at + 12
    if kind == 0x08:
        return bool(data[at]), at + 1
    if kind == 0x0A:
        return None, at
    if kind == 0x0B:
        pattern, at = _cstring(data, at)
        options, at = _cstring(data, at)
        return ("regex", pattern, options), at
    if kind == 0x13:
        return _decimal(data[at : at + 16]), at + 16
    if kind in (0x7F, 0xFF):
        return ("key", kind), at
    raise ValueError(hex(kind))


def document_at(data, at):
    (size,) = struct.unpack_from("<i", data, at)
    end, found, at = at + size, {}, at + 4
    while data[at]:
        kind = data[at]
        name, at = _cstring(data, at + 1)
        found[name], at = _value(kind, data, at)
    assert at + 1 == end, "declared size and content disagree"
    return found, end


def documents(data):
    at = 0
    while at < len(data):
        found, at = document_at(data, at)
        yield found
