"""Reading the schema text of a VARIANT: which paths it has, and of which kind.

Documents that share a schema text share their paths, so texts are grouped first and each is read once.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import chain, pairwise

import pyarrow as pa

OBJECT, ARRAY = "OBJECT", "ARRAY"
#: Rows of paths that are held at a time.
ROWS = 10_000
_TOKEN = re.compile(r"`((?:[^`]|``)*)`|([A-Za-z0-9_]+(?:\([0-9, ]+\))?)|([<>:,])")


def nodes(schema: str) -> Iterator[tuple[tuple[str, ...], str]]:
    """``(names, kind)`` of every value a schema text names, sub-documents too, the root first.

    Arrays are one value; nothing inside them is listed.
    """
    tokens = chain((m.groups() for m in _TOKEN.finditer(schema)), [(None, None, None)])
    names: list[str] = []
    skipped = 0
    for (quoted, word, mark), following in pairwise(tokens):
        if mark is None and skipped:
            skipped += following[2] == "<"
        elif mark is None and following[2] == ":":
            names.append(word if quoted is None else quoted.replace("``", "`"))
        elif mark is None:
            yield tuple(names), word
            if word == ARRAY:
                skipped = 1
            elif word != OBJECT and names:
                names.pop()
        elif mark == ">":
            inside, skipped = skipped > 1, max(skipped - 1, 0)
            # The end of a value below a field, be it an object or a whole array.
            if not inside and names:
                names.pop()


def path_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(names as JSON, dotted path, kind, documents)`` for batches of ``(schema, documents)``.

    The rows leave in batches of about ROWS, however many paths the schemas of one incoming batch have.
    """
    types = (pa.string(), pa.string(), pa.string(), pa.int64())

    def told(rows: list[tuple[str, str, str, int]]) -> pa.RecordBatch:
        arrays = [pa.array(list(c), t) for c, t in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays(arrays, names=["names", "path", "kind", "documents"])

    rows = []
    for batch in batches:
        for schema, documents in zip(*batch.columns):
            schema, documents = schema.as_py(), documents.as_py()
            for names, kind in nodes(schema) if schema is not None else ():
                rows.append((json.dumps(names), ".".join(names), kind, documents))
                if len(rows) >= ROWS:
                    yield told(rows)
                    rows = []
    if rows:
        yield told(rows)
