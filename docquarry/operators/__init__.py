"""DataFrame operators: filter, project, page, discover, flatten and count."""

from docquarry.operators.discovery import discover_paths, leaf_paths, missing_fields, path_coverage
from docquarry.operators.filters import combine, condition, where
from docquarry.operators.flatten import flatten, flatten_cells
from docquarry.operators.manifest import Manifest, infer_manifest, manifest_table
from docquarry.operators.paging import (
    after,
    count_docs,
    keyset_page,
    keyset_spec,
    limit_docs,
    page,
    parse_sort,
    skip_docs,
    sort_docs,
)
from docquarry.operators.paths import get_path
from docquarry.operators.projection import parse_field_list, project
from docquarry.operators.statistics import classify_messages, docs_per_second, error_stats, export_stats

__all__ = [
    "Manifest",
    "after",
    "classify_messages",
    "combine",
    "condition",
    "count_docs",
    "discover_paths",
    "docs_per_second",
    "error_stats",
    "export_stats",
    "flatten",
    "flatten_cells",
    "get_path",
    "infer_manifest",
    "keyset_page",
    "keyset_spec",
    "leaf_paths",
    "limit_docs",
    "manifest_table",
    "missing_fields",
    "page",
    "parse_field_list",
    "parse_sort",
    "path_coverage",
    "project",
    "skip_docs",
    "sort_docs",
    "where",
]
