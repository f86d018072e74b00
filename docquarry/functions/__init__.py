"""Column functions: value rendering, JSON modes, text rules and digests."""

from docquarry.functions.digests import row_digest, spec_digest
from docquarry.functions.jsonmodes import document_json, embedded_json
from docquarry.functions.logtext import (
    error_category,
    error_retry_delay,
    error_retryable,
    error_severity,
    exit_code,
    format_bytes,
    mask_credentials,
    valid_uri,
)
from docquarry.functions.values import decimal_text, double_text, epoch_millis, hex_text, render, rfc3339

__all__ = [
    "decimal_text",
    "document_json",
    "double_text",
    "embedded_json",
    "epoch_millis",
    "error_category",
    "error_retry_delay",
    "error_retryable",
    "error_severity",
    "exit_code",
    "format_bytes",
    "hex_text",
    "mask_credentials",
    "render",
    "rfc3339",
    "row_digest",
    "spec_digest",
    "valid_uri",
]
