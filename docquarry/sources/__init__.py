"""Collection scans."""

from docquarry.sources.scan import Snapshot, SourceChanged, as_documents, fingerprint, sample, scan, scan_snapshot, spread

__all__ = ["Snapshot", "SourceChanged", "as_documents", "fingerprint", "sample", "scan", "scan_snapshot", "spread"]
