"""Export plans."""

from docquarry.plans.export import run_export, selected
from docquarry.plans.report import ExportReport
from docquarry.plans.resumable import Progress, export_page
from docquarry.plans.spec import ExportSpec, parse_query

__all__ = ["ExportReport", "ExportSpec", "Progress", "export_page", "parse_query", "run_export", "selected"]
