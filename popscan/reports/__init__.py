"""Reports over stored results: tables and JSON documents."""

from popscan.reports.documents import DOCUMENTS, concept_documents, document, export_reports
from popscan.reports.queries import REPORTS, Vocabulary, report

__all__ = [
    "DOCUMENTS",
    "REPORTS",
    "Vocabulary",
    "concept_documents",
    "document",
    "export_reports",
    "report",
]
