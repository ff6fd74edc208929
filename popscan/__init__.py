"""Characterisation of clinical data sets on Spark: analyses, quality rules, reports."""

from popscan.catalogue import Analysis, analysis, analysis_catalogue, shared_analyses
from popscan.cdm import Cdm, Domain
from popscan.heel import fetch_heel, run_heel
from popscan.plans import run_analyses
from popscan.reports import Vocabulary, concept_documents, document, export_reports, report
from popscan.results import (
    FrameResults,
    LiveResults,
    StoredResults,
    compare_documents,
    compare_results,
    fetch_analysis,
    suppress_small_cells,
)
from popscan.sources import adapt_v4, load_cdm, normalise_dates, validate_schema

__all__ = [
    "Analysis",
    "Cdm",
    "Domain",
    "FrameResults",
    "LiveResults",
    "StoredResults",
    "Vocabulary",
    "adapt_v4",
    "analysis",
    "analysis_catalogue",
    "compare_documents",
    "compare_results",
    "concept_documents",
    "document",
    "export_reports",
    "fetch_analysis",
    "fetch_heel",
    "load_cdm",
    "normalise_dates",
    "report",
    "run_analyses",
    "run_heel",
    "shared_analyses",
    "suppress_small_cells",
    "validate_schema",
]
