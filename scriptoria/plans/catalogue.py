"""All queries of the reference capabilities."""

from scriptoria.plans import admission, editing, exports, logs, mixing, pages, ranged, scoring, summaries
from scriptoria.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "admission", "editing", "exports", "logs", "mixing", "pages", "ranged", "scoring", "summaries"]
