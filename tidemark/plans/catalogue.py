"""All queries; importing the operators registers them."""

from tidemark.operators import adoption, bundles, decisions, evidence_graph, evidence_import, evidence_store, fences, folds, generations, inbox, joins, listings, long_folds, observer, probe, reconcile, signatures, stream_events, variant_probe, verifier, windows  # noqa: F401
from tidemark.sources import ingress, pages, provider  # noqa: F401
from tidemark.streaming import admission, barrier, conflicts, state  # noqa: F401
from tidemark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
