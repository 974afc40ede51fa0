"""spendlens: daily marketing-attribution analytics as Spark DataFrame operators.

Layout: ``config`` (keys, metrics, window, share tables), ``functions`` (column
expressions), ``sources`` (catalog inputs and test fixtures), ``operators`` (roll-ups,
snapshot, merge, precedence, reconciliation, gate, publication), ``plans`` (the daily
run, its command line and the registered queries).
"""

from .config import JobConfig, ReportWindow, RoyaltyTiers
from .functions.cards import CardBook
from .operators.publication import Publication, job_publication
from .operators.publish import PublishTarget
from .operators.quality import GateRule
from .plans.pipeline import build, run
from .sources.catalog import Sources, TableNames

__all__ = [
    "CardBook",
    "GateRule",
    "JobConfig",
    "Publication",
    "PublishTarget",
    "ReportWindow",
    "RoyaltyTiers",
    "Sources",
    "TableNames",
    "build",
    "job_publication",
    "run",
]
