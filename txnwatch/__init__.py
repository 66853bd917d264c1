"""txnwatch: transaction-fraud analytics as Spark DataFrame operators.

Batch and streaming share one set of ``DataFrame -> DataFrame`` operators:
parse and flatten wire records, keep Bronze (raw) and Silver (masked)
tables, score four fraud rules, project hits into replay-safe alerts and
report on them.
"""

from txnwatch.config import RuleSet, load_rules
from txnwatch.session import build_session

__all__ = ["RuleSet", "load_rules", "build_session"]
