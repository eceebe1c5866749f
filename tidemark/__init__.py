"""Point-in-time event analytics on Spark DataFrames.

Raw violation-grain logs go in; deduplicated event tables, leakage-safe decision
snapshots, data-quality results, calibrated risk scores and capacity-limited
queues come out.  Every operator is a function from DataFrames to a DataFrame.
"""

from tidemark.policy import EventPolicy, SplitBounds

__all__ = ["EventPolicy", "SplitBounds"]
