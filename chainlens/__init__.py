"""chainlens: cloud security posture analytics expressed as Spark DataFrame operators.

Sub-packages
------------
functions  scalar column builders (severity ranks, risk score, JSON or-chains, ...)
sources    readers for scanner outputs, the stored-table layout and the test adapters
operators  normalise / upsert / correlate / summarise / rank / report operators
plans      composed jobs (full scan over many accounts, plan assertions)
streaming  incremental ingest with Structured Streaming
"""

__version__ = "0.1.0"
