"""culvert: asset-inspection integration jobs expressed on Spark DataFrames.

Sub-packages:
  sources    - schemas, seeded code lookups, scans/sinks, test-table derivations
  functions  - Column -> Column helpers (text cleaners, id rules, code rules)
  operators  - DataFrame -> DataFrame building blocks (classification, code joins,
               change-set joins, windows, quality reports)
  plans      - composed jobs (facility/task dimensions, unified inspections view,
               outbound extract, view registration)
  streaming  - change-driven state rules (batch form) and their Structured
               Streaming driver
  checks     - the registered query catalogue and the DuckDB oracle SQL
"""

__all__ = ["session"]
