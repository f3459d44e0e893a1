"""ledgerstar: a retail sales datamart built as Spark DataFrame jobs.

Two text feeds are typed and cleaned (rejects kept with their reason),
deduplicated first-wins in load order, split into sales and returns,
categorised and canonically named, and published as a star schema with
audit tables and quality checks; nine business questions run on top.

Packages:
  sources    feed readers (CSV / per-sheet files) and the derived test feed
  functions  column expressions: text typing, keyword categories, payloads
  operators  staging, dedup, rules, canonical names, mart tables, checks
  plans      the chained views, stored-layer stages, questions, registry,
             SQL oracle
  streaming  intentionally empty (the source has no streaming behaviour)
"""
