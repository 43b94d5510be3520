"""All named queries and their SQL oracles."""

from __future__ import annotations

from scholarspark.plans import extra, ingest, learning, records, search, stats, text
from scholarspark.plans.oracle import RECORDS
from scholarspark.plans.oracle_search import SEARCH
from scholarspark.plans.oracle_stats import STATS
from scholarspark.plans.oracle_text import TEXT
from scholarspark.plans.oracle_learning import LEARNING
from scholarspark.plans.oracle_ingest import INGEST
from scholarspark.plans.oracle_extra import EXTRA

QUERIES = {}
ORACLE_SQL = {}

QUERIES.update(records.QUERIES)
ORACLE_SQL.update(RECORDS)
QUERIES.update(search.QUERIES)
ORACLE_SQL.update(SEARCH)
QUERIES.update(stats.QUERIES)
ORACLE_SQL.update(STATS)
QUERIES.update(text.QUERIES)
ORACLE_SQL.update(TEXT)
QUERIES.update(learning.QUERIES)
ORACLE_SQL.update(LEARNING)
QUERIES.update(ingest.QUERIES)
ORACLE_SQL.update(INGEST)
QUERIES.update(extra.QUERIES)
ORACLE_SQL.update(EXTRA)

from scholarspark.plans.oracle import stable_rounds  # noqa: E402

ORACLE_SQL = {k: stable_rounds(v) for k, v in ORACLE_SQL.items()}
