"""Claims-denial analytics as Spark jobs.

Every step is a function from DataFrames to a DataFrame built from Spark
expressions only: typed staging of the raw tables, grain-safe joins of claims
with their denials, tunable appeal assumptions per reason category, the denial
fact with expected recoverable dollars, pattern and pool marts, the top workflow
fixes, data checks and profile reports.

Layout:
    sources/    raw table schemas, readers, sinks, the test-data mapping
    functions/  Column helpers (surrogate key, exact rounding of ratios)
    operators/  reusable DataFrame operators (lookups, shares, rates, top-k, checks)
    plans/      the jobs themselves (staging, economics, facts, marts, checks, profile)
"""

from remitlens.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
