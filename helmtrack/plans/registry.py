"""Name -> query and name -> SQL tables that the entry module serves."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}
FLAGSHIP = "w1_continuity_segments"


def query(sql: str | None = None):
    """Registers a function of (spark, sf_dir) under its name, with SQL for the same rows."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


from helmtrack.plans import curve_queries, edit_queries, feature_queries, frame_queries, pose_queries, repair_queries, trace_queries  # noqa: E402,F401  they register themselves
