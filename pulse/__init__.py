"""pulse: business-registry analytics as Spark DataFrame operators.

Layout
------
functions/   column expressions (calendar buckets, labels, parsing, folds)
operators/   DataFrame -> DataFrame operators (closure, crosswalk, upsert, quality, ...)
sources/     readers for raw payloads (XML dump, cube JSON, delimited files) and
             the bindings of the synthetic test tables onto the canonical inputs
plans/       the marts (composite queries) and the incremental-load plan
streaming/   Structured Streaming variants of the incremental load
"""

from pulse.session import build_session, shared_dir  # noqa: F401
