"""opslens: machine telemetry and shop-customer analytics on Spark.

Everything is a DataFrame-to-DataFrame function built from Spark SQL
built-ins, so Catalyst plans the whole chain (scan pruning, pushdown,
partial aggregation) and no per-row Python runs on the data path.

Subpackages:

* ``functions``  column-expression builders (parsing, scores, exact sums)
* ``operators``  DataFrame transforms (scoring, cleaning, rollups, summaries)
* ``sources``    readers, writers, catalog discovery, stream envelopes, fixtures
* ``streaming``  the two Structured Streaming processors
* ``plans``      end-to-end chains and the query catalogue
"""

__version__ = "0.1.0"
