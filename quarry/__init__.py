"""quarry: analyst queries and table operators on Spark's DataFrame API.

Every public function takes and returns DataFrames (or Columns); the work
is planned by Catalyst and runs on the executors.  The query catalogue in
``quarry.catalog`` pairs each registered query with an equivalent SQL text
used as an independent oracle.
"""

__all__ = ["session", "catalog"]
