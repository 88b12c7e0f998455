"""Record-pipeline analytics expressed as Spark DataFrame operators.

Every public function takes DataFrames and returns DataFrames; nothing in the
package creates a session.  Timestamps are naive UTC, so the session time zone
has to be UTC (``spark.sql.session.timeZone``).
"""
