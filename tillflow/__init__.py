"""tillflow: retail sales events on Spark.

Events are validated, cleaned, deduplicated, inserted once into a month
partitioned table, rejected rows go to a dead-letter table with a reason,
every outcome is counted, and sales questions (totals, top products,
hourly revenue, country shares, category sales) are answered over a time
window.  Every operator is a ``DataFrame -> DataFrame`` function built from
Spark SQL expressions, joins and aggregates.
"""

__version__ = "0.1.0"
