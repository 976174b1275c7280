"""cinder: batch analytics over text, delimited records, logs and retail tables.

Every public function maps DataFrame(s) to a DataFrame using built-in Spark SQL
expressions, so Catalyst plans the work (pushdown, pruning, partial aggregation,
join selection) and nothing passes through the driver.
"""

__version__ = "0.1.0"
