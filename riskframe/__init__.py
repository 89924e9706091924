"""riskframe: card-transaction risk analytics written as Spark DataFrame / SQL / MLlib jobs.

Sub-packages
------------
sources    readers, writers, the driver tables and the ``txn`` view
functions  column expressions: seeded draws, dates, rounding
operators  joins, aggregations, sampling, encoding, metrics
plans      composed jobs (detector, generation) and the query catalogue
streaming  the stateless feature/scoring steps applied to a file stream
"""

__version__ = "0.1.0"
