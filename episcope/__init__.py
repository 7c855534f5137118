"""episcope: multi-source outbreak analytics expressed as Spark DataFrame jobs.

Sub-packages
------------
functions  column expressions (calendar, text, numeric helpers)
operators  DataFrame -> DataFrame operators (filters, joins, aggregates,
           windows, ordering helpers, evaluation, sampling, sentiment)
sources    readers / writers for the landed files and the proxy tables
plans      composed pipelines (feature matrix, daily pipeline, reports, MLlib)
streaming  the daily social roll-up over a file stream of landed posts
"""

__version__ = "0.1.0"
