"""Training-data operators (sharding, WARC, joins, dedup, scans, packing ...).

Every operator lives in its own module; ``registry`` holds the registered queries and
their SQL twins.  Nothing else in the library imports this subpackage.
"""
