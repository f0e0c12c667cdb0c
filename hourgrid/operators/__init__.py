"""DataFrame operators: cleaning, joins, aggregations, time-series windows."""
