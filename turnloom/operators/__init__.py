"""DataFrame operators: filters, turn windows, joins, statistics, sampling."""
