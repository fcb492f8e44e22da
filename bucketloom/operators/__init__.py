"""DataFrame operators: rollups, joins between signals, checks on records."""
