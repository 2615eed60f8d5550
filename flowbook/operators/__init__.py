"""DataFrame -> DataFrame operators: rules, flows, positions, dedupe, joins, cube, backfill, checks."""
