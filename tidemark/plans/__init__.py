"""What to run: periods, single runs of a table, and backfills."""
