"""Set-level operators: joins, ids, duplicates, upserts, audits. All lazy unless stated."""
