"""Query catalog (Spark plans + DuckDB oracle SQL), the full job, plan inspection."""
