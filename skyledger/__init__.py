"""Weather observations on Spark: raw JSON to a silver table, gold tables and alerts."""
