"""daybook: double-entry ledger ingestion and analytics on Spark DataFrames."""
