"""Business questions, chart datasets, the ETL run and plan inspection."""
