"""Reading snapshot tables, writing results, watermarks and ingestion."""
