"""Where raw records come from: Parquet, captured responses as JSON files, and paged HTTP backends."""
