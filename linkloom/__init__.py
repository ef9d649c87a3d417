"""linkloom: crawl analytics expressed as Spark DataFrame operations."""
