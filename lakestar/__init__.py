"""lakestar: feeds to raw, clean and star-schema tables on Spark."""
