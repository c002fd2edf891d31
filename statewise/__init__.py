"""Regional indicators on Spark: raw files in, star schema and rankings out."""
