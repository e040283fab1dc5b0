"""Where data comes from and goes to: the lake, dated drops, and Parquet tables in other shapes."""
