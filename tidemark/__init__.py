"""Price ticks and short posts on Spark: daily views, count windows, sentiment and direction labels."""
