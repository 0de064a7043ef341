"""Product catalogue jobs on Spark: crawled pages in, import rows out."""
