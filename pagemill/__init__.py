"""pagemill: stored web pages in, curated text records and training pairs out, on Spark."""
