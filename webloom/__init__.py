"""Web-corpus analytics on PySpark: link graphs, DOM extraction, text cleaning, deduplication and retrieval."""
