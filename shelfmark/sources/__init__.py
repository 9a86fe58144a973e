"""Reading raw crawl documents, and the stored tables of earlier runs."""
