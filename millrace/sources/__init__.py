"""Reading and writing pages, feeds, API pages and record files."""
