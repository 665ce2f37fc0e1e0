"""millrace: web-content ETL and Q&A analytics as PySpark DataFrame functions."""
