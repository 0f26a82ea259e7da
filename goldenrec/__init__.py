"""Master-data lakehouse on PySpark: bronze batches -> one silver schema -> golden records."""
