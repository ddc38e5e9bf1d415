"""A PySpark library for metadata tables, nested documents, triples and text corpora."""
