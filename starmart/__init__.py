"""Star-schema loading, auditing and OLAP reporting as Spark DataFrame functions."""
