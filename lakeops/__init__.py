"""lakeops: lakehouse analytics operators written on the PySpark DataFrame API."""
