"""slicehouse: importing, exporting and reporting over a date-sliced warehouse, on PySpark."""
