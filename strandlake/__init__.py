"""Analytics on Spark for genetic-barcode lineage tracing."""
