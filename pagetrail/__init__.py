"""Web-analytics marts over a raw event export, built from Spark DataFrame operators."""
