"""Small-area rate indexes as lazy Spark DataFrame operators."""
