"""Card-payment risk and merchant analytics as DataFrame-to-DataFrame Spark functions."""
