"""Weekly retail panel analytics on Spark: features, promotion response, forecasts, pricing labels."""
