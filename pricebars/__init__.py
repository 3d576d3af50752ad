"""Price bars, features, star-schema layers, forecasts and streams on Spark."""
