"""Market-data analytics on Spark: trades and quotes in, candles, rankings and forecasts out."""
