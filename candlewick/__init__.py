"""A Spark-native engine for OHLCV candle datasets: ingest, audit and comparison."""
