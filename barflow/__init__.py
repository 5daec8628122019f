"""Bar and signal analytics for per-symbol OHLCV series, on plain PySpark."""
