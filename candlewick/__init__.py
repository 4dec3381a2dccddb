"""Candlewick: OHLCV candle analytics as PySpark DataFrame and Structured Streaming jobs."""
