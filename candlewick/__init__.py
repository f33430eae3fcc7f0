"""Market-data analytics on PySpark: candles, facts, marts, history and streams."""
