"""The three jobs (cutoff group, historical base, migration performance) and sinks."""
