"""Spark-first analytics for government-bond quotes, trades and auctions."""
