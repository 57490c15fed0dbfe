"""Reusable operators over DataFrames; none of them knows a particular query."""
