"""Resale commerce analytics on Spark: raw contracts, clean-up operators, nine facts and a metric catalogue."""
