"""Layered retail analytics on Spark: raw -> bronze -> silver -> gold as DataFrame plans."""
