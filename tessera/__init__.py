"""Entity-resolution and analytics engine built on PySpark DataFrames."""
