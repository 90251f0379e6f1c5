"""Market-data engine on Spark: decode, lake, live state and series queries."""
