"""Customer and revenue analytics for an online retailer, on Spark."""
