"""Daily price analytics and next-close forecasting on Spark."""
