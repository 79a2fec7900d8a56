"""Retail analytics and sales forecasting as Spark DataFrame plans."""
