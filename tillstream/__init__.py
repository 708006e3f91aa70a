"""Retail sales-stream analytics on Spark: baskets, payments, completed sales, item lines."""
