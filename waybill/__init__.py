"""Waybill: message-queue analytics as Spark DataFrame and Structured Streaming jobs."""
