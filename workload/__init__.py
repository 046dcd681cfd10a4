"""Queries over the driver's tables, their inputs and their SQL counterparts."""
