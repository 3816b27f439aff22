"""Whole flows: the batch pipeline, the adapter for the sample tables, and the
registered queries with their SQL counterparts."""
