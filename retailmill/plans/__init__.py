"""Analytic queries, marts, batch runs and the query registry."""
