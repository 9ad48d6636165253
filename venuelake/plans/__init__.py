"""Warehouse builders, marts, serving queries, graph tables and recommendations."""
