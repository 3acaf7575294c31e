"""Inputs and outputs: driver tables, derived layers, polygons, catalogs, reports."""
