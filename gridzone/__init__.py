"""gridzone: zonal raster analytics as Spark DataFrame jobs.

Entry points:

* ``gridzone.operators.zonal``  — ``zone`` / ``zone_from_lonlat``, ``zonal_crosstab``, ``poly_stats``,
  ``poly_diff_stats`` and the ``*_tiled`` variants for tile-partitioned stores
* ``gridzone.operators.accum``  — running-count accumulator (``rank_bitmaps``,
  ``zonal_crosstab_accum``)
* ``gridzone.operators.vector`` — polygon edges, spans, boundary cells, covering keys, area
* ``gridzone.operators``        — ``layout``, ``bands``, ``terrain``, ``points``, ``stats``, ``records``
* ``gridzone.sources``          — driver tables and derived layers, polygons / GeoJSON, catalog, reports
* ``gridzone.plans``            — the registered queries with their DuckDB oracle SQL, and the ingest job
"""

__version__ = "0.1.0"
