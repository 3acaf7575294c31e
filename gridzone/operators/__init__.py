"""DataFrame -> DataFrame operators (vector, zonal, accumulator, layout, bands, terrain, records)."""
