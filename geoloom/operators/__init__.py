"""DataFrame-level operators: joins, rasters, overlays, instances, meshes, reports."""
