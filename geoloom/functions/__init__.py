"""Column-level building blocks (coordinate systems, measures, attributes, meshes)."""
