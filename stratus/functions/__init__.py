"""Column-level helpers: measure spec, JSON fields, planar geometry, circular statistics, time."""
