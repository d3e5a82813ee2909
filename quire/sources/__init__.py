"""Table loaders and the fixture tables derived from the driver's data."""
