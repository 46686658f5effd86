"""Where events and catalogs come from, and where results go."""
