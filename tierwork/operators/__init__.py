"""DataFrame operators: copies, quality, routing, metrics, versions, changes."""
