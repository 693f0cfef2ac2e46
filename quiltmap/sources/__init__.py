"""Reading requests, manifests and tiles."""
