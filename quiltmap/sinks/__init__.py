"""Writing chunks, manifests, images and job records."""
