"""Raster mosaics and web-map tile pyramids as Spark DataFrame jobs."""
