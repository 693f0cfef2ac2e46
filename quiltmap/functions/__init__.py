"""Column functions: grid arithmetic, pixel bytes, URIs and ranks."""
