"""Fixed values and the small dimensions built from them."""
