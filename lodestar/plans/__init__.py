"""Named analyses (V09-V27), stand-in datasets and the query catalogue."""
