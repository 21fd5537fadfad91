"""Long-running queries: each function starts one and returns its handle."""
