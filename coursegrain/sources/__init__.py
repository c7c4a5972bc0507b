"""Table contracts, typed scans and publishing."""
