"""Reading requests, extracts and remote tables; publishing snapshots."""
