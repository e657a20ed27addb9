"""tickvault.streaming."""
