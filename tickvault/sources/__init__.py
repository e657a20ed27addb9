"""tickvault.sources."""
