"""tickvault.functions."""
