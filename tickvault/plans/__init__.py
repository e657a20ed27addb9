"""tickvault.plans."""
