"""govlake.sources."""
