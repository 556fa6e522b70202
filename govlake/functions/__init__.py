"""govlake.functions."""
