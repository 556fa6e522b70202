"""govlake.streaming."""
