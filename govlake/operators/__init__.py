"""govlake.operators."""
