"""Part of emberlog."""
