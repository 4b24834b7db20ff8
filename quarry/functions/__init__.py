"""Part of quarry."""
