"""Part of spindlekg."""
