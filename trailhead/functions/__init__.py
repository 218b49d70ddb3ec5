"""Part of Trailhead."""
