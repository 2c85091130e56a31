"""Jobs: feature building, exploration, detection and the full run."""
