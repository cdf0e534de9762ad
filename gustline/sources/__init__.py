"""Files, layers, publishing and the run manifest."""
