"""hourlake functions."""
