"""hourlake operators."""
