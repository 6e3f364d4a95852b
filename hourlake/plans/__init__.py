"""hourlake plans."""
