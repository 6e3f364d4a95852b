"""hourlake sources."""
