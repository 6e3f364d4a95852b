"""hourlake streaming."""
