"""Reports over result tables, and the catalog of the windowed analytics."""
