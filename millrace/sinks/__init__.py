"""Writers.  These run jobs."""
