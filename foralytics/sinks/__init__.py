"""Writers and reports on what was written."""
