"""Writers and tables."""
