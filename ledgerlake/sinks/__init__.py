"""Writers and table declarations."""
