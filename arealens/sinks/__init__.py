"""Writers and published record sets."""
