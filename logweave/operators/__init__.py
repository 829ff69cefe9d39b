"""DataFrame operators: decode, windowed counts, dead letters, producing."""
