"""DataFrame-to-DataFrame operators. Every one takes the series key columns as ``keys``."""
