"""Input tables, the bronze derivation, the calendar and table sinks."""
