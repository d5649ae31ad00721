"""Sources and sinks (S1-S7) and the driver-table stand-in projections."""
