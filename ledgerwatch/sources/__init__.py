"""Sources and sinks: contracts, fixture derivations and table writers."""
