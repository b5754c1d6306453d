"""Sources and sinks: ride readers/writers and the derived test table."""
