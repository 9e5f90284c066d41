"""Sources and sinks: landing readers, the fixture landing, the control-table store."""
