"""Sources and sinks: file inventory, Bronze files, landing, manifest, zone seed."""
