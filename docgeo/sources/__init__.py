"""Sources and sinks: corpus readers, location cache versions, blacklist/whitelist/boundary tables."""
