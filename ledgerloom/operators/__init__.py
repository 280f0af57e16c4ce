"""DataFrame operators: dedupe, lookup, mapping, validation, quarantine, checks, access."""
