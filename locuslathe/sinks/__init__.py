"""sinks of locuslathe."""
