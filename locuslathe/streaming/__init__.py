"""streaming of locuslathe."""
